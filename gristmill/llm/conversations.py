"""Prefix trie of conversations, built as a burst trie.

A container holds the suffixes of all conversations that share their first turns, under the trie's head
for these turns. Containers stand in shards (partitions) by their head.

* A container of more than `CONTAINER_TURNS` turns bursts: its conversations go to new containers by the
  id of their next turn. So that a long common opening costs one round instead of one for each turn, a
  burst follows a whole path, that of one conversation drawn by a hash: each of the others leaves
  the path at its first different turn, and the id of that turn names its new container. The path is the
  list of heads that the round adds to the trie. As the drawn conversation is never dealt on, containers
  shrink with every round, in general by a factor.
* A container of one conversation is a path; its nodes are its turns, whatever their number.
* All other containers are sorted and swept: a common prefix with the neighbour closes the nodes below it.

Afterwards the rounds are gone through backwards: what hangs on a path is summed up along it. No task
gets more than a container or a block of a path, however many conversations share a turn and however long
one of them is.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import Steps, bounded_batches, whole_groups
from gristmill.operators.blocks import number_in_order, running

# Turns that a container holds without bursting.
CONTAINER_TURNS = 512
# Nodes of a path that one window goes over, and bits of the conversation id that stay together in a list of ids.
PATH_BLOCK = 4_096
CHUNK_BITS = 12
# First original turns that conversations may share, and conversations to an opening.
SHARED, FAMILY = 9, 5

NODE = "head binary, depth bigint, conv_id bigint, n_convs bigint, parent_conv_id bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
_NOTHING = hashlib.sha256().hexdigest()


def _turn_id(role: Column, text: Column) -> Column:
    """128 bits of SHA-256 over the role's length, the role and the text."""
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(whole, 256)), 1, 16)


def ordered_turns(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(_c, _at, _n, _turn, _bytes): the turns of a conversation numbered 1, 2, ..., and how many it has.

    Null turns come first; of equal turns the one with the lower turn id. Null role and text are empty. A row
    without a conversation id belongs to none and is left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = rows.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("_c"), F.col(turn_col).alias("_o"), _turn_id(role, text).alias("_turn"),
        F.octet_length(text).cast("bigint").alias("_bytes"),
    )
    placed = number_in_order(turns, ["_c", F.col("_o").asc_nulls_first(), "_turn"], "_pos")
    spans = placed.groupBy("_c").agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    return placed.join(spans, "_c").select("_c", (F.col("_pos") - F.col("_first") + 1).alias("_at"), "_n", "_turn", "_bytes")


def shared_openings(turns: DataFrame) -> DataFrame:
    """(_c, _depth, _turn, _bytes, _last): rebuilt conversations, their turns from depth 1 and a textless depth 0.

    Conversation c takes the first h turns of conversation c - c % 5 and its own after its first h, with
    h = crc32(c) % 9. `turns` is the result of `ordered_turns`.
    """
    shared = lambda c: F.crc32(c.cast("string").cast("binary")) % SHARED
    home = lambda c: c - c % FAMILY
    convs = turns.filter("_at = 1").select("_c", "_n", shared(F.col("_c")).alias("_h"), home(F.col("_c")).alias("_home"))
    bases = convs.select(F.col("_c").alias("_home"), F.col("_n").alias("_base"))
    convs = convs.join(bases, "_home", "left").withColumn("_taken", F.least("_h", F.coalesce("_base", F.lit(0))))
    convs = convs.withColumn("_end", F.col("_taken") + F.greatest(F.col("_n") - F.col("_h"), F.lit(0)))
    own = (
        turns.drop("_n").join(convs.select("_c", "_h", "_taken", "_end"), "_c").filter(F.col("_at") > F.col("_h"))
        .select("_c", (F.col("_taken") + F.col("_at") - F.col("_h")).alias("_depth"), "_turn", "_bytes", "_end")
    )
    steps = F.explode(F.array(*[F.lit(i) for i in range(1 - FAMILY, FAMILY)])).alias("_step")
    opening = (
        turns.filter((F.col("_at") < SHARED) & (home(F.col("_c")) == F.col("_c")))
        .select(F.col("_c").alias("_home"), "_at", "_turn", "_bytes", steps)
        .withColumn("_c", F.expr("try_add(_home, _step)")).filter(home(F.col("_c")) == F.col("_home"))
        .join(convs.select("_c", "_h", "_end"), "_c").filter(F.col("_at") <= F.col("_h"))
        .select("_c", F.col("_at").alias("_depth"), "_turn", "_bytes", "_end")
    )
    roots = convs.select("_c", F.lit(0).cast("bigint").alias("_depth"), F.lit(b"").alias("_turn"), F.lit(0).cast("bigint").alias("_bytes"), "_end")
    rebuilt = own.unionByName(opening).unionByName(roots)
    return rebuilt.select("_c", F.col("_depth").cast("bigint").alias("_depth"), "_turn", "_bytes", (F.col("_depth") == F.col("_end")).alias("_last"))


def _swept(rows: DataFrame) -> DataFrame:
    """The nodes of whole containers; a container's top node has no parent here."""

    def nodes(head, conv, depth, turn, size, last):
        starts = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]]).tolist()
        members = sorted((turn[a:b], int(conv[a]), a) for a, b in zip(starts, [*starts[1:], len(conv)]))
        top, made, path, before = int(depth[0]), [], [], []
        for turns, c, a in members:
            same = 0
            while same < min(len(turns), len(before)) and turns[same] == before[same]:
                same += 1
            del path[same:]
            for i in range(same, len(turns)):
                made.append({"depth": top + i, "up": path[-1] if path else None, "conv": c, "n": 0, "children": 0, "leaves": 0, "size": int(size[a + i]), "saved": 0, "ends": []})
                path.append(len(made) - 1)
            for i in path:
                made[i]["n"] += 1
                made[i]["conv"] = min(made[i]["conv"], c)
            made[path[-1]]["ends"].append(c)
            before = turns
        for node in reversed(made):  # children come after their parents
            node["leaves"] = node["leaves"] or 1
            node["saved"] += (node["n"] - 1) * node["size"]
            if node["up"] is not None:
                up = made[node["up"]]
                up["children"] += 1
                up["leaves"] += node["leaves"]
                up["saved"] += node["saved"]
        for node in made:
            ends = ",".join(map(str, sorted(node["ends"])))
            up = None if node["up"] is None else made[node["up"]]["conv"]
            yield head, node["depth"], node["conv"], node["n"], up, node["children"], node["leaves"], node["saved"], hashlib.sha256(ends.encode()).hexdigest()

    kinds = [pa.binary(), *[pa.int64()] * 7, pa.string()]
    names = [c.split()[0] for c in NODE.split(", ")]

    def run(batches):
        for table in whole_groups(batches):
            heads, turn = table.column(1).to_pylist(), table.column(4).to_pylist()
            conv, depth, size = (table.column(i).to_numpy() for i in (2, 3, 5))
            edges = [i for i in range(len(heads)) if i == 0 or heads[i] != heads[i - 1]]
            found = [x for a, b in zip(edges, [*edges[1:], len(heads)]) for x in nodes(heads[a], conv[a:b], depth[a:b], turn[a:b], size[a:b], None)]
            for at in range(0, len(found), 4_096):
                part = found[at : at + 4_096]
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in part], kinds[i]) for i in range(9)], names=names)

    keyed = rows.select(F.xxhash64("_head").alias("_g"), "_head", "_c", "_depth", "_turn", "_bytes")
    return keyed.repartition("_g").sortWithinPartitions("_g", "_head", "_c", "_depth").mapInArrow(run, NODE)


def _end_hashes(ends: DataFrame) -> DataFrame:
    """(_head, _depth, _ends): SHA-256 of the sorted, comma-joined ids. A task hashes lists of neighbouring ids one after another."""

    def run(batches):
        key, state = None, None
        for batch in batches:
            out = []
            for head, depth, ids in zip(*(batch.column(i).to_pylist() for i in (1, 2, 4))):
                if (head, depth) == key:
                    state.update(f",{ids}".encode())
                    continue
                if key:
                    out.append((*key, state.hexdigest()))
                key, state = (head, depth), hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], kind) for i, kind in enumerate((pa.binary(), pa.int64(), pa.string()))], names=["_head", "_depth", "_ends"]
            )
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip((*key, state.hexdigest()), (pa.binary(), pa.int64(), pa.string()))], names=["_head", "_depth", "_ends"])

    lists = ends.groupBy("_head", "_depth", F.shiftright("_c", CHUNK_BITS).alias("_chunk")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("_c")), lambda c: c.cast("string")), ",").alias("_ids")
    )
    keyed = lists.select(F.xxhash64("_head", "_depth").alias("_g"), "_head", "_depth", "_chunk", "_ids")
    return keyed.repartition("_g").sortWithinPartitions("_g", "_head", "_depth", "_chunk").mapInArrow(run, "_head binary, _depth bigint, _ends string")


def _burst(steps: Steps, rows: DataFrame, at: int, limit: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One round over oversized containers: nodes of the paths, the containers made, and their rows."""
    drawn = rows.groupBy("_head").agg(F.min_by("_c", F.xxhash64("_c", F.lit(at))).alias("_c"))
    path = rows.join(drawn, ["_head", "_c"]).select("_head", "_depth", F.col("_turn").alias("_path"))
    beside = rows.join(path, ["_head", "_depth"], "left")
    leaves = beside.filter(~F.col("_turn").eqNullSafe(F.col("_path"))).groupBy("_head", "_c").agg(F.min("_depth").alias("_off"))
    there = rows.select("_head", "_c", F.col("_depth").alias("_off"), "_turn")
    child = F.unhex(F.md5(F.concat("_head", F.lit(b"@"), F.col("_off").cast("string").cast("binary"), F.lit(b"@"), "_turn")))
    moved = leaves.join(there, ["_head", "_c", "_off"]).select("_head", "_c", "_off", child.alias("_child"))
    dealt = steps.keep(f"dealt-{at}", rows.join(moved, ["_head", "_c"], "left"))
    stays = dealt.filter(F.col("_off").isNull() | (F.col("_depth") < F.col("_off")))
    nodes = stays.groupBy("_head", "_depth").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("_c").alias("conv_id"), F.max("_bytes").alias("_bytes")
    )
    ends = _end_hashes(stays.filter("_last").select("_head", "_depth", "_c"))
    nodes = steps.keep(f"paths-{at}", nodes.join(ends, ["_head", "_depth"], "left"))
    goes = dealt.filter(F.col("_depth") >= F.col("_off"))
    made = steps.keep(f"made-{at}", goes.groupBy("_child", "_head", "_off").agg(
        F.count_if(F.col("_depth") == F.col("_off")).alias("_members"), F.count(F.lit(1)).alias("_turns")
    ).select(
        F.col("_child").alias("_head"), F.col("_head").alias("_above"), F.col("_off").alias("_top"),
        F.when(F.col("_members") == 1, "path").when(F.col("_turns") <= limit, "small").otherwise("large").alias("_kind"),
    ))
    rest = goes.select(F.col("_child").alias("_head"), "_c", "_depth", "_turn", "_bytes", "_last")
    return nodes, made, steps.keep(f"rows-{at}", rest.join(made.select("_head", "_kind", "_top"), "_head"))


def trie(conversations: DataFrame, limit: int = CONTAINER_TURNS) -> DataFrame:
    """The nodes of the prefix trie, one row each; `conversations` as `shared_openings` gives them."""
    spark = conversations.sparkSession
    bounded_batches(spark)
    steps = Steps(spark, "trie")
    rows = steps.keep("rows", conversations.withColumn("_head", F.lit(b"")))
    paths: list[DataFrame] = []
    made: list[DataFrame] = []
    done: list[DataFrame] = []
    while rows.limit(1).count():
        at = len(paths)
        nodes, containers, below = _burst(steps, rows.select("_head", "_c", "_depth", "_turn", "_bytes", "_last"), at, limit)
        alone = below.filter("_kind = 'path'").select(
            F.col("_head").alias("head"), F.col("_depth").alias("depth"), F.col("_c").alias("conv_id"), F.lit(1).cast("bigint").alias("n_convs"),
            F.when(F.col("_depth") > F.col("_top"), F.col("_c")).alias("parent_conv_id"), F.when(F.col("_last"), 0).otherwise(1).cast("bigint").alias("n_children"),
            F.lit(1).cast("bigint").alias("n_leaves"), F.lit(0).cast("bigint").alias("saved_tokens"),
            F.when(F.col("_last"), F.sha2(F.col("_c").cast("string"), 256)).otherwise(_NOTHING).alias("ends_sha256"),
        )
        swept = _swept(below.filter("_kind = 'small'"))
        done.append(steps.keep(f"nodes-{at}", alone.unionByName(swept)))
        paths.append(nodes)
        made.append(containers)
        steps.drop(f"dealt-{at}", *(["rows"] if at == 0 else []))
        rows = below.filter("_kind = 'large'")
    if not paths:
        return spark.createDataFrame([], NODE).drop("head")

    out: list[DataFrame] = []
    lower: DataFrame | None = None  # nodes of the paths one round further down, finished but for the top's parent
    for at in range(len(paths) - 1, -1, -1):
        finished = done[at] if lower is None else done[at].unionByName(lower)
        tops = finished.join(made[at], (finished["head"] == made[at]["_head"]) & (finished["depth"] == made[at]["_top"]))
        hanging = tops.groupBy("_above", (F.col("_top") - 1).alias("_depth")).agg(
            F.count(F.lit(1)).alias("_tops"), F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved")
        ).withColumnRenamed("_above", "_head")
        path = paths[at]
        further = path.select("_head", (F.col("_depth") - 1).alias("_depth"), F.lit(1).alias("_next"))
        above = path.select("_head", (F.col("_depth") + 1).alias("_depth"), F.col("conv_id").alias("parent_conv_id"))
        nodes = path.join(hanging, ["_head", "_depth"], "left").join(further, ["_head", "_depth"], "left").join(above, ["_head", "_depth"], "left")
        zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
        nodes = nodes.withColumn("n_children", zero("_tops") + zero("_next"))
        summed = running(
            nodes, ["_head"], [F.desc("_depth")], -F.floor(F.col("_depth") / PATH_BLOCK),
            {
                "n_leaves": ("sum", zero("_leaves") + (F.col("n_children") == 0).cast("bigint")),
                "saved_tokens": ("sum", (F.col("n_convs") - 1) * F.col("_bytes") + zero("_saved")),
            },
        )
        named = {c: F.col(f"_{c}") for c in ("head", "depth")} | {"ends_sha256": F.coalesce("_ends", F.lit(_NOTHING))}
        own = steps.keep(f"summed-{at}", summed.select(*[named.get(c.split()[0], F.col(c.split()[0])).alias(c.split()[0]) for c in NODE.split(", ")]))
        over = own.select(F.col("head").alias("_above"), (F.col("depth") + 1).alias("_top"), F.col("conv_id").alias("_up"))
        links = made[at].join(over, ["_above", "_top"]).select(F.col("_head").alias("head"), F.col("_top").alias("depth"), "_up")
        linked = finished.join(links, ["head", "depth"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_up")).drop("_up")
        out.append(steps.keep(f"linked-{at}", linked))
        lower = own
    # The finished nodes of a round hold the paths of the round below, so only the first path is left over.
    whole = lower
    for part in out:
        whole = whole.unionByName(part)
    return whole.drop("head")


def prefix_trie(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", limit: int = CONTAINER_TURNS
) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by `turn_col`, null first, of equal turns by SHA-256 of role and text; null role or text is
    empty. Conversation c is rebuilt as `shared_openings` says. A node is a different sequence of first turns (role,
    text); the root is the sequence of none. `conv_id` is the smallest id of the conversations that begin so, `n_convs`
    how many there are; a copy counts like any other, and a conversation without turns stands at the root. Rows
    without a conversation id are left out, so a table without ids, like an empty one, gives no nodes. Other columns are
    not read. Turns are told apart by 128 bits of SHA-256.
    """
    turns = Steps(rows.sparkSession, "turns").keep("turns", ordered_turns(rows, id_col, turn_col, role_col, text_col))
    return trie(shared_openings(turns), limit).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
