"""Near-dedup: similarity join by chosen paths, confirmed on full shingle sets, and its components.

Documents with equal sets are one class from the start. Each class has a signature of minwise tokens.
A tree starts from all classes; a node chooses `BRANCHES` places of the signature by a hash of its path
and sends each member to the child named by its token there. Small nodes are compared exhaustively,
large ones branch again, and independent trees are repeated until a pair at the threshold is missed
with a probability of at most (1 - threshold) ** (TREES * BRANCHES), 2.6e-7 at 0.85 and 2.6e-6 at 0.80. The
filter on signatures misses a further 1.3e-7 and 5.6e-7; together 3.8e-7 and 3.1e-6. Where all nodes of the pair
branch once more, the trees miss 6.7e-7 and 8.4e-6 instead. A pair linked through others is not lost.

Comparing is a filter on signatures, then an exact test on the full sets, most similar pairs first and
none inside a component known already, so a node gives fewer links than it has members. The first path
of the first tree is linked before the others: its components let most later nodes pass unread.

A node of more than `BLOCK` members is cut into blocks. In the first round each block meets the node's first
member, which links a group around it with work in proportion to the group; afterwards nodes that are
one component are dropped, and the blocks of the others meet pairwise. No pair is left out.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import Steps, bounded_batches, fresh, keyed, make_room, whole_groups, with_row_key
from gristmill.llm.shingles import shingle_hashes
from gristmill.session import broadcast_if_small

TREES = 4
BRANCHES = 2
TOKENS = 128
# Members of a node that are compared in one unit, and members beyond which a node branches again.
BLOCK = 1_024
LARGE = 4_096
DEPTH = 4
# Likely partners from which on a member's common shingles are counted with all others at once.
MANY = 32

_U = np.uint64


def missed_by_signature(percent: int, least: int) -> float:
    """Probability that a pair at the threshold has fewer than `least` equal tokens."""
    share = percent / 100
    return sum(math.comb(TOKENS, k) * share**k * (1 - share) ** (TOKENS - k) for k in range(least))


def least_alike(percent: int) -> int:
    """Equal tokens from which a pair is compared exactly: the most that miss a pair half as often as the trees do."""
    limit = (1 - percent / 100) ** (TREES * BRANCHES) / 2
    return max(k for k in range(TOKENS + 1) if k == 0 or missed_by_signature(percent, k) <= limit)


@functools.lru_cache(maxsize=1)
def _token_hashes() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20_240)
    return (
        draw.integers(1, 1 << 63, TOKENS, dtype=np.uint64) * _U(2) + _U(1),
        draw.integers(0, 1 << 63, TOKENS, dtype=np.uint64),
    )


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least hash of each of TOKENS hash functions, 31 bits of it."""
    mult, add = _token_hashes()
    least = np.full(TOKENS, _U(2**64 - 1))
    for at in range(0, len(shingles), 4_096):
        part = shingles[at : at + 4_096]
        np.minimum(least, (mult[:, None] * part + add[:, None]).min(axis=1), out=least)
    return (least >> _U(33)).astype(np.int32)


def _sketch(texts: DataFrame, width: int) -> DataFrame:
    def run(batches):
        make_room("near: sketches")
        for batch in batches:
            sizes, classes, tokens = [], [], []
            for text in batch.column(1).to_pylist():
                shingles = shingle_hashes(text, width)
                sizes.append(len(shingles))
                classes.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                tokens.append(signature(shingles))
            flat = np.concatenate(tokens) if tokens else np.empty(0, np.int32)
            offsets = pa.array(np.arange(len(sizes) + 1) * TOKENS, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), pa.ListArray.from_arrays(offsets, pa.array(flat))],
                names=["_doc", "_n", "_class", "_sig"],
            )

    return texts.select("_doc", "_text").mapInArrow(run, "_doc bigint, _n bigint, _class binary, _sig array<int>")


def _children(rows: DataFrame, branches: int) -> DataFrame:
    """Members of the next nodes: (_node, _doc) for each chosen place of the signature."""
    places = [F.pmod(F.xxhash64("_node", F.lit(k)), F.lit(TOKENS)).cast("int") for k in range(branches)]
    child = [F.xxhash64("_node", F.lit(k), F.get("_sig", p)) for k, p in enumerate(places)]
    return rows.select("_doc", F.explode(F.array_distinct(F.array(*child))).alias("_node"))


def _sized(members: DataFrame) -> DataFrame:
    """Members of nodes with at least two, with the node's size."""
    sizes = members.groupBy("_node").agg(F.count(F.lit(1)).alias("_size"), F.min("_doc").alias("_pivot")).filter("_size > 1")
    return members.join(sizes, "_node")


def _grow(classes: DataFrame, trees: int, steps: Steps) -> DataFrame:
    """Nodes of all trees: (_node, _doc, _size, _pivot); large ones are branched up to DEPTH times."""
    roots = F.explode(F.array(*[F.xxhash64(F.lit(f"tree {t}")) for t in range(trees)]))
    level = steps.keep("nodes", _sized(_children(classes.select("_doc", "_sig", roots.alias("_node")), BRANCHES)))
    found = level
    for depth in range(DEPTH):
        large = level.filter(F.col("_size") > LARGE)
        if not large.limit(1).count():
            break
        grown = _sized(_children(large.select("_node", "_doc").join(classes.select("_doc", "_sig"), "_doc"), BRANCHES))
        level = steps.keep(f"nodes{depth}", grown)
        found = found.filter(F.col("_size") <= LARGE).unionByName(level)
    return found


def _star_units(nodes: DataFrame) -> DataFrame:
    """Small nodes as they are; blocks of larger ones, each with the node's first member."""
    blocks = F.ceil(F.col("_size") / BLOCK)
    of = lambda b: F.xxhash64("_node", b)
    here = F.when(F.col("_size") <= BLOCK, F.array(of(F.lit(0)))).when(
        F.col("_doc") == F.col("_pivot"), F.transform(F.sequence(F.lit(0).cast("bigint"), blocks - 1), of)
    ).otherwise(F.array(of(F.pmod(F.xxhash64("_doc"), blocks))))
    return nodes.select("_doc", F.explode(here).alias("_unit"))


def _pair_units(nodes: DataFrame) -> DataFrame:
    """Small nodes as they are; of larger ones each two blocks together."""
    blocks = F.ceil(F.col("_size") / BLOCK)
    own = F.pmod(F.xxhash64("_doc"), blocks)
    of = lambda b: F.xxhash64("_node", F.least(own, b), F.greatest(own, b))
    here = F.when(F.col("_size") <= BLOCK, F.array(F.xxhash64("_node", F.lit(0)))).otherwise(
        F.transform(F.sequence(F.lit(0).cast("bigint"), blocks - 1), of)
    )
    return nodes.select("_doc", F.explode(here).alias("_unit"))


def _promising(units: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Members of a unit whose signature comes near that of a member in another component."""
    least = least_alike(percent)

    def run(batches):
        for table in whole_groups(batches):
            unit, doc, size, label = (table.column(i).to_numpy() for i in range(4))
            tokens = table.column(4).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, TOKENS)
            keep = np.zeros(len(unit), bool)
            starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
            for a, b in zip(starts, np.r_[starts[1:], len(unit)]):
                for i in range(a, b - 1):
                    near = (tokens[i + 1 : b] == tokens[i]).sum(axis=1) >= least
                    if near.any():
                        other = size[i + 1 : b]
                        near &= (label[i + 1 : b] != label[i]) & (100 * np.minimum(other, size[i]) >= percent * np.maximum(other, size[i]))
                        if near.any():
                            keep[i] = True
                            keep[i + 1 : b] |= near
            yield table.filter(pa.array(keep)).select([0, 1, 3]).combine_chunks().to_batches()

    def flat(batches):
        make_room("near: candidates")
        for several in run(batches):
            yield from several

    rows = units.join(classes, "_doc").select("_unit", "_doc", "_n", "_label", "_sig")
    return rows.repartition("_unit").sortWithinPartitions("_unit").mapInArrow(flat, "_unit bigint, _doc bigint, _label bigint")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    return int((large[at] == small).sum())


def _postings(sets: list[np.ndarray]):
    """For a member: how many shingles it has in common with each of the others."""
    size = np.array([len(s) for s in sets])
    _, number = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), size)[np.argsort(number, kind="stable")]
    begin = np.r_[0, np.cumsum(np.bincount(number))]
    own = np.split(number, np.cumsum(size)[:-1])

    def common(i: int) -> np.ndarray:
        first, count = begin[own[i]], begin[own[i] + 1] - begin[own[i]]
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - first, count)
        return np.bincount(owner[at], minlength=len(sets))

    return common


def _confirmed(members: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (_u, _v) of a unit's members, by exact comparison of their full sets."""

    least = least_alike(percent)

    def links(doc, label, texts):
        sets = [shingle_hashes(t, width) for t in texts]
        size = np.array([len(s) for s in sets])
        tokens = np.stack([signature(s) for s in sets])
        part = np.unique(label, return_inverse=True)[1]  # component of each member
        postings = None
        nearest_only = len(doc) > 2
        while True:
            for i in range(len(doc) - 1):
                open_to = np.flatnonzero(part[i + 1 :] != part[i]) + i + 1
                if not len(open_to):
                    continue
                alike = (tokens[open_to] == tokens[i]).sum(axis=1)
                fits = (alike >= least) & (100 * np.minimum(size[open_to], size[i]) >= percent * np.maximum(size[open_to], size[i]))
                order = np.argsort(-alike[fits], kind="stable")
                likely = open_to[fits][order[:1] if nearest_only else order]
                common = None
                if len(likely) > MANY:
                    postings = postings or _postings(sets)
                    common = postings(i)
                for j in likely.tolist():
                    if part[i] == part[j]:
                        continue
                    both = int(common[j]) if common is not None else _common(sets[i], sets[j])
                    if 100 * both >= percent * (size[i] + size[j] - both):
                        part[part == part[j]] = part[i]
                        yield int(doc[i]), int(doc[j])
            if not nearest_only:
                return
            nearest_only = False

    def run(batches):
        make_room("near: links")
        for table in whole_groups(batches):
            unit, doc, label = (table.column(i).to_numpy() for i in range(3))
            starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
            out = []
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(unit)]):
                out += links(doc[a:b], label[a:b], table.column(3).slice(a, b - a).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["_u", "_v"])

    wanted = broadcast_if_small(members.select("_doc").distinct())  # so only their texts are shuffled
    some = texts.select("_doc", "_text").join(wanted, "_doc", "left_semi")
    rows = members.join(some, "_doc").select("_unit", "_doc", "_label", "_text")
    return rows.repartition("_unit").sortWithinPartitions("_unit").mapInArrow(run, "_u bigint, _v bigint")


def components(links: DataFrame) -> DataFrame:
    """(_doc, _label): the least member of each linked document's component.

    Large-star and small-star steps in turn until nothing changes. A centre of many links is joined,
    never collected.
    """

    def state(edges: DataFrame):
        return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("_u", "_v").cast("decimal(38,0)"))).first())

    steps, turn = Steps(links.sparkSession, "components"), 0
    ordered = links.filter("_u <> _v").select(F.greatest("_u", "_v").alias("_u"), F.least("_u", "_v").alias("_v"))
    edges = steps.keep("links0", ordered.distinct())
    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("_v").alias("_u"), F.col("_u").alias("_v")))
        least = both.groupBy("_u").agg(F.min("_v").alias("_m")).select("_u", F.least("_u", "_m").alias("_m"))
        large = both.filter("_v > _u").join(least, "_u").select(F.col("_v").alias("_u"), F.col("_m").alias("_v")).distinct()
        low = large.groupBy("_u").agg(F.min("_v").alias("_m"))
        small = large.join(low, "_u").select(F.col("_v").alias("_u"), F.col("_m").alias("_v")).unionByName(
            low.select("_u", F.col("_m").alias("_v"))
        )
        turn += 1
        edges = steps.keep(f"links{turn}", small.filter("_u <> _v").distinct())
        steps.drop(f"links{turn - 1}")
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("_u").alias("_doc"), F.col("_v").alias("_label"))


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, trees: int = TREES
) -> DataFrame:
    """One row per row of `docs`: id, n_shingles, component_id, kept.

    Linked are documents whose sets of `width`-word shingles have 100 * common >= percent * all. Null
    text counts as empty; a document without words is linked with nothing. component_id is the least
    id that links lead to, itself included, and that document alone is kept. Rows that repeat an id
    are documents of their own, of which the first in the order of (id, text) counts as the least; a
    null id sorts first and gives a null component_id. Other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    texts, unique = keyed(docs, id_col, text_col)
    steps = Steps(spark, "near")
    sketches = steps.keep("sketches", _sketch(texts, width))
    sizes = steps.keep("sizes", sketches.select("_doc", "_n", "_class"))
    firsts = steps.keep("firsts", sizes.filter("_n > 0").groupBy("_class").agg(F.min("_doc").alias("_first")))
    one_each = firsts.select(F.col("_first").alias("_doc"))
    classes = steps.keep("classes", sketches.select("_doc", "_n", "_sig").join(one_each, "_doc"))
    steps.drop("sketches")
    nodes = _grow(classes, trees, steps)

    root = F.xxhash64(F.lit("tree 0"))
    place = F.pmod(F.xxhash64(root, F.lit(0)), F.lit(TOKENS)).cast("int")
    path = _sized(classes.select("_doc", F.xxhash64(root, F.lit(0), F.get("_sig", place)).alias("_node")))
    own = classes.withColumn("_label", F.col("_doc"))
    members = steps.keep("members", _promising(_star_units(path), own, percent))
    links = steps.keep("links", _confirmed(members, texts, width, percent))
    steps.drop("members")
    labels = components(links)

    part = steps.keep("parts", classes.select("_doc").join(labels, "_doc", "left").withColumn("_label", F.coalesce("_label", "_doc")))
    known = classes.join(part, "_doc")
    open_nodes = (
        nodes.join(part, "_doc").groupBy("_node").agg(F.min("_label").alias("_lo"), F.max("_label").alias("_hi"))
        .filter("_lo <> _hi").select("_node")
    )
    units = steps.keep("units", _pair_units(nodes.join(open_nodes, "_node")))
    members = steps.keep("members", _promising(units, known, percent))
    steps.drop("units", "classes", "nodes", *[f"nodes{depth}" for depth in range(DEPTH)])
    more = steps.keep("more", _confirmed(members, texts, width, percent))
    steps.drop("members", "parts")
    final = components(links.unionByName(more))

    label = (
        firsts.join(final, firsts["_first"] == final["_doc"], "left")
        .select("_class", F.coalesce("_label", "_first").alias("_component"))
    )
    rows = sizes.select("_doc", "_n", F.when(F.col("_n") > 0, F.col("_class")).alias("_class")).join(label, "_class", "left").select(
        "_doc", "_n", F.coalesce("_component", "_doc").alias("_component")
    )
    if unique:
        named = rows.select(F.col("_doc").alias("_id"), "_n", F.col("_component").alias("component_id"), "_doc", "_component")
    else:
        ids = texts.select("_doc", "_id")
        named = rows.join(ids, "_doc").join(ids.select(F.col("_doc").alias("_component"), F.col("_id").alias("component_id")), "_component")
    return named.select(
        F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"), "component_id", (F.col("_doc") == F.col("_component")).alias("kept")
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` that stay, one of each component, with all their columns."""
    rows, key = with_row_key(docs, id_col, text_col)
    stays = fresh(rows.columns, "__kept_row__")
    kept = near_copies(rows, key, text_col, width, percent).filter("kept").select(F.col(key).alias(stays))
    return rows.join(kept, rows[key] == F.col(stays), "left_semi").select(*docs.columns)
