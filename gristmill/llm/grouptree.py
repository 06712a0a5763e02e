"""Similarity join of word-shingle sets with R-trees over count vectors.

Shingles are hashed into `GROUPS` groups; the point of a set is how many of its shingles each group has. Two
sets have at most the sum of the coordinates' minima in common, and the same holds for boxes of points
with the boxes' upper corners. A pair is linked if common * (100 + percent) >= percent * (|A| + |B|), so a box
pair whose bound is below that for its smallest sets is left out with all pairs in it, and so is one whose
sizes don't fit. Pairs of points that survive are verified on the full sets.

One tree over all documents would not do: points of unrelated sets of n shingles lie about sqrt(GROUPS * n)
apart, linked ones up to n / 10, so boxes of long texts overlap and the join is quadratic. Trees are
therefore built per shard. Shingles are ordered by how many documents have them, hot ones last (the most
frequent ones are told apart by a table of bounded size; any order gives the same links). Linked sets share
one of their first n - ceil(percent * n / 100) + 1 shingles, so every linked pair meets in the shard of such
a shingle. Members of a shard are parted by size, so most shards have one member and go at once, and of
shards with the same members one stays.

A shard of up to `SHARD` members is one unit: its tree gives the members that may have a partner, their sets
are fetched, and all pairs that survive the tree and are not connected yet are verified. Pairs that share a
smaller shard are left to it. A larger shard is cut into blocks, each with the shard's first member, which links
a group around it in work proportional to the group. Where such a shard has several components then,
members outside its largest component meet all others block by block, and only they do.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import Steps, bounded_batches, keyed, whole_groups
from gristmill.llm.near import components
from gristmill.llm.shingles import shingle_hashes
from gristmill.session import broadcast_if_small

GROUPS = 64
# Members of a unit, and shingles that its sets have together unless it holds fewer than two members.
SHARD, SHARD_SHINGLES = 1_024, 4 << 20
# Documents from which a shingle counts as hot, hot shingles that are told apart at most, and cells of their table.
HOT, MOST_HOT, CELLS = 4, 1 << 22, 1 << 25
# Points of a leaf of the tree, and boxes of a node.
LEAF, BOXES = 16, 8
# Shingles whose buckets a task sorts and packs together.
PACKED = 1 << 22
# Bits of the filter that keeps texts without a possible partner out of the exchange.
FILTER_BITS = 1 << 24

_U = np.uint64


# ------------------------------------------------------------------ the tree


class CountTree:
    """Sort-tile-recursive R-tree over count vectors, for a join with itself."""

    def __init__(self, points: np.ndarray, percent: int):
        self.percent, self.points = percent, points
        self.size = points.sum(axis=1, dtype=np.int64)
        by_size = np.argsort(self.size, kind="stable")
        width = int(np.argmax(points.var(axis=0))) if len(points) else 0
        leaves = -(-len(points) // LEAF)
        slab = LEAF * max(1, round(leaves**0.5))
        tiles = [by_size[a : a + slab] for a in range(0, len(points), slab)]
        self.order = np.concatenate([t[np.argsort(points[t, width], kind="stable")] for t in tiles]) if tiles else by_size
        boxes = [self.order[a : a + LEAF] for a in range(0, len(points), LEAF)]
        self.levels = [(
            np.array([points[b].max(axis=0) for b in boxes]), np.array([self.size[b].min() for b in boxes]), np.array([self.size[b].max() for b in boxes]),
        )]
        while len(self.levels[-1][1]) > 1:
            upper, least, most = self.levels[-1]
            at = range(0, len(least), BOXES)
            self.levels.append((
                np.array([upper[a : a + BOXES].max(axis=0) for a in at]), np.array([least[a : a + BOXES].min() for a in at]),
                np.array([most[a : a + BOXES].max() for a in at]),
            ))

    def _fits(self, i, j, upper, least, most) -> np.ndarray:
        bound = np.minimum(upper[i], upper[j]).sum(axis=1, dtype=np.int64)
        p = self.percent
        return (bound * (100 + p) >= p * (least[i] + least[j])) & (100 * most[i] >= p * least[j]) & (100 * most[j] >= p * least[i])

    def pairs(self):
        """Arrays (i, j) of points that may be linked; each pair comes once, some with i > j."""
        if len(self.points) < 2:
            return
        i = j = np.zeros(1, np.int64)
        for below in range(len(self.levels) - 2, -1, -1):
            upper, least, most = self.levels[below]
            child = np.arange(BOXES)
            a = np.repeat(i[:, None] * BOXES + child, BOXES, axis=1).ravel()
            b = np.tile(j[:, None] * BOXES + child, (1, BOXES)).ravel()
            real = (a < len(least)) & (b < len(least)) & (a <= b)
            a, b = a[real], b[real]
            fits = self._fits(a, b, upper, least, most)
            i, j = a[fits], b[fits]
        for at in range(0, len(i), 256):
            a, b = i[at : at + 256], j[at : at + 256]
            slot = np.arange(LEAF)
            x = np.repeat(a[:, None] * LEAF + slot, LEAF, axis=1).ravel()
            y = np.tile(b[:, None] * LEAF + slot, (1, LEAF)).ravel()
            real = (x < len(self.order)) & (y < len(self.order)) & (x < y)
            x, y = self.order[x[real]], self.order[y[real]]
            fits = self._fits(x, y, self.points, self.size, self.size)
            yield x[fits], y[fits]


def point(shingles: np.ndarray) -> np.ndarray:
    return np.bincount((shingles >> _U(40)).astype(np.int64) % GROUPS, minlength=GROUPS).astype(np.int32)


def prefix_length(n: int, percent: int) -> int:
    """Of the shingles in a fixed order, how many from the first on must hold one that a linked set has too.

    None where no different set can be linked: one shingle more or fewer is too much.
    """
    if percent * (n + 1) > 100 * n:
        return 0
    return n - -(-percent * n // 100) + 1


# ------------------------------------------------------------------ shards


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> _U(32)).astype(np.uint32)


def _packed(ascending: np.ndarray) -> bytes:
    """Differences of ascending numbers, their bytes by significance, compressed."""
    steps = np.diff(ascending, prepend=np.uint32(0))
    return zstandard.ZstdCompressor(level=1).compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint32).ravel(), dtype=np.uint32)


def _counted(texts: DataFrame, width: int, bits: int) -> DataFrame:
    """(_bucket, _class): 32-bit buckets of shingles that `HOT` documents or more have, and the binary logarithm of how many.

    A task sends the sorted buckets of some million shingles as packed differences, one row for each of 2 ** bits ranges.
    """
    low = np.uint32(32 - bits)

    def ranges_of(held):
        found = np.sort(np.concatenate(held))
        starts = _starts(found >> low)
        return pa.RecordBatch.from_arrays(
            [pa.array([int(found[a] >> low) for a, _ in starts], pa.int64()), pa.array([_packed(found[a:b]) for a, b in starts], pa.binary())],
            names=["_range", "_packed"],
        )

    def cut(batches):
        held, n = [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if len(bucket := _bucket(shingle_hashes(text, width))):
                    held.append(bucket)
                    n += len(bucket)
                if n >= PACKED:
                    yield ranges_of(held)
                    held, n = [], 0
        if held:
            yield ranges_of(held)

    def count(batches):
        for table in whole_groups(batches):
            at = table.column(0).to_numpy()
            for a, b in _starts(at):
                parts = [_unpacked(raw.as_py()) for raw in table.column(1).slice(a, b - a)]
                bucket, n = np.unique(np.concatenate(parts), return_counts=True)
                hot = n >= HOT
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[hot].astype(np.int64)), pa.array(np.log2(n[hot]).astype(np.int32))], names=["_bucket", "_class"]
                )

    ranges = texts.select("_text").mapInArrow(cut, "_range bigint, _packed binary")
    return ranges.repartition("_range").sortWithinPartitions("_range").mapInArrow(count, "_bucket bigint, _class int")


def _frequency_classes(steps: Steps, texts: DataFrame, width: int) -> np.ndarray:
    """One byte for each of `CELLS` cells of buckets: how frequent its most frequent shingle is, 0 where none is hot.

    Documents of a shingle are counted over the whole corpus; the table has the most frequent ones, at most `MOST_HOT`.
    """
    bits = min(20, max(6, (4 * texts.rdd.getNumPartitions()).bit_length()))
    hot = steps.keep("hot", _counted(texts, width, bits))
    least, room = 64, MOST_HOT
    for r in sorted(hot.groupBy("_class").agg(F.count(F.lit(1)).alias("_n")).collect(), reverse=True):
        room -= r["_n"]
        if room < 0:
            break
        least = r["_class"]
    rows = hot.filter(F.col("_class") >= least).toArrow()
    table = np.zeros(CELLS, np.uint8)
    np.maximum.at(table, rows.column(0).to_numpy() * CELLS >> 32, rows.column(1).to_numpy().astype(np.uint8))
    steps.drop("hot")
    return table


def _sketches(texts: DataFrame, classes, width: int, percent: int) -> DataFrame:
    """(_doc, _n, _set, _point, _first): size, digest, count vector and the shingles whose shards a set belongs to.

    Of equal sets in a batch only the one with the least `_doc` has the last two.
    """

    def run(batches):
        for batch in batches:
            batch = batch.sort_by("_doc")
            sizes, sets, points, firsts, seen = [], [], [], [], set()
            for text in batch.column(1).to_pylist():
                s = shingle_hashes(text, width)
                sizes.append(len(s))
                sets.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                if sets[-1] in seen:
                    points.append(None)
                    firsts.append(np.empty(0, np.int64))
                    continue
                seen.add(sets[-1])
                points.append(point(s).tobytes())
                order = (classes.value[(_bucket(s).astype(np.int64) * CELLS) >> 32].astype(np.uint64) << _U(58)) | (s >> _U(6))
                firsts.append(s[np.argsort(order, kind="stable")[: prefix_length(len(s), percent)]].view(np.int64))
            ends = np.cumsum([0, *map(len, firsts)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()), pa.array(points, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*firsts, np.empty(0, np.int64)]))),
                ],
                names=["_doc", "_n", "_set", "_point", "_first"],
            )

    return texts.select("_doc", "_text").mapInArrow(run, "_doc bigint, _n bigint, _set binary, _point binary, _first array<bigint>")


def _shards(steps: Steps, sketches: DataFrame, firsts: DataFrame, percent: int) -> DataFrame:
    """(_shard, _doc, _size, _weight, _pivot) of the shards with several members, each set of members once.

    A shard has the documents of one shingle whose sizes lie in two neighbouring levels. A level is as wide as the sizes
    of linked sets may differ, so each document stands in two shards of a shingle and each linked pair meets in one.
    """
    postings = sketches.select(F.explode("_first").alias("_shingle"), "_doc", "_n")
    shared = postings.groupBy("_shingle").agg(F.count(F.lit(1)).alias("_k")).filter("_k > 1").select("_shingle")
    level = F.floor(F.log("_n") / (math.log(100 / percent) * (1 + 1e-9)))
    # An inner join, as Spark would put a semi join below the explode and shuffle all prefixes for it.
    rows = postings.join(shared, "_shingle").join(firsts.select(F.col("_first").alias("_doc")), "_doc").select(F.explode(F.array(level, level + 1)).alias("_level"), "_shingle", "_doc", "_n").select(
        F.xxhash64("_shingle", "_level").alias("_shard"), "_doc", "_n"
    )
    rows = steps.keep("levels", rows)
    steps.drop()
    sizes = rows.groupBy("_shard").agg(
        F.count(F.lit(1)).alias("_size"), F.sum("_n").alias("_weight"), F.min("_doc").alias("_pivot"), F.max("_doc").alias("_top"),
        F.bit_xor(F.xxhash64("_doc", F.lit(1))).alias("_x"), F.bit_xor(F.xxhash64("_doc", F.lit(2))).alias("_y"),
    ).filter("_size > 1")
    kept = sizes.groupBy("_size", "_weight", "_pivot", "_top", "_x", "_y").agg(F.min("_shard").alias("_shard"))
    return steps.keep("members", rows.join(kept.select("_shard", "_size", "_weight", "_pivot"), "_shard").drop("_n"))


def _blocks():
    """How many blocks a shard is cut into, so that a unit has a bounded number of members and, as a rule, of shingles."""
    return F.greatest(F.ceil(F.col("_size") / SHARD), F.ceil(F.col("_weight") / SHARD_SHINGLES)).cast("bigint")


# ------------------------------------------------------------------ units


def _starts(keys: np.ndarray) -> list[tuple[int, int]]:
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]).tolist()
    return list(zip(first, [*first[1:], len(keys)]))


def _possible(units: DataFrame, percent: int) -> DataFrame:
    """(_unit, _doc, _label) of members whose tree leaves them a partner in another component that no smaller shard has too."""

    def run(batches):
        for table in whole_groups(batches):
            unit, doc, label = (table.column(i).to_numpy() for i in range(3))
            points = np.frombuffer(b"".join(table.column(3).to_pylist()), np.int32).reshape(-1, GROUPS)
            shared = table.column(4).to_pylist()
            keep = np.zeros(len(unit), bool)
            for a, b in _starts(unit):
                own = [set(s or ()) for s in shared[a:b]]
                for i, j in CountTree(points[a:b], percent).pairs():
                    open_ = label[a:b][i] != label[a:b][j]
                    for x, y in zip(i[open_].tolist(), j[open_].tolist()):
                        if not (keep[a + x] and keep[a + y]) and own[x].isdisjoint(own[y]):
                            keep[a + x] = keep[a + y] = True
            for batch in table.filter(pa.array(keep)).select([0, 1, 2]).combine_chunks().to_batches():
                yield batch

    rows = units.select("_unit", "_doc", "_label", "_point", "_less")
    return rows.repartition("_unit").sortWithinPartitions("_unit").mapInArrow(run, "_unit bigint, _doc bigint, _label bigint")


def _filter(docs: DataFrame) -> np.ndarray:
    """A bit map of `FILTER_BITS` hashed ids."""
    at = F.pmod(F.xxhash64("_doc"), F.lit(FILTER_BITS))
    words = docs.select(at.alias("_at")).groupBy(F.shiftright("_at", 5).cast("int").alias("_w")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(_at & 31 AS INT))")).alias("_bits")
    ).toArrow()
    found = np.zeros(FILTER_BITS // 32, np.uint32)
    found[words.column(0).to_numpy()] = words.column(1).to_numpy().astype(np.uint32)
    return found


def _sets(members: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """(_doc, _shingles) of the texts of which there are members; a bit map keeps nearly all others from the exchange."""
    spark = members.sparkSession
    bits = spark.sparkContext.broadcast(_filter(members))

    def run(batches):
        for batch in batches:
            at = batch.column(2).to_numpy(zero_copy_only=False)
            wanted = (bits.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1
            some = batch.filter(pa.array(wanted.astype(bool)))
            for part in range(0, some.num_rows, 64):
                piece = some.slice(part, 64)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array([shingle_hashes(t, width).tobytes() for t in piece.column(1).to_pylist()], pa.binary())], names=["_doc", "_shingles"]
                )

    rows = texts.select("_doc", "_text", F.pmod(F.xxhash64("_doc"), F.lit(FILTER_BITS)).alias("_at"))
    return rows.mapInArrow(run, "_doc bigint, _shingles binary")


def _verified(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (_u, _v) between a unit's members: pairs that its tree leaves, not connected yet, compared on their full sets."""

    def links(doc, label, sets):
        size = np.array([len(s) for s in sets])
        part = np.unique(label, return_inverse=True)[1]
        for i, j in CountTree(np.stack([point(s) for s in sets]), percent).pairs():
            for x, y in zip(i.tolist(), j.tolist()):
                if part[x] == part[y]:
                    continue
                small, large = (x, y) if size[x] <= size[y] else (y, x)
                at = np.minimum(np.searchsorted(sets[large], sets[small]), size[large] - 1)
                both = int((sets[large][at] == sets[small]).sum())
                if 100 * both >= percent * int(size[x] + size[y] - both):
                    part[part == part[y]] = part[x]
                    yield int(doc[x]), int(doc[y])

    def run(batches):
        for table in whole_groups(batches):
            unit, doc, label = (table.column(i).to_numpy() for i in range(3))
            out = []
            for a, b in _starts(unit):
                sets = [np.frombuffer(raw.as_py(), np.uint64) for raw in table.column(3).slice(a, b - a)]
                out += links(doc[a:b], label[a:b], sets)
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["_u", "_v"])

    rows = broadcast_if_small(members).join(sets, "_doc").select("_unit", "_doc", "_label", "_shingles")
    return rows.repartition("_unit").sortWithinPartitions("_unit").mapInArrow(run, "_u bigint, _v bigint")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, "_doc", "left").withColumn("_label", F.coalesce("_label", "_doc"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, percent: int = 90) -> DataFrame:
    """One row per row of `docs`: id, n_shingles, component_id.

    Linked are documents whose sets of `width`-word shingles have 100 * common >= percent * all; words are divided
    by ASCII white space, A-Z lower-cased. Null text counts as empty; a document without words is linked with
    nothing, one with fewer than `width` words has one shingle. component_id is the least id that links lead to,
    itself included. Rows that repeat an id are documents of their own, of which the first in the order of
    (id, text) counts as the least; a null id sorts first and gives a null component_id. An empty table gives no rows,
    other columns are not read. Shingles are compared by 64-bit hashes, equal sets by a 128-bit digest of them:
    two different shingles of a pair of texts of 20 000 words are taken for one with a probability of 2e-11.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    texts, unique = keyed(docs, id_col, text_col)
    steps = Steps(spark, "grouptree")
    classes = spark.sparkContext.broadcast(_frequency_classes(steps, texts, width))
    sketches = steps.keep("sketches", _sketches(texts, classes, width, percent))
    firsts = steps.keep("firsts", sketches.filter("_n > 0").groupBy("_set").agg(F.min("_doc").alias("_first")))
    members = _shards(steps, sketches, firsts, percent)
    steps.drop("levels")

    # Small shards as they are, larger ones in blocks with their first member.
    whole = _blocks() == 1
    of = lambda b: F.xxhash64("_shard", b)
    own = F.pmod(F.xxhash64("_doc"), _blocks())
    place = F.when(F.col("_doc") == F.col("_pivot"), F.transform(F.sequence(F.lit(0).cast("bigint"), _blocks() - 1), of)).otherwise(F.array(of(own)))
    small = F.filter(F.col("_own"), lambda s: s < F.when(whole, F.col("_shard")).otherwise(F.lit((1 << 63) - 1)))
    mine = members.filter(whole).groupBy("_doc").agg(F.collect_list("_shard").alias("_own"))
    points = sketches.select("_doc", "_point").join(members.select("_doc").distinct(), "_doc", "left_semi")
    known = steps.keep("points", points.join(mine, "_doc", "left"))
    units = members.join(known, "_doc").select(F.explode(place).alias("_unit"), "_doc", F.col("_doc").alias("_label"), "_point", small.alias("_less"))
    possible = steps.keep("possible", _possible(units, percent))
    sets = _sets(possible, texts, width)
    links = steps.keep("links", _verified(possible, sets, percent))
    steps.drop()
    labels = components(links)

    # Larger shards that are not one component: members outside the largest one meet all others.
    large = members.filter(~whole)
    if large.limit(1).count():
        large = steps.keep("large", _labelled(large, labels))
        parts = large.groupBy("_shard", "_label").agg(F.count(F.lit(1)).alias("_k"), F.sum("_weight").alias("_w"))
        main = parts.groupBy("_shard").agg(F.max_by("_label", "_k").alias("_main"), F.max("_k").alias("_inside"), F.count(F.lit(1)).alias("_parts"))
        rows = large.join(main.filter("_parts > 1"), "_shard").withColumn("_in", F.col("_label") == F.col("_main"))
        share = lambda k: F.greatest(F.ceil(k * _blocks() / F.col("_size")), F.lit(1)).cast("bigint")
        inside, outside = share(F.col("_inside")), share(F.col("_size") - F.col("_inside"))
        block = lambda n: F.pmod(F.xxhash64("_doc"), n)
        count = lambda n: F.sequence(F.lit(0).cast("bigint"), n - 1)
        meet = lambda kind, a, b: F.xxhash64("_shard", F.lit(kind), a, b)
        outer = F.concat(
            F.transform(count(outside), lambda b: meet("out", F.least(block(outside), b), F.greatest(block(outside), b))),
            F.transform(count(inside), lambda b: meet("in", block(outside), b)),
        )
        inner = F.transform(count(outside), lambda b: meet("in", b, block(inside)))
        units = rows.select(F.explode(F.when(F.col("_in"), inner).otherwise(outer)).alias("_unit"), "_doc", "_label").join(known, "_doc").select(
            "_unit", "_doc", "_label", "_point", F.col("_own").alias("_less")
        )
        possible = steps.keep("possible-large", _possible(units, percent))
        more = steps.keep("links-large", _verified(possible, _sets(possible, texts, width), percent))
        steps.drop()
        labels = components(links.unionByName(more))

    steps.drop("members", "points", "possible", "links", "large", "possible-large", "links-large")
    named = firsts.join(labels, firsts["_first"] == labels["_doc"], "left").select("_set", F.coalesce("_label", "_first").alias("_component"))
    rows = sketches.select("_doc", "_n", F.when(F.col("_n") > 0, F.col("_set")).alias("_set")).join(named, "_set", "left").select(
        "_doc", "_n", F.coalesce("_component", "_doc").alias("_component")
    )
    if unique:
        out = rows.select(F.col("_doc").alias("_id"), "_n", F.col("_component").alias("component_id"))
    else:
        ids = texts.select("_doc", "_id")
        out = rows.join(ids, "_doc").join(ids.select(F.col("_doc").alias("_component"), F.col("_id").alias("component_id")), "_component")
    return out.select(F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"), "component_id")
