"""Sharding by a k-d tree: leaves of equal bytes, cut at distributed weighted medians.

A node with k leaves is cut along its widest metadata dimension so that k // 2 leaves' share of its
bytes goes left. The order along a dimension is (value, hash of the text, hash of the id), so equal
texts stand together and are divided only if they alone exceed the tolerance, and a value that a
third of all rows share can still be cut anywhere.

A median is found by histograms: each pass sums the bytes of all nodes of a level in at most `CELLS`
cells a node and goes on inside the cell that holds the cut, so the driver sees a bounded table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import ranked, whole_text, written

CELLS = 1_024
# A cut may miss its share by this part of a leaf.
TOLERANCE = 0.001
_KEYS = 2  # hashes that order the rows of one value


@dataclass
class _Cut:
    """Where a node is being cut: keys fixed so far, the range of the next one, bytes still to go left."""

    leaves: int
    first: int
    dim: int = 0
    done: bool = False
    fixed: list[int] = field(default_factory=list)
    lo: int = 0
    hi: int = 0
    todo: float = 0.0

    def key(self, at: int) -> Column:
        return F.col(f"_d{self.dim}") if at == 0 else F.col(f"_k{at}")

    def inside(self) -> Column:
        same = F.lit(True)
        for i, v in enumerate(self.fixed):
            same = same & (self.key(i) == v)
        return same & self.key(len(self.fixed)).between(self.lo, self.hi)

    def left(self) -> Column:
        """Rows before the cut, which is right before `lo` of the current key."""
        out = self.key(len(self.fixed)) < self.lo
        for i in range(len(self.fixed) - 1, -1, -1):
            out = (self.key(i) < self.fixed[i]) | ((self.key(i) == self.fixed[i]) & out)
        return out


def _per_node(nodes: dict[int, Column], default: Column) -> Column:
    out = default
    for node, value in nodes.items():
        out = F.when(F.col("_node") == node, value).otherwise(out)
    return out


def _find_cuts(rows: DataFrame, cuts: dict[int, _Cut], tolerance: float) -> None:
    """Narrow all cuts of a level at once until each is within the tolerance or between two rows' keys."""
    while todo := {n: c for n, c in cuts.items() if not c.done}:
        width = {n: -(-(c.hi - c.lo + 1) // CELLS) for n, c in todo.items()}
        cell = _per_node(
            {n: F.when(c.inside(), F.floor((c.key(len(c.fixed)) - c.lo) / width[n])) for n, c in todo.items()}, F.lit(None).cast("bigint")
        )
        sums: dict[int, list[tuple[int, int]]] = {n: [] for n in todo}
        for node, at, size in rows.withColumn("_cell", cell).filter("_cell IS NOT NULL").groupBy("_node", "_cell").agg(F.sum("_size")).collect():
            sums[node].append((at, size))
        for node, c in todo.items():
            for at, size in sorted(sums[node]):
                if size <= c.todo:
                    c.todo -= size
                    continue
                lo, hi = c.lo + at * width[node], min(c.hi, c.lo + (at + 1) * width[node] - 1)
                if size <= tolerance or (lo == hi and len(c.fixed) == _KEYS):
                    c.lo, c.done = (hi + 1 if 2 * c.todo > size else lo), True
                elif lo == hi:
                    c.fixed, c.lo, c.hi = [*c.fixed, lo], 0, (1 << 52) - 1
                else:
                    c.lo, c.hi = lo, hi
                break
            else:
                c.lo, c.done = c.hi + 1, True


def kd_shards(rows: DataFrame, dims: list[str], size: str, text_key: str, id_key: str, shards: int) -> DataFrame:
    """`rows` with the column `shard` (0 to shards - 1). Dimensions are whole numbers; nulls are a value below all."""
    keep = rows.columns
    hashed = lambda c: F.shiftrightunsigned(F.xxhash64(c), 12)
    table = rows.select(
        *keep, F.col(size).cast("double").alias("_size"), F.lit(0).alias("_node"), hashed(text_key).alias("_k1"), hashed(id_key).alias("_k2"),
        *[F.coalesce(F.col(d).cast("bigint"), F.lit(-1)).alias(f"_d{i}") for i, d in enumerate(dims)],
    )
    extents = [f(f"_d{i}").alias(f"{n}{i}") for i in range(len(dims)) for n, f in (("lo", F.min), ("hi", F.max))]
    leaves = {0: (shards, 0)}  # node -> leaves below it, number of the first
    whole: dict[int, int] = {}
    target = 0.0
    while any(k > 1 for k, _ in leaves.values()):
        found = {r["_node"]: r for r in table.groupBy("_node").agg(F.sum("_size").alias("total"), *extents).collect()}
        if not whole and found:
            whole = {i: max(1, found[0][f"hi{i}"] - found[0][f"lo{i}"]) for i in range(len(dims))}
            target = found[0]["total"] / shards
        cuts = {}
        for node, (k, first) in leaves.items():
            if k > 1 and node in found:
                r = found[node]
                dim = max(range(len(dims)), key=lambda i: ((r[f"hi{i}"] - r[f"lo{i}"]) / whole[i], -i))
                cuts[node] = _Cut(k, first, dim, lo=r[f"lo{dim}"], hi=r[f"hi{dim}"], todo=r["total"] * (k // 2) / k)
        _find_cuts(table, cuts, TOLERANCE * target)
        # Children of a node n are 2n + 1 and 2n + 2; a node without rows has none.
        child = {n: F.when(c.left(), F.lit(2 * n + 1)).otherwise(F.lit(2 * n + 2)) for n, c in cuts.items()}
        table = written(table.withColumn("_node", _per_node(child, F.col("_node"))), "level")  # else the expressions nest
        below = {}
        for node, (k, first) in leaves.items():
            if node in cuts:
                below[2 * node + 1], below[2 * node + 2] = (k // 2, first), (k - k // 2, first + k // 2)
            elif k == 1:
                below[node] = (k, first)
        leaves = below
    shard = _per_node({node: F.lit(first) for node, (_, first) in leaves.items()}, F.lit(0))
    return table.withColumn("shard", shard.cast("int")).select(*keep, "shard")


def shard_documents(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of `docs`: id, size, text_crc32, law, shard, slot, grown_shard.

    Shards are near equal in bytes (law `bytes`): a document counts its UTF-8 bytes, none for a null
    text, and 8 more. Dimensions are the size (logarithm), the language and the share of bytes
    beyond ASCII, all of which equal texts mostly share. Slots number each shard's rows from 0 in no
    particular order; grown_shard is null under this law. Repeated rows, null ids and null languages
    are rows like others. Texts are read once and never shuffled.
    """
    text = whole_text(text_col)
    size = F.octet_length(text) + 8
    lang = F.crc32(F.coalesce(F.col(lang_col).cast("string"), F.lit("")).cast("binary")) if lang_col in docs.columns else F.lit(0)
    light = written(
        docs.select(
            F.col(id_col).cast("bigint").alias("_id"), size.cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("_text"), F.floor(F.log2(size) * 65_536).alias("_log"), F.pmod(lang, F.lit(65_536)).alias("_lang"),
            F.floor((F.octet_length(text) - F.char_length(text)) / size * 1_048_576).alias("_beyond"),
        ),
        "light",
    )
    placed = kd_shards(light, ["_log", "_lang", "_beyond"], "size", "_text", "_id", shards)
    return ranked(placed, "shard", ["_id", "_text"], "slot").select(
        F.col("_id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
