"""Removal of repeated byte strings by column-wise construction of suffix orders.

A byte is removed when a string of `length` bytes that covers it also starts earlier in the corpus.

1. Every window of `length` bytes has an anchor, the k-gram with the least hash in it (the leftmost of
   equals). Consecutive windows with one anchor form a piece. Equal windows have equal anchors at the
   same place, so only pieces with the same anchor can share a window.
2. Anchors that occur once are dropped. Occurrences of one and the same piece collapse to the first of
   them; all windows of the others start earlier as well.
3. The pieces that are left, aligned at their anchors, go through the construction: from the last
   column to the first, one symbol per piece is put before its suffix. A stable sort by that symbol
   turns the order of the suffixes of one column into that of the next (the symbols in this order are
   the column's part of the Burrows-Wheeler transform), and the common prefix of two neighbours is one
   more than the least common prefix between their former places, or none if their symbols differ.
   Neighbours with a common prefix of `length` or more form a class of equal windows; all but the
   class's first in the corpus are marked.

The files that the construction goes through in sequence are Spark's shuffle files: each task reads
its pieces in the order of their anchors and holds only some thousands of them at a time. Anchors
with more different pieces than `HOT_PIECES` are cut into single windows, which are grouped by a
128-bit hash instead: equal windows collapse before the shuffle, however many there are.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gristmill.llm.common import Steps, bounded_batches, fresh, keyed, make_room, whole_groups, with_row_key, written

LENGTH = 100
GRAM = 24
# Different pieces of one anchor that one task takes together.
HOT_PIECES = 10_000
# Pieces that the construction takes at a time; groups are never divided.
CHUNK_PIECES = 16_384
# Window starts of a long text that are hashed at a time.
SEGMENT = 1 << 17

_LOCAL = np.uint64((1 << 20) - 1)
_BASE = 0x5851F42D4C957F2D
_U = np.uint64


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    up = np.full(n, _U(_BASE))
    down = np.full(n, _U(pow(_BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0x9E3779B97F4A7C15)
    h = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(32))


def _sums(data: np.ndarray, up: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + _U(1)) * up[: len(data)], dtype=np.uint64, out=out[1:])
    return out


def pieces_of(raw: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hashes, piece hashes, and places: first start << 20 | windows << 10 | anchor - first start."""
    data = np.frombuffer(raw, np.uint8)
    width = length - gram + 1
    anchors, hashes, places = [], [], []
    up, down = _powers(SEGMENT + length + 1)
    for base in range(0, len(data) - length + 1, SEGMENT):
        part = data[base : base + SEGMENT + length - 1]
        sums, windows = _sums(part, up), len(part) - length + 1
        n = len(part) - gram + 1
        grams = _mix((sums[gram : gram + n] - sums[:n]) * down[:n])
        key = (grams & ~_LOCAL) | np.arange(n, dtype=np.uint64)
        blocks = np.full(-(-n // width) * width, _U(2**64 - 1))
        blocks[:n] = key
        blocks = blocks.reshape(-1, width)
        before = np.minimum.accumulate(blocks, axis=1).ravel()
        after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(after[:windows], before[width - 1 : width - 1 + windows])
        first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        count = np.diff(np.r_[first, windows])
        anchor = (least[first] & _LOCAL).astype(np.int64)
        anchors.append(grams[anchor])
        hashes.append(_mix((sums[first + count + length - 1] - sums[first]) * down[first]))
        places.append((first + base) << 20 | count << 10 | (anchor - first))
    if not anchors:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(anchors).view(np.int64), np.concatenate(hashes).view(np.int64), np.concatenate(places)


def _joined_spans(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of window starts, those that touch in one text made one."""
    if not len(owner):
        return owner, start, end
    order = np.lexsort((start, owner))
    owner, start, end = owner[order], start[order], end[order]
    new = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (start[1:] != end[:-1])])
    last = np.r_[new[1:], len(owner)] - 1
    return owner[new], start[new], end[last]


def _scan(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Pieces (_a, _p, _at, _doc), and in rows without an _a spans (_at, _p) of windows known to come again.

    Of a piece that a batch of texts has several times, only the first in the corpus goes on: its
    further occurrences start later than that one, so their windows are marked on the spot. Copies
    and periodic texts thus leave a task once for each batch.
    """

    def run(batches):
        make_room("suffix: pieces")
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            found = [pieces_of((t or "").encode(), length, gram) for t in batch.column(1).to_pylist()]
            if not found:
                continue
            owner = np.repeat(ids, [len(f[0]) for f in found])
            a, p, at = (np.concatenate([f[i] for f in found]) for i in range(3))
            order = np.lexsort((at, owner, p, a))
            a, p, at, owner = a[order], p[order], at[order], owner[order]
            first = np.r_[True, (a[1:] != a[:-1]) | (p[1:] != p[:-1])] if len(a) else np.empty(0, bool)
            start, count = at[~first] >> 20, at[~first] >> 10 & 1023
            of, s, e = _joined_spans(owner[~first], start, start + count)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([pa.array(a[first], pa.int64()), pa.nulls(len(of), pa.int64())]), pa.array(np.r_[p[first], e], pa.int64()),
                    pa.array(np.r_[at[first], s], pa.int64()), pa.array(np.r_[owner[first], of], pa.int64()),
                ],
                names=["_a", "_p", "_at", "_doc"],
            )

    return docs.mapInArrow(run, "_a bigint, _p bigint, _at bigint, _doc bigint")


def marked_windows(group: np.ndarray, columns: np.ndarray, begin: np.ndarray, end: np.ndarray, rank: np.ndarray, length: int, width: int) -> np.ndarray:
    """For each of the first `width` columns and each piece: does its window there start earlier elsewhere?

    `columns[c]` holds the symbols of column c; a piece has those from `begin` to `end`. `group` is
    sorted and numbers the anchors; `rank` orders the pieces by their place in the corpus.
    """
    n = len(group)
    marked = np.zeros((width, n), bool)
    order = np.arange(n)
    common = np.zeros(n, np.int16)  # with the neighbour before
    group16 = group.astype(np.uint16)
    for c in range(len(columns) - 1, -1, -1):
        symbol = columns[c].astype(np.uint16)
        symbol[(begin > c) | (end <= c)] = 256
        if symbol.min() == 256:
            continue
        here = symbol[order]
        by_symbol = np.argsort(here, kind="stable")
        place = by_symbol[np.argsort(group16[order[by_symbol]], kind="stable")]
        order = order[place]
        here, owner = here[place], group16[order]
        same = np.flatnonzero((here[1:] == here[:-1]) & (owner[1:] == owner[:-1]) & (here[1:] < 256))
        lo, hi = place[same] + 1, place[same + 1]
        least = common[hi].copy()
        far = np.flatnonzero(hi > lo)
        if len(far):
            # Ranges in falling order of their starts; the entries between them cost nothing.
            far = far[np.argsort(-lo[far], kind="stable")]
            bounds = np.empty(2 * len(far), np.int64)
            bounds[::2], bounds[1::2] = lo[far], hi[far] + 1
            padded = np.r_[common, np.int16(0)]
            least[far] = np.minimum.reduceat(padded, bounds)[::2]
        common = np.zeros(n, np.int16)
        common[same + 1] = np.minimum(least + 1, length)
        if c < width:
            starts = np.flatnonzero(common < length)
            if len(starts) < n:
                ranks = rank[order]
                best = np.repeat(np.minimum.reduceat(ranks, starts), np.diff(np.r_[starts, n]))
                marked[c, order] = ranks != best
    return marked


def _construct(pieces: DataFrame, length: int, gram: int) -> DataFrame:
    """Spans of marked windows from pieces (_a, _doc, _at, _raw) that share anchors."""
    width = length - gram + 1

    def spans(anchor, doc, at, raw):
        start, count, off = at >> 20, at >> 10 & 1023, at & 1023
        group = np.cumsum(np.r_[0, anchor[1:] != anchor[:-1]])
        begin = width - 1 - off
        end = begin + count + length - 1
        columns = np.zeros((width + length, len(at)), np.uint8)
        sizes = count + length - 1
        flat = np.frombuffer(b"".join(raw), np.uint8)
        owner = np.repeat(np.arange(len(at)), sizes)
        column = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes - begin, sizes)
        columns[column, owner] = flat
        rank = np.empty(len(at), np.int64)
        rank[np.lexsort((start + off, doc))] = np.arange(len(at))
        marked = marked_windows(group, columns, begin, end, rank, length, width)
        edge = np.diff(np.pad(marked, ((1, 1), (0, 0))).astype(np.int8), axis=0).T
        who, first = np.nonzero(edge == 1)
        _, last = np.nonzero(edge == -1)
        zero = (start + off)[who] - (width - 1)
        return pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (doc[who], zero + first, zero + last)], names=["_doc", "_s", "_e"]
        )

    def run(batches):
        make_room("suffix: construction")
        for table in whole_groups(batches):
            anchor, doc, at, raw = (c.to_numpy(zero_copy_only=False) for c in table.columns)
            for a, b in _chunks(anchor):
                yield spans(anchor[a:b], doc[a:b], at[a:b], raw[a:b])

    return pieces.mapInArrow(run, "_doc bigint, _s bigint, _e bigint")


def _chunks(anchor: np.ndarray):
    """Slices of whole groups with about CHUNK_PIECES pieces each."""
    if not len(anchor):
        return
    starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    at = 0
    while at < len(anchor):
        i = np.searchsorted(starts, at + CHUNK_PIECES)
        end = int(starts[i]) if i < len(starts) else len(anchor)
        yield at, end
        at = end


def _cut_pieces(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """Bytes of the wanted pieces (_doc, _a, _at); a document's list is bounded by its size."""
    lists = wanted.groupBy("_doc").agg(F.collect_list(F.struct("_a", "_at")).alias("_list"))

    def run(batches):
        make_room("suffix: bytes")
        for batch in batches:
            doc, anchor, at, raw = [], [], [], []
            for i, text, places in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.encode()
                for place in places:
                    start, count = place["_at"] >> 20, place["_at"] >> 10 & 1023
                    doc.append(i)
                    anchor.append(place["_a"])
                    at.append(place["_at"])
                    raw.append(data[start : start + count + length - 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor, pa.int64()), pa.array(doc, pa.int64()), pa.array(at, pa.int64()), pa.array(raw, pa.binary())],
                names=["_a", "_doc", "_at", "_raw"],
            )

    joined = docs.join(lists, "_doc").select("_doc", "_text", "_list")
    return joined.mapInArrow(run, "_a bigint, _doc bigint, _at bigint, _raw binary")


def _single_windows(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """Spans of later windows among the pieces of hot anchors, by the windows' own hashes."""

    def run(batches):
        make_room("suffix: windows")
        for batch in batches:
            rows = []
            for anchor, doc, at, raw in zip(*(c.to_pylist() for c in batch.columns)):
                for i in range(at >> 10 & 1023):
                    digest = hashlib.blake2b(raw[i : i + length], digest_size=16).digest()
                    rows.append((digest, doc, (at >> 20) + i))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())],
                names=["_h", "_doc", "_s"],
            )

    windows = written(_cut_pieces(docs, wanted, length).mapInArrow(run, "_h binary, _doc bigint, _s bigint"), "windows")
    firsts = windows.groupBy("_h").agg(F.min(F.struct("_doc", "_s")).alias("_first"))
    later = windows.join(firsts, "_h").filter(F.struct("_doc", "_s") != F.col("_first"))
    return later.select("_doc", "_s", (F.col("_s") + 1).alias("_e"))


def repeated_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(_doc, _s, _e): windows starting from _s up to before _e start earlier elsewhere, from (_doc, _text)."""
    gram = min(gram, length)
    steps = Steps(texts.sparkSession, "repeats")
    everything = steps.keep("pieces", _scan(texts, length, gram))
    parts = [steps.keep("known", everything.filter("_a IS NULL").select("_doc", F.col("_at").alias("_s"), F.col("_p").alias("_e")))]
    scanned = everything.filter("_a IS NOT NULL")
    again = scanned.groupBy("_a").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_a")
    # A piece comes once from each batch at most, so the rows of one piece stay few for a task to number.
    nth = F.row_number().over(W.partitionBy("_a", "_p").orderBy("_doc", "_at"))
    shared = steps.keep("shared", scanned.join(again, "_a").repartition("_a", "_p").withColumn("_nth", nth))
    steps.drop("pieces")
    start, count = F.shiftright("_at", 20), F.shiftright("_at", 10).bitwiseAND(F.lit(1023))
    parts.append(steps.keep("later", shared.filter("_nth > 1").select("_doc", start.alias("_s"), (start + count).alias("_e"))))
    steps.drop()
    firsts = shared.filter("_nth = 1").select("_a", "_doc", "_at")
    kinds = firsts.groupBy("_a").agg(F.count(F.lit(1)).alias("_kinds")).filter("_kinds > 1")
    differing = firsts.join(kinds, "_a")
    regular = _cut_pieces(texts, differing.filter(F.col("_kinds") <= HOT_PIECES), length)
    parts.append(steps.keep("marked", _construct(regular.repartition("_a").sortWithinPartitions("_a"), length, gram)))
    steps.drop()
    if kinds.filter(F.col("_kinds") > HOT_PIECES).limit(1).count():
        parts.append(steps.keep("hot", _single_windows(texts, differing.filter(F.col("_kinds") > HOT_PIECES), length)))
    steps.drop("shared")
    return functools.reduce(DataFrame.unionByName, parts)


def _merged(spans: list, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the windows."""
    runs: list[tuple[int, int]] = []
    for s, e in sorted((x["_s"], x["_e"] + length - 1) for x in spans or ()):
        if runs and s <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(e, runs[-1][1]))
        else:
            runs.append((s, e))
    return runs


def _cut(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for s, e in runs:
        kept.append(raw[at:s])
        at = e
    return b"".join(kept) + raw[at:]


def _whole_characters(raw: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs without the parts of characters at their ends."""
    inside = []
    for s, e in runs:
        while s < len(raw) and raw[s] & 0xC0 == 0x80:
            s += 1
        while e < len(raw) and raw[e] & 0xC0 == 0x80:
            e -= 1
        if s < e:
            inside.append((s, e))
    return inside


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per row of `docs`: id, n_bytes, n_removed, n_spans, kept_sha256, kept_text.

    Rows come in the order of (id, text), null ids first; null texts count as empty. A row that
    repeats another row is a later document, so it loses all of its bytes if it has `length` of
    them. Texts shorter than `length` bytes lose nothing. kept_text leaves whole the characters that
    the removed bytes only partly cover; the digest is of exactly the remaining bytes.
    """
    spark = docs.sparkSession
    bounded_batches(spark, 4)
    texts, _ = keyed(docs, id_col, text_col)
    spans = repeated_spans(texts.select("_doc", "_text"), length).groupBy("_doc").agg(F.collect_list(F.struct("_s", "_e")).alias("_spans"))

    def run(batches):
        make_room("suffix: cut")
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw = text.encode()
                runs = _merged(spans, length)
                row = (
                    len(raw), sum(e - s for s, e in runs), len(runs), hashlib.sha256(_cut(raw, runs)).hexdigest(),
                    _cut(raw, _whole_characters(raw, runs)).decode() if runs else text,
                )
                for column, value in zip(out, row):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, k) for x, k in zip(out, kinds))],
                names=["_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"],
            )

    schema = "_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string"
    joined = texts.join(spans, "_doc", "left").select("_id", "_text", "_spans")
    return joined.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def drop_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, chars_col: str = "n_chars"
) -> DataFrame:
    """All rows of `docs` with the repeated strings cut out of their texts, and `chars_col`, if there, counted anew.

    A row stays even if nothing of its text does; a null text stays null.
    """
    rows, key = with_row_key(docs, id_col, text_col)
    row, kept, null = (fresh(rows.columns, name) for name in ("__cut_row__", "__kept_text__", "__null__"))
    cut = cut_repeats(rows, key, text_col, length).select(F.col(key).alias(row), F.col("kept_text").alias(kept))
    others = rows.withColumn(null, F.col(text_col).isNull()).drop(text_col)
    new = {text_col: F.when(~F.col(null), F.col(kept)).cast(docs.schema[text_col].dataType)}
    if chars_col in docs.columns:
        known = F.col(chars_col).isNotNull() & ~F.col(null)
        new[chars_col] = F.when(known, F.char_length(kept).cast(docs.schema[chars_col].dataType)).otherwise(F.col(chars_col))
    return others.join(cut, F.col(key) == F.col(row)).withColumns(new).select(*docs.columns)
