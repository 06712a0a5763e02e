"""Best-fit packing of token sequences after a Martello-Toth dominance reduction.

Sizes are whole numbers up to the capacity, so the instance is a histogram with at most `capacity`
cells. The plan is made on that histogram (for the driver a bounded table, however many documents
there are), with many equal sets fixed in one step. Each row then finds its place from its rank
among the pieces of its size.
"""

from __future__ import annotations

import bisect
import functools
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import bounded_batches, make_room, ranked, written

CAPACITY = 2_048
END_ID = 0

# Chunks whose ids a Python process remembers before it starts afresh.
MEMO_CHUNKS = 1_200_000

# Texts of these characters alone split at white space into chunks that encode independently.
_PLAIN = re.compile("[^\t\n\r\x20-\x7e¡-ɏ]|<\\|")
_MARK = "\x01"


class ChunkEncoder:
    """Token ids of whole texts, with the ids of chunks between white space remembered.

    The tokenizer drops white space and never merges across it, so a text's ids are its chunks'
    ids in order. A text with characters outside Latin letters and ASCII goes to the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark = np.array(self._ids(_MARK), "<u4")
        self.memo: dict[str, bytes] = {}

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _learn(self, chunks: list[str]) -> None:
        if len(self.memo) + len(chunks) > MEMO_CHUNKS:
            self.memo.clear()
        for at in range(0, len(chunks), 1_000):
            some = chunks[at : at + 1_000]
            joined = self.tokenizer.encode_batch_fast([f" {_MARK} ".join(some)], add_special_tokens=False)[0].ids
            ids = np.array(joined, "<u4")
            cuts = np.flatnonzero(ids == self.mark[0])
            raw, starts, ends = ids.tobytes(), np.r_[0, cuts + 1] * 4, np.r_[cuts, len(ids)] * 4
            self.memo.update(zip(some, (raw[a:b] for a, b in zip(starts.tolist(), ends.tolist()))))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        plain = [None if t and _PLAIN.search(t) else (t or "").lower().split() for t in texts]
        missing = list({c for chunks in plain if chunks for c in chunks if c not in self.memo})
        if len(self.memo) + len(missing) > MEMO_CHUNKS:
            self.memo.clear()
            missing = list({c for chunks in plain if chunks for c in chunks})
        self._learn(missing)
        out = []
        for text, chunks in zip(texts, plain):
            out.append(np.array(self._ids(text), "<u4").tobytes() if chunks is None else b"".join(map(self.memo.__getitem__, chunks)))
        return out


@functools.lru_cache(maxsize=2)
def chunk_encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def token_pieces(
    docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, piece, start, length, ids_crc32): each document's ids and one end id, cut only beyond `capacity`.

    Null counts as empty: such a document is its end id alone. Repeated rows give repeated pieces.
    """
    bounded_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        make_room("packing: tokens", chunk_encoder.cache_clear)
        encoder = chunk_encoder(tokenizer_file)
        for batch in batches:
            ids, piece, start, length, crc = [], [], [], [], []
            names = batch.column(0).to_pylist()
            for name, raw in zip(names, encoder.encode(batch.column(1).to_pylist())):
                raw += end
                for number, at in enumerate(range(0, len(raw), 4 * capacity)):
                    cut = raw[at : at + 4 * capacity]
                    ids.append(name)
                    piece.append(number)
                    start.append(at // 4)
                    length.append(len(cut) // 4)
                    crc.append(zlib.crc32(cut))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["_id", "piece", "start", "length", "ids_crc32"],
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(run, "_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint").withColumnRenamed("_id", id_col)


class _Sizes:
    """A multiset of sizes with the searches that the reduction asks for."""

    def __init__(self, counts: dict[int, int]):
        self.count = {s: n for s, n in counts.items() if n > 0}
        self.keys = sorted(self.count)

    def take(self, size: int, n: int) -> None:
        self.count[size] -= n
        if not self.count[size]:
            del self.count[size]
            self.keys.pop(bisect.bisect_left(self.keys, size))

    def largest(self, most: int) -> int | None:
        """The largest size of at most `most`."""
        at = bisect.bisect_right(self.keys, most)
        return self.keys[at - 1] if at else None

    def smallest(self, n: int) -> list[int]:
        """The n smallest items' sizes, or all if there are fewer."""
        out: list[int] = []
        for s in self.keys:
            out += [s] * min(self.count[s], n - len(out))
            if len(out) == n:
                break
        return out

    def best_pair(self, most: int) -> tuple[int, int] | None:
        """Two items (larger, smaller) with the largest sum of at most `most`."""
        best, lo, hi = None, 0, len(self.keys) - 1
        while lo <= hi:
            a, b = self.keys[hi], self.keys[lo]
            if a + b > most or (lo == hi and self.count[a] < 2):
                hi -= 1
                continue
            if best is None or a + b > sum(best):
                best = (a, b)
            lo += 1
        return best


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Fix sets that dominate every other set with the same largest item.

    A set dominates another if the other's items can be grouped so that each group fits into one of
    the set's items; exchanging them never costs a bin. For the largest item j, with room r beside it:

    1. nothing fits: {j};
    2. an item k fills r exactly: {j, k}, as whatever else fits beside j fits into k's place;
    3. no two others fit: {j, k} with the largest k that fits;
    4. no three others fit and k is at least the best pair's sum: {j, k};
    5. no three others fit and the best pair is the largest k that fits with a b such that no feasible
       pair has both items above b: {j, k, b}.

    The alternatives of j are all sets of items not yet fixed, larger ones than j included, so the rules
    hold for any j; they are tried from the largest size down. Returns the fixed sets with their counts
    and what remains.
    """
    left, fixed = _Sizes(counts), []

    def fix(items: tuple[int, ...]) -> None:
        need: dict[int, int] = {}
        for s in items:
            need[s] = need.get(s, 0) + 1
        n = min(left.count[s] // k for s, k in need.items())
        for s, k in need.items():
            left.take(s, n * k)
        fixed.append((items, n))

    j = left.largest(capacity)
    while j is not None:
        while left.count.get(j):
            room = capacity - j
            left.take(j, 1)  # the alternatives beside one item of size j
            k = left.largest(room)
            items: tuple[int, ...] | None = None
            if k is None:
                items = (j,)
            elif k == room:
                items = (j, k)
            else:
                low = left.smallest(3)
                if len(low) < 2 or low[0] + low[1] > room:
                    items = (j, k)
                elif len(low) < 3 or sum(low) > room:
                    pair = left.best_pair(room)
                    if pair is None or k >= sum(pair):
                        items = (j, k)
                    elif pair[0] == k:
                        above = left.keys[bisect.bisect_right(left.keys, pair[1]) :]
                        twice = [above[0], above[0] if left.count[above[0]] > 1 else above[1] if len(above) > 1 else capacity] if above else []
                        if not twice or sum(twice) > room:
                            items = (j, k, pair[1])
            left.count[j] = left.count.get(j, 0) + 1
            if left.count[j] == 1:
                bisect.insort(left.keys, j)
            if items is None:
                break
            before = left.count[j]
            if items == (j,):
                left.take(j, before)
                fixed.append(((j,), before))
            elif len(items) == 2 and items[1] == capacity - j:
                fix(items)
            else:
                # Counts change what fits, so one set at a time unless every size has plenty left.
                spare = min(left.count[s] for s in set(items)) - 4
                n = max(1, spare // 3)
                need = {s: items.count(s) for s in items}
                for s, c in need.items():
                    left.take(s, n * c)
                fixed.append((items, n))
        j = left.largest(j - 1)
    return fixed, dict(left.count)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on a histogram: (sizes in a bin, number of such bins)."""
    open_bins: dict[int, list[list]] = {}  # room -> [[items, number]]
    rooms: list[int] = []

    def put(room: int, items: tuple[int, ...], n: int) -> None:
        if room not in open_bins:
            open_bins[room] = []
            bisect.insort(rooms, room)
        open_bins[room].append([items, n])

    for size in sorted(counts, reverse=True):
        todo = counts[size]
        while todo:
            at = bisect.bisect_left(rooms, size)
            if at == len(rooms):
                each = capacity // size
                whole, rest = divmod(todo, each)
                if whole:
                    put(capacity - each * size, (size,) * each, whole)
                if rest:
                    put(capacity - rest * size, (size,) * rest, 1)
                break
            room = rooms[at]
            items, n = open_bins[room].pop()
            # Filling a bin keeps it the best fit for the next item of this size.
            each = room // size
            full = min(n, todo // each)
            if full:
                put(room - each * size, items + (size,) * each, full)
                todo -= full * each
                n -= full
            if n and todo and todo < each:
                put(room - todo * size, items + (size,) * todo, 1)
                todo, n = 0, n - 1
            if n:
                open_bins[room].append([items, n])
            if not open_bins[room]:
                del open_bins[room]
                rooms.pop(bisect.bisect_left(rooms, room))
    return [(tuple(items), n) for groups in open_bins.values() for items, n in groups]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs (size, first rank, how many, first sequence, offset): ranks of a size in order of use."""
    fixed, rest = reduce_by_dominance(counts, capacity)
    used: dict[int, int] = {}
    runs, sequence = [], 0
    for items, n in fixed + best_fit(rest, capacity):
        offset = 0
        for size in items:
            runs.append((size, used.get(size, 0), n, sequence, offset))
            used[size] = used.get(size, 0) + n
            offset += size
        sequence += n
    return sorted(runs)


def pack(pieces: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id") -> DataFrame:
    """`pieces` (id, piece, start, length, ids_crc32) with sequence_id and offset."""
    pieces = written(pieces, "pieces")
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    runs = np.array(plan(counts, capacity), np.int64).reshape(-1, 5)
    keys = runs[:, 0] << 40 | runs[:, 1]
    table = pieces.sparkSession.sparkContext.broadcast((keys, runs))

    def place(batches):
        keys, runs = table.value
        for batch in batches:
            rank, length = batch.column(5).to_numpy(), batch.column(3).to_numpy()
            at = np.searchsorted(keys, length << 40 | rank, side="right") - 1
            sequence = runs[at, 3] + rank - runs[at, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence, pa.int64()), pa.array(runs[at, 4], pa.int64())],
                names=["_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    names = ["_id", "piece", "start", "length", "ids_crc32"]
    rows = ranked(pieces.withColumnRenamed(id_col, "_id").select(*names), "length", ["_id", "piece", "ids_crc32"])
    schema = "_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return rows.select(*names, "_rank").mapInArrow(place, schema).withColumnRenamed("_id", id_col)
