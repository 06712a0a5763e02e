"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text is a sequence of words; a word's input is its own embedding plus those of its characters (all
byte n-grams of 3 to 5 with the word's borders, and the word's beginnings), both looked up by hash, so
a new word is read by its characters. The network runs over overlapping windows of all words of a
text. The document's logit is the windows' mean weighted by softmax(SHARPNESS * their logits): equal
windows keep their logit whatever their number, a toxic one is not thinned out by clean ones, and no
mean is over the greatest logit. Training starts almost at the plain mean, so that all windows of a toxic
text teach its words, and sharpens from there; the weights count as given when the loss goes back.

Training takes at most SAMPLE documents of each label, those with the least hash of the id among the
training fold, with all their windows; the prior of the fold, counted over all its rows, corrects the
balance of the sample. Texts are read in parts of PART bytes whose windows are those of the whole text,
in training as in scoring. A run of word bytes longer than LONGEST counts as words of that length.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import bounded_batches, give_back, hash_sample, make_room
from gristmill.llm.suffix import _mix, _powers

WINDOW = 40
STRIDE = 30
SAMPLE = 1_500
DIM = 12
HIDDEN = 8
WORD_CELLS = 1 << 14
GRAM_CELLS = 1 << 15
STEPS = 360
BATCH_DOCS = 48
RATE = 0.01
BATCH_MB = 4  # of text that a Python worker gets at once
PART = 1 << 19  # bytes of text whose words are looked up at once
CHUNK = 2_048  # windows that the network takes at once
LONGEST = 64
SHARPNESS = 2.0
FIRST_SHARPNESS = 0.3  # up to the step of SHARPENING's first share; from its second one on SHARPNESS
SHARPENING = (0.3, 0.8)
GRAMS = (3, 4, 5)
PREFIXES = (3, 4, 5, 6, 7, 8)

_U = np.uint64
_EDGE = 256
_TABLE = PART + 2 * (WINDOW + STRIDE) * (LONGEST + 1)  # bytes of a part with the words it takes over


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Bytes of words (letters, digits, all beyond ASCII) and their lower-case forms."""
    codes = np.arange(256)
    word = (codes >= 128) | ((codes >= 48) & (codes <= 57)) | ((codes >= 65) & (codes <= 90)) | ((codes >= 97) & (codes <= 122))
    return word, np.where((codes >= 65) & (codes <= 90), codes + 32, codes).astype(np.uint8)


_WORD, _LOWER = _tables()


def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of each range, one range after the other."""
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - begin, count)


def _words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word; a longer run is cut at each LONGEST bytes."""
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = _WORD[raw]
    edge = np.diff(inside.view(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    count = -(-(end - start) // LONGEST)
    if len(count) and count.max() > 1:
        nth = _ranges(np.zeros(len(count), np.int64), count)
        start, last = np.repeat(start, count) + nth * LONGEST, np.repeat(end, count)
        end = np.minimum(start + LONGEST, last)
    return start, end


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts together: lower-cased bytes, start and end of each word, number of words of each text."""
    raw = _LOWER[np.frombuffer(b"\n".join(texts), np.uint8)] if texts else np.empty(0, np.uint8)
    start, end = _words(raw)
    bounds = np.cumsum([0, *[len(t) + 1 for t in texts]])
    return raw, start, end, np.diff(np.searchsorted(start, bounds))


def word_inputs(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct words: (index of each word's kind, word cell of each kind, gram cells, owners of the gram cells, hashes of the kinds)."""
    if not len(start):
        none = np.empty(0, np.int64)
        return none, none, none, none, np.empty(0, np.uint64)
    up, down = _powers(_TABLE)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + _U(1)) * up[: len(raw)], dtype=np.uint64, out=sums[1:])
    hashes = _mix((sums[end] - sums[start]) * down[start])
    kinds, first, kind = np.unique(hashes, return_index=True, return_inverse=True)
    start, end = start[first], end[first]
    cells, owners = [], []
    every = np.arange(len(kinds))
    size = end - start
    for n in PREFIXES:  # beginnings of the word
        has = size >= n
        s = start[has]
        cells.append(_mix((sums[s + n] - sums[s]) * down[s] + _U(n)))
        owners.append(every[has])
    for n in GRAMS:  # n-grams anywhere inside
        count = np.maximum(size - n + 1, 0)
        at = _ranges(start, count)
        cells.append(_mix((sums[at + n] - sums[at]) * down[at] + _U(_EDGE + n)))
        owners.append(np.repeat(every, count))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return (
        kind, (kinds % _U(WORD_CELLS)).astype(np.int64),
        (np.concatenate(cells)[order] % _U(GRAM_CELLS)).astype(np.int64), owner[order], kinds,
    )


def joined_inputs(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """The inputs of several parts as those of one: words of equal hash are one kind."""
    hashes = np.concatenate([p[4] for p in parts])
    kinds, first, same = np.unique(hashes, return_index=True, return_inverse=True)
    before = np.cumsum([0, *[len(p[4]) for p in parts]])
    count = np.concatenate([np.bincount(p[3], minlength=len(p[4])) for p in parts]).astype(np.int64)
    begin = np.cumsum(count) - count
    return (
        np.concatenate([same[b + p[0]] for b, p in zip(before, parts)]), np.concatenate([p[1] for p in parts])[first],
        np.concatenate([p[2] for p in parts])[_ranges(begin[first], count[first])], np.repeat(np.arange(len(kinds)), count[first]), kinds,
    )


def windows_of(count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, words, text) of each window; windows overlap and the last ends with the text.

    A text without words has one window of no words.
    """
    base = np.cumsum(count) - count
    n = 1 + np.maximum(0, -(-(count - WINDOW) // STRIDE))
    text = np.repeat(np.arange(len(count)), n)
    at = np.maximum(np.minimum(_ranges(np.zeros(len(n), np.int64), n) * STRIDE, count[text] - WINDOW), 0)
    return base[text] + at, np.minimum(count[text], WINDOW), text


def _long_parts(text: bytes):
    """(bytes, starts, ends, first words, words) of the parts of a long text; their windows together are those of the whole.

    A part takes over the words from the last whole window on, so that the next windows can be told.
    """
    taken, done = b"", 0  # words taken over, whole windows among them
    for at in range(0, len(text), PART):
        raw = _LOWER[np.frombuffer(taken + text[at : at + PART], np.uint8)]
        start, end = _words(raw)
        if at + PART >= len(text):
            first, lengths, _ = windows_of(np.array([len(start)]))
            yield raw, start, end, first[done:], lengths[done:]
            return
        goes_on = bool(len(end)) and int(end[-1]) == len(raw)  # the last word may
        whole = max(0, (len(start) - goes_on - WINDOW) // STRIDE + 1)
        first = np.arange(whole) * STRIDE
        yield raw, start, end, first[done:], np.full(max(whole - done, 0), WINDOW)
        since = max(whole - 1, 0) * STRIDE
        taken = b" ".join(raw[s:e].tobytes() for s, e in zip(start[since:], end[since:])) + (b"" if goes_on else b" ")
        done = min(whole, 1)


def parts_of(texts: list[bytes]):
    """(bytes, starts, ends, first words, words, texts) of parts of about PART bytes, with all windows of all texts in order."""
    short: list[bytes] = []
    size = 0

    def several(first_text: int):
        raw, start, end, count = words_of(short)
        first, lengths, text = windows_of(count)
        return raw, start, end, first, lengths, text + first_text

    for i, text in enumerate(texts):
        if short and size + len(text) + 1 > PART:
            yield several(i - len(short))
            short, size = [], 0
        if len(text) >= PART:
            for part in _long_parts(text):
                yield *part, np.full(len(part[3]), i)
        else:
            short.append(text)
            size += len(text) + 1
    if short:
        yield several(len(texts) - len(short))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


class Model:
    """Parameters by name; `gru_*` of both directions, stacked."""

    def __init__(self, seed: int = 11):
        draw = np.random.default_rng(seed)
        normal = lambda *shape, s=1.0: (draw.standard_normal(shape) * s).astype(np.float32)
        self.p = {
            "word": normal(WORD_CELLS, DIM, s=0.05), "gram": normal(GRAM_CELLS, DIM, s=0.05),
            "wx": normal(2, DIM, 3 * HIDDEN, s=DIM**-0.5), "wh": normal(2, HIDDEN, 3 * HIDDEN, s=HIDDEN**-0.5),
            "b": np.zeros((2, 3 * HIDDEN), np.float32), "att": normal(2 * HIDDEN, HIDDEN, s=0.3), "att_b": np.zeros(HIDDEN, np.float32),
            "att_v": normal(HIDDEN, s=0.5), "out": normal(2 * HIDDEN, s=0.3), "out_b": np.zeros(1, np.float32),
        }
        self.shift = 0.0

    def embed(self, inputs) -> np.ndarray:
        """Vectors of the distinct words."""
        word, gram, owner = inputs[1:4]
        out = self.p["word"][word].copy()
        if len(gram):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            for a in range(0, len(starts), 20_000):  # bounded memory
                s = starts[a : a + 20_000]
                stop = starts[a + 20_000] if a + 20_000 < len(starts) else len(gram)
                part = self.p["gram"][gram[s[0] : stop]]
                n = np.diff(np.r_[s, stop])[:, None].astype(np.float32)
                out[owner[s]] += np.add.reduceat(part, s - s[0], axis=0) / np.sqrt(n)
        return out

    def _run(self, gates: np.ndarray, lengths: np.ndarray, side: int, keep: bool):
        """One direction over gates (T, B, 3H): hidden states, and what the backward pass needs."""
        steps, batch = gates.shape[:2]
        u, h = self.p["wh"][side], np.zeros((batch, HIDDEN), np.float32)
        states = np.empty((steps, batch, HIDDEN), np.float32)
        kept = []
        for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
            hu = h @ u
            zr = _sigmoid(gates[t, :, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = np.tanh(gates[t, :, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
            new = n + z * (h - n)
            active = (t < lengths)[:, None]
            if keep:
                kept.append((t, z, r, n, h, hu[:, 2 * HIDDEN :], active))
            h = new if active.all() else np.where(active, new, h)
            states[t] = h
        return states, kept

    def forward(self, vectors: np.ndarray, index: np.ndarray, lengths: np.ndarray, keep: bool = False):
        """Logits of windows; `index` (T, B) picks the words' vectors."""
        p = self.p
        gates = [(vectors @ p["wx"][side] + p["b"][side])[index] for side in (0, 1)]
        runs = [self._run(gates[side], lengths, side, keep) for side in (0, 1)]
        states = np.concatenate([runs[0][0], runs[1][0]], axis=2)
        hidden = np.tanh(states @ p["att"] + p["att_b"])
        score = hidden @ p["att_v"]
        outside = np.arange(len(index))[:, None] >= lengths
        score = np.where(outside, np.float32(-1e9), score)
        weight = np.exp(score - score.max(axis=0))
        weight = np.where(outside, np.float32(0), weight)
        weight /= np.maximum(weight.sum(axis=0), np.float32(1e-9))
        pooled = np.einsum("tb,tbh->bh", weight, states)
        logit = pooled @ p["out"] + p["out_b"][0]
        return logit, (states, hidden, weight, pooled, runs) if keep else None

    def backward(self, grad: np.ndarray, vectors: np.ndarray, index: np.ndarray, cache) -> tuple[dict[str, np.ndarray], np.ndarray]:
        p, (states, hidden, weight, pooled, runs) = self.p, cache
        g = {"out": pooled.T @ grad, "out_b": np.array([grad.sum()], np.float32)}
        d_pooled = grad[:, None] * p["out"]
        d_states = weight[:, :, None] * d_pooled
        d_weight = np.einsum("bh,tbh->tb", d_pooled, states)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["att_v"] = np.einsum("tb,tbh->h", d_score, hidden)
        d_hidden = d_score[:, :, None] * p["att_v"] * (1 - hidden**2)
        g["att"] = np.einsum("tbi,tbj->ij", states, d_hidden)
        g["att_b"] = d_hidden.sum(axis=(0, 1))
        d_states = d_states + d_hidden @ p["att"].T
        g["wx"], g["wh"], g["b"] = np.zeros_like(p["wx"]), np.zeros_like(p["wh"]), np.zeros_like(p["b"])
        d_vectors = np.zeros_like(vectors)
        for side in (0, 1):
            d_h = np.zeros(d_states.shape[1:2] + (HIDDEN,), np.float32)
            d_gates = np.zeros((*index.shape, 3 * HIDDEN), np.float32)
            own = d_states[:, :, side * HIDDEN : (side + 1) * HIDDEN]
            for t, z, r, n, before, hun, active in reversed(runs[side][1]):
                d_h = d_h + own[t]
                d_new = np.where(active, d_h, np.float32(0))
                d_n = d_new * (1 - z) * (1 - n**2)
                d_z = d_new * (before - n) * z * (1 - z)
                d_r = d_n * hun * r * (1 - r)
                d_gates[t] = np.concatenate([d_z, d_r, d_n], axis=1)
                d_hu = np.concatenate([d_z, d_r, d_n * r], axis=1)
                g["wh"][side] += before.T @ d_hu
                d_h = np.where(active, np.float32(0), d_h) + d_new * z + d_hu @ p["wh"][side].T
            flat = d_gates.reshape(-1, 3 * HIDDEN)
            summed = np.stack([np.bincount(index.ravel(), flat[:, k], len(vectors)) for k in range(3 * HIDDEN)], axis=1).astype(np.float32)
            g["wx"][side] = vectors.T @ summed
            g["b"][side] = summed.sum(axis=0)
            d_vectors += summed @ p["wx"][side].T
        return g, d_vectors


def _window_index(first: np.ndarray, lengths: np.ndarray, kind: np.ndarray) -> np.ndarray:
    at = first[None, :] + np.minimum(np.arange(WINDOW)[:, None], np.maximum(lengths - 1, 0))
    return kind[np.minimum(at, len(kind) - 1)] if len(kind) else np.zeros_like(at)


def _pooled(logits: np.ndarray, text: np.ndarray, n: int, sharpness: float) -> tuple[np.ndarray, np.ndarray]:
    """Logit of each text, and each window's weight in it."""
    top = np.full(n, -np.inf)
    np.maximum.at(top, text, logits)
    weight = np.exp(sharpness * (logits - top[text]))
    weight /= np.bincount(text, weight, n)[text]
    return np.bincount(text, weight * logits, n), weight


def _sharpness(share: float) -> float:
    """Sharpness after a share of the training steps."""
    since, until = SHARPENING
    return FIRST_SHARPNESS * (SHARPNESS / FIRST_SHARPNESS) ** min(1.0, max(0.0, (share - since) / (until - since)))


def train(texts: list[bytes], toxic: np.ndarray, prior: float, steps: int = STEPS, seed: int = 11) -> Model:
    """Fit on all windows of labelled texts; `prior` is the share of label 1 among all labelled rows."""
    model, draw = Model(seed), np.random.default_rng(seed)
    groups = [np.flatnonzero(toxic == y) for y in (0, 1)]
    if not len(groups[1]) or not len(groups[0]):
        model.shift = -20.0 if not len(groups[1]) else 20.0
        return model
    inputs, windows, words = [], [], 0
    for raw, start, end, first, lengths, text in parts_of(texts):
        inputs.append(word_inputs(raw, start, end))
        windows.append((first + words, lengths, text))
        words += len(start)
    kind, word, gram, owner, _ = joined_inputs(inputs)
    gram_start = np.searchsorted(owner, np.arange(len(word) + 1))
    first, lengths, text = (np.concatenate([w[i] for w in windows]) for i in range(3))
    of_text = np.searchsorted(text, np.arange(len(texts) + 1))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.p.items()}

    def looked_up(some: np.ndarray):
        index = _window_index(first[some], lengths[some], kind)
        used, inverse = np.unique(index, return_inverse=True)
        if not len(kind):
            return used, used, used, used, np.zeros((1, DIM), np.float32), index
        sizes = gram_start[used + 1] - gram_start[used]
        mine, at = np.repeat(np.arange(len(used)), sizes), _ranges(gram_start[used], sizes)
        return used, sizes, mine, at, model.embed((None, word[used], gram[at], mine)), inverse.reshape(index.shape)

    def gradients(some: np.ndarray, grad: np.ndarray, seen, cache) -> dict[str, np.ndarray]:
        used, sizes, mine, at, vectors, index = seen
        found, d_vectors = model.backward(grad, vectors, index, cache)
        if len(kind):
            scaled = d_vectors / np.sqrt(np.maximum(sizes, 1))[:, None].astype(np.float32)
            found["word"] = np.stack([np.bincount(word[used], d_vectors[:, k], WORD_CELLS) for k in range(DIM)], axis=1)
            found["gram"] = np.stack([np.bincount(gram[at], scaled[mine, k], GRAM_CELLS) for k in range(DIM)], axis=1)
        return found

    for step in range(1, steps + 1):
        docs = np.concatenate([draw.choice(g, min(len(g), BATCH_DOCS // 2), replace=False) for g in groups])
        some = _ranges(of_text[docs], of_text[docs + 1] - of_text[docs])
        local = np.repeat(np.arange(len(docs)), of_text[docs + 1] - of_text[docs])
        chunks = [slice(a, a + CHUNK) for a in range(0, len(some), CHUNK)]
        logits = np.empty(len(some))
        for cut in chunks:  # a step of several chunks goes through the network twice, so that one chunk's states are held
            seen = looked_up(some[cut])
            logits[cut], cache = model.forward(seen[4], seen[5], lengths[some[cut]], keep=len(chunks) == 1)
        pooled, weight = _pooled(logits, local, len(docs), _sharpness(step / steps))
        error = (_sigmoid(pooled) - toxic[docs]) / len(docs)
        push = (error[local] * weight).astype(np.float32)
        grads: dict[str, np.ndarray] = {}
        for cut in chunks:
            if len(chunks) > 1:
                seen = looked_up(some[cut])
                cache = model.forward(seen[4], seen[5], lengths[some[cut]], keep=True)[1]
            for k, v in gradients(some[cut], push[cut], seen, cache).items():
                grads[k] = grads[k] + v if k in grads else v
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, v in grads.items():
            m, s = moments[k]
            m += np.float32(0.1) * (v.astype(np.float32) - m)
            s += np.float32(0.01) * (v.astype(np.float32) ** 2 - s)
            model.p[k] -= np.float32(rate / (1 - 0.9**step)) * m / (np.sqrt(s / np.float32(1 - 0.99**step)) + np.float32(1e-6))
    share = min(max(prior, 1e-6), 1 - 1e-6)
    model.shift = float(np.log(share / (1 - share)))  # batches hold both labels alike
    return model


def score_texts(model: Model, texts: list[bytes]) -> np.ndarray:
    """Probability of label 1 for each whole text."""
    found, owners = [np.empty(0)], [np.empty(0, np.int64)]
    for raw, start, end, first, lengths, text in parts_of(texts):
        inputs = word_inputs(raw, start, end)
        vectors = model.embed(inputs) if len(inputs[1]) else np.zeros((1, DIM), np.float32)
        for at in range(0, len(first), CHUNK):
            cut = slice(at, at + CHUNK)
            found.append(model.forward(vectors, _window_index(first[cut], lengths[cut], inputs[0]), lengths[cut])[0])
        owners.append(text)
    pooled = _pooled(np.concatenate(found), np.concatenate(owners), len(texts), SHARPNESS)[0]
    return _sigmoid(pooled + model.shift)


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int = SAMPLE, steps: int = STEPS) -> Model:
    """Train on the learning labels' documents; the driver gets whole texts of at most `sample` rows of each label.

    Labels are chosen before they meet the texts, so the join broadcasts at most 2 * `sample` ids.
    """
    known = learning_labels(labels, id_col)
    counts = {r[0]: r[1] for r in known.groupBy("_label").count().collect()}
    chosen = functools.reduce(
        DataFrame.unionByName, [hash_sample(known.filter(F.col("_label") == y), "_id", sample, counts.get(y, 0), 7) for y in (0, 1)]
    )
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    whole = F.coalesce(F.col("_text"), F.lit("")).cast("binary").alias("_raw")
    rows = texts.join(F.broadcast(chosen), "_id").select("_label", whole, F.xxhash64("_id", F.lit(7)).alias("_rank")).collect()
    rows.sort(key=lambda r: (r["_rank"], r["_label"], bytes(r["_raw"])))  # the same order wherever tasks ran
    total = sum(counts.get(y, 0) for y in (0, 1))
    model = train([bytes(r["_raw"]) for r in rows], np.array([r["_label"] for r in rows], np.int64), counts.get(1, 0) / max(total, 1), steps)
    del rows
    give_back()  # the driver lives on for other stages
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """(id, score, predicted) of each row; null counts as empty, and an empty text gets the score of no evidence."""
    spark = docs.sparkSession
    bounded_batches(spark, BATCH_MB)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        make_room("toxicity")
        for batch in batches:
            values = score_texts(shared.value, [(t or "").encode() for t in batch.column(1).to_pylist()]) if batch.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values, pa.float64()), pa.array((values >= threshold).astype(np.int32))], names=["_id", "score", "predicted"]
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(run, "_id bigint, score double, predicted int").withColumnRenamed("_id", id_col)


def fold(id_col: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; a null id is in part 0."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(parts)), F.lit(0))


def learning_labels(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(_id, _label): one label of 0 or 1 for each id outside fold 0 of 5; 1 if an id has both."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col(id_col).isNotNull() & (fold(F.col(id_col), 5) != 0))
    return known.groupBy(F.col(id_col).alias("_id")).agg(F.max("toxic").cast("int").alias("_label"))


def held_out_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of every row of `docs`; fold 0 of 5 is held out from learning."""
    model = fit(docs, labels, id_col, text_col)
    scored = score(docs, model, id_col, text_col)
    return scored.select(id_col, (fold(F.col(id_col), 5) == 0).alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` that are not predicted toxic, with all their columns."""
    spark = docs.sparkSession
    bounded_batches(spark, BATCH_MB)
    shared = spark.sparkContext.broadcast(fit(docs, labels, id_col, text_col))
    at = docs.columns.index(text_col)

    def run(batches):
        make_room("toxicity")
        for batch in batches:
            if batch.num_rows:
                values = score_texts(shared.value, [(t or "").encode() for t in batch.column(at).to_pylist()])
                batch = batch.filter(pa.array(values < threshold))
            yield batch

    return docs.mapInArrow(run, docs.schema)
