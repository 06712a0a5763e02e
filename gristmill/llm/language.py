"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

Features are hashed n-grams of 1 to 4 lower-cased characters of the whole text. Document frequencies
are counted over all learning rows. The weights are fitted by follow-the-regularised-leader with
elastic-net penalties, which leaves most of them zero, on a sample: of each language of the learning
rows those with the least hash of the id, SAMPLE divided by the number of languages of them, LEAST at
least. The shares of the languages among all learning rows correct the balance of the sample; a
temperature, fitted on a part of the sample that the weights have not seen, makes the probabilities honest.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gristmill.llm.common import bounded_batches
from gristmill.llm.suffix import _mix
from gristmill.llm.toxicity import fold

CELLS = 1 << 15
ORDERS = (1, 2, 3, 4)
SAMPLE = 4_000
LEAST = 50
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.002, 0.0005
UNKNOWN = "und"

_U = np.uint64


def counts_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the n-grams of a text and how often each comes."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.uint64) + _U(1)
    total = None
    h = np.zeros(len(codes), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        if len(codes) < n:
            break
        h = _mix(h[: len(codes) - n + 1] * _U(31) + codes[n - 1 :])
        if n in ORDERS:
            cells = np.bincount((h % _U(CELLS)).astype(np.int64), minlength=CELLS)
            total = cells if total is None else total + cells
    if total is None:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cells = np.flatnonzero(total)
    return cells, total[cells]


def tf_idf(cells: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Values of length 1."""
    values = (1 + np.log(counts)) * idf[cells]
    norm = np.sqrt((values**2).sum())
    return values / norm if norm else values


class Model:
    def __init__(self, languages: list[str], idf: np.ndarray, weights: np.ndarray, bias: np.ndarray, temperature: float):
        self.languages, self.idf, self.weights, self.bias, self.temperature = languages, idf, weights, bias, temperature

    def logits(self, text: str) -> np.ndarray:
        cells, counts = counts_of(text)
        return tf_idf(cells, counts, self.idf) @ self.weights[cells] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        """The likeliest language and its probability; `und` and 0 for a text that is null or has no letter."""
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        x = self.logits(text) / self.temperature
        p = np.exp(x - x.max())
        best = int(p.argmax())
        return self.languages[best], float(p[best] / p.sum())


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, epochs: int = EPOCHS, seed: int = 5):
    """Weights and bias after FTRL-proximal over the rows (cells, values) in shuffled order."""
    z, n = np.zeros((CELLS + 1, classes)), np.zeros((CELLS + 1, classes))
    bias = np.array([CELLS])

    def weights(at: np.ndarray) -> np.ndarray:
        zs = z[at]
        return np.where(np.abs(zs) <= L1, 0.0, -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    draw = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in draw.permutation(len(rows)):
            cells, values = rows[i]
            at, x = np.r_[cells, bias], np.r_[values, 1.0]
            w = weights(at)
            logit = x @ w
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[labels[i]] -= 1.0
            g = x[:, None] * p
            before = n[at]
            after = before + g * g
            z[at] += g - (np.sqrt(after) - np.sqrt(before)) / ALPHA * w
            n[at] = after
    w = weights(np.arange(CELLS + 1))
    return w[:CELLS], w[CELLS]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search on its logarithm."""

    def loss(t: float) -> float:
        x = logits / np.exp(t)
        x = x - x.max(axis=1, keepdims=True)
        return float((np.log(np.exp(x).sum(axis=1)) - x[np.arange(len(x)), labels]).mean())

    if not len(labels):
        return 1.0
    lo, hi, ratio = -3.0, 3.0, (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def _document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Rows and the number of rows with each cell: one small vector from each task, summed by cell."""

    def run(batches):
        total, rows = np.zeros(CELLS, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                rows += 1
                total[counts_of(text)[0]] += 1
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([*cells, CELLS], pa.int64()), pa.array([*total[cells], rows], pa.int64())], names=["_cell", "_n"])

    found = texts.select("_text").mapInArrow(run, "_cell bigint, _n bigint").groupBy("_cell").agg(F.sum("_n")).collect()  # at most CELLS + 1
    out = np.zeros(CELLS + 1, np.int64)
    for cell, n in found:
        out[cell] = n
    return int(out[CELLS]), out[:CELLS]


def _sampled(learning: DataFrame, totals: dict[str, int], size: int) -> DataFrame:
    """Up to `size` rows of each language, those with the least hash of the id; about twice as many come to the ranking."""
    span = 1 << 30
    spark = learning.sparkSession
    shares = spark.createDataFrame(
        [(lang, min(span, -(-(2 * size + 64) * span // n))) for lang, n in totals.items()], "_lang string, _share bigint"
    )
    rank = F.pmod(F.xxhash64("_id", F.lit(3)), F.lit(span))
    near = learning.withColumn("_rank", rank).join(F.broadcast(shares), "_lang").filter(F.col("_rank") < F.col("_share"))
    order = W.partitionBy("_lang").orderBy("_rank", "_id", "_text")
    return near.withColumn("_no", F.row_number().over(order)).filter(F.col("_no") <= size).select("_lang", "_text", "_no")


def fit(learning: DataFrame, sample: int = SAMPLE) -> Model:
    """Train on (_id, _text, _lang) without nulls, on all languages of it; the driver gets the features of the sample."""
    spark = learning.sparkSession
    bounded_batches(spark)
    rows, frequency = _document_frequencies(learning)
    idf = np.log((1 + rows) / (1 + frequency)) + 1

    def run(batches):
        for batch in batches:
            found = [counts_of(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *[pa.array([np.asarray(f[i], "<i4").tobytes() for f in found], pa.binary()) for i in (0, 1)]],
                names=["_lang", "_no", "_cells", "_counts"],
            )

    totals = {r[0]: r[1] for r in learning.groupBy("_lang").count().collect()}  # one row a language
    languages = sorted(totals)
    if not languages:
        return Model([], idf, np.zeros((CELLS, 1)), np.zeros(1), 1.0)
    chosen = _sampled(learning, totals, max(LEAST, sample // len(languages)))
    taken = chosen.mapInArrow(run, "_lang string, _no int, _cells binary, _counts binary").toArrow()
    taken = taken.sort_by([("_no", "ascending"), ("_lang", "ascending")])  # the same order wherever tasks ran
    number = {lang: i for i, lang in enumerate(languages)}
    features = []
    for packed in zip(taken.column("_cells"), taken.column("_counts")):
        cells, counts = (np.frombuffer(raw.as_py(), "<i4") for raw in packed)
        features.append((cells, tf_idf(cells.astype(np.int64), counts.astype(np.int64), idf)))
    labels = np.array([number[lang] for lang in taken.column("_lang").to_pylist()], np.int64)
    calibrating = taken.column("_no").to_numpy() % 5 == 0  # within each language; its first four rows are learnt
    inside = np.flatnonzero(~calibrating)
    weights, bias = fit_ftrl([features[i] for i in inside], labels[inside], len(languages))
    held = np.flatnonzero(calibrating)
    logits = np.array([features[i][1] @ weights[features[i][0]] + bias for i in held]).reshape(len(held), len(languages))
    temperature = fit_temperature(logits, labels[held])
    # Shares of all rows against those of the sample, in honest logits: hence times the temperature.
    shift = np.log([totals[lang] / rows for lang in languages]) - np.log(np.bincount(labels, minlength=len(languages)) / len(labels))
    return Model(languages, idf, weights, bias + temperature * shift, temperature)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of each whole text; one row per row of `docs`."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            found = [shared.value.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["_id", "lang_pred", "score"],
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(run, "_id bigint, lang_pred string, score double").withColumnRenamed("_id", id_col)


def _held_out(column: Column) -> Column:
    return fold(column, 4) == 2


def held_out_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score) of every row; fold 2 of 4 is held out from learning.

    Rows with a null text, a null language or a null id (its fold is unknown) teach nothing. A text
    that is null or has no letter is `und` with score 0. Repeated rows count as often as they come.
    """
    learning = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"), F.col(lang_col).cast("string").alias("_lang"))
    model = fit(learning.dropna().filter(~_held_out(F.col("_id"))))
    return identify(docs, model, id_col, text_col).select(id_col, _held_out(F.col(id_col)).alias("held_out"), "lang_pred", "score")
