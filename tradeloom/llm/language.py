"""Language of a document by sparse multinomial logistic regression.

Features are hashed character n-grams (1 to 3 code points of the lower-cased
text) weighted by TF-IDF. Document frequencies are counted over all learning
documents. The weights are learned on a bounded sample of them by
follow-the-regularised-leader with elastic-net penalties, which leaves most of
them at zero, and a temperature fitted on a part of the sample that was not
learned from calibrates the probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.shared import written

FEATURES = 1 << 13
NGRAMS = (1, 2, 3)
FOLDS, HELD_OUT = 3, 1
# Bounds of the sample that weights are learned from; each language has one document at least.
SAMPLE = 6000
PER_LANGUAGE = 600
EPOCHS = 5
BATCH = 32
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-3, 1e-4
UNKNOWN = "und"
_CHUNK = 1 << 18
_LETTER = regex.compile(r"\p{L}")
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from. A missing id is held out, too."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(True))


def term_counts(text: str) -> np.ndarray:
    """Counts of the hashed n-grams of a whole text."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    total = np.zeros(FEATURES, dtype=np.int64)
    for start in range(0, len(points), _CHUNK):
        part = points[start : start + _CHUNK + max(NGRAMS) - 1].astype(np.uint64)
        for n in NGRAMS:
            count = min(len(part) - n + 1, _CHUNK)
            if count <= 0:
                continue
            code = np.full(count, n, dtype=np.uint64)
            for step in range(n):
                code = (code + part[step : step + count]) * _FACTORS[step]
                code ^= code >> np.uint64(29)
            total += np.bincount((code >> np.uint64(40)) % np.uint64(FEATURES), minlength=FEATURES)
    return total


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of length one, with logarithmic term frequencies."""
    rows = np.log1p(counts) * idf
    return rows / np.maximum(np.linalg.norm(rows, axis=-1, keepdims=True), 1e-12)


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of documents, and of those with each feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, found = 0, np.zeros(FEATURES, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                n, found = n + 1, found + (term_counts(text.as_py()) > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *range(FEATURES)], pa.int32()), pa.array(np.r_[n, found], pa.int64())],
            names=["feature", "n"])

    counts = docs.select("text").mapInArrow(run, "feature int, n long").groupBy("feature").agg(
        F.sum("n").alias("n")).collect()  # one row per feature
    by_feature = {r["feature"]: r["n"] for r in counts}
    return by_feature.get(-1, 0), np.array([by_feature.get(i, 0) for i in range(FEATURES)])


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # FEATURES x languages, mostly zero
    temperature: float = 1.0

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        return _softmax((_weighted(counts, self.idf) @ self.weights) / self.temperature)


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class _Sample:
    """Sparse rows; only a batch at a time is spread out."""

    def __init__(self, features: list[bytes], counts: list[bytes], idf: np.ndarray):
        self.features = [np.frombuffer(f, np.uint16) for f in features]
        self.counts = [np.frombuffer(c, np.uint32) for c in counts]
        self.idf = idf

    def __getitem__(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), FEATURES))
        for i, row in enumerate(rows):
            out[i, self.features[row]] = self.counts[row]
        return _weighted(out, self.idf)


def ftrl(sample: _Sample, rows: np.ndarray, classes: np.ndarray, n_classes: int) -> np.ndarray:
    """Weights by FTRL-proximal over mini-batches. There are no biases: how
    often a language is in the sample is set by the quotas, not by the corpus."""
    z, squares = np.zeros((2, FEATURES, n_classes))
    targets = np.eye(n_classes)[classes]
    order = np.random.default_rng(0)

    def solved(at: np.ndarray | slice) -> np.ndarray:
        rate = (BETA + np.sqrt(squares[at])) / ALPHA + L2
        return np.where(np.abs(z[at]) <= L1, 0.0, -(z[at] - np.sign(z[at]) * L1) / rate)

    for _ in range(EPOCHS if len(rows) else 0):
        for batch in np.array_split(order.permutation(rows), -(-len(rows) // BATCH)):
            x = sample[batch]
            # Only features of the batch have a slope.
            at = np.flatnonzero(x.any(axis=0))
            x, weights = x[:, at], solved(at)
            slope = x.T @ (_softmax(x @ weights) - targets[batch]) / len(batch)
            step = (np.sqrt(squares[at] + slope**2) - np.sqrt(squares[at])) / ALPHA
            z[at] += slope - step * weights
            squares[at] += slope**2
    return solved(slice(None))


def _temperature(model: Model, sample: _Sample, rows: np.ndarray, classes: np.ndarray) -> float:
    """The temperature with the least log loss over ``rows``, on a grid."""
    if not len(rows):
        return 1.0
    scores = np.vstack([
        sample[part] @ model.weights
        for part in np.array_split(rows, -(-len(rows) // BATCH))])

    def loss(t: float) -> float:
        p = _softmax(scores / t)[np.arange(len(rows)), classes[rows]]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    return float(min(np.geomspace(0.05, 20, 121), key=loss))


def train(docs: DataFrame) -> Model | None:
    """The model of the documents' texts and ``lang``; None without any.

    Learns from rows with text and lang that are not held out. Every language is
    learned. The weights see of each the PER_LANGUAGE documents, or an equal
    share of SAMPLE if that is less, with the smallest hashes of their ids, a
    bounded sample; of rows that share a doc_id and a language it takes one.
    Every fifth document of a language only sets the temperature. The model has
    FEATURES numbers a language.
    """
    learn = docs.where(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
    ).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    n, found = document_frequencies(learn)
    if not n:
        return None
    ids = learn.select("doc_id", "lang").distinct().withColumn("h", F.xxhash64("doc_id"))
    languages = sorted(r["lang"] for r in learn.select("lang").distinct().collect())
    quota = max(1, min(PER_LANGUAGE, SAMPLE // len(languages)))
    first = Window.partitionBy("lang").orderBy("h", "doc_id")
    bounded = written(ids.withColumn("r", F.row_number().over(first)).where(F.col("r") <= quota).select(
        "doc_id", "lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [term_counts(t.as_py()) for t in batch.column(2)]
            at = [np.flatnonzero(r) for r in rows]
            counts = [r[a].astype(np.uint32).tobytes() for r, a in zip(rows, at)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([a.astype(np.uint16).tobytes() for a in at], pa.binary()),
                 pa.array(counts, pa.binary())],
                names=["doc_id", "lang", "features", "counts"])

    # One id a language or SAMPLE ids are broadcast, whichever is more.
    chosen = learn.join(F.broadcast(bounded), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(
        F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("least"))
    rows = chosen.select("doc_id", "lang", F.col("least")["text"].alias("text")).mapInArrow(
        run, "doc_id long, lang string, features binary, counts binary")
    sampled = rows.orderBy("doc_id", "lang").toArrow()
    number = {name: i for i, name in enumerate(languages)}
    classes = np.array([number[name] for name in sampled.column("lang").to_pylist()])
    idf = np.log((1 + n) / (1 + found)) + 1
    sample = _Sample(sampled.column("features").to_pylist(), sampled.column("counts").to_pylist(), idf)
    place = np.zeros(len(classes), dtype=np.int64)
    for c in range(len(languages)):
        place[classes == c] = np.arange((classes == c).sum())
    weights = ftrl(sample, np.flatnonzero(place % 5 < 4), classes, len(languages))
    model = Model(languages, idf, weights)
    model.temperature = _temperature(model, sample, np.flatnonzero(place % 5 == 4), classes)
    return model


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) from the texts alone; ``und`` with
    score 0 for NULL texts, texts without letters (Unicode category L), and without a model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for text in batch.column(2):
                text = text.as_py()
                if model is None or text is None or not _LETTER.search(text):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                p = model.probabilities(term_counts(text))
                names.append(model.languages[int(p.argmax())])
                scores.append(float(p.max()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()),
                 pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text",
    ).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def languages(docs: DataFrame) -> DataFrame:
    """``predict`` by a model trained on the same documents. Repeated rows come
    back repeated; rows without doc_id are predicted but never learned from."""
    return predict(docs, train(docs))
