"""Quality by compression.

Two zstandard dictionaries are trained, one on texts labelled good and one on texts labelled bad.
A text's difference between its compressed sizes under the two, divided by its plain compressed
size, says which kind it resembles; a logistic curve over it, the plain compression ratio and the
size, fitted on labelled texts that the dictionaries have not seen, turns that into a probability.

The model is fitted on a bounded sample of labelled rows: per class, texts in the order of a hash,
each taken that still fits into ``sample_bytes``, long ones too; half make the dictionaries and half
the curve. Where a class has few texts, they are dealt into folds instead, and every text meets
dictionaries made without its fold. The scan scores every whole text.

Defined cases: NULL text scores as the empty text, which has a score of its own through the curve;
contradictory or repeated labels of a document count as the smallest, and of rows of one doc_id one
is learned from; without labelled texts of both classes every score is 0.5; repeated rows get equal
scores; an empty table gives no rows. Only
doc_id and text are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import body
from shopledger.session import materialize

SAMPLE_BYTES = 6_000_000
DICTIONARY_BYTES = 112_640
LEVEL = 3
# Below this many texts of a class, the curve is fitted by folds.
FOLD_BELOW = 16
FOLDS = 4


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]

    def scorer(self) -> "Scorer":
        return Scorer(self)


class Scorer:
    """Compressors of one task; dictionaries are digested once."""

    def __init__(self, model: Model) -> None:
        make = lambda d: zstandard.ZstdCompressor(level=LEVEL, dict_data=d)
        self.plain = zstandard.ZstdCompressor(level=LEVEL)
        self.good, self.bad = (
            make(zstandard.ZstdCompressionDict(d)) if d else self.plain
            for d in (model.good, model.bad)
        )
        self.weights = np.array(model.weights)

    def features(self, text: bytes) -> list[float]:
        plain = len(self.plain.compress(text))
        good, bad = len(self.good.compress(text)), len(self.bad.compress(text))
        gain = (bad - good) / plain
        ratio = np.log(plain / (len(text) + 16.0))
        size = np.log(len(text) + 16.0)
        inputs = (1.0, gain, ratio, size)
        return [a * b for i, a in enumerate(inputs) for b in inputs[i:]]

    def score(self, text: bytes) -> float:
        if not self.weights.any():
            return 0.5
        z = float(np.dot(self.weights, self.features(text)))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(good: list[bytes], bad: list[bytes], share_good: float = 0.5) -> Model:
    """Dictionaries from the first half of each list, the curve from the second.

    ``share_good`` is the share of good labels among all, which the sample need not have.
    """
    if not good or not bad:
        return Model(b"", b"", (0.0,))
    if min(len(good), len(bad)) >= FOLD_BELOW:
        trained = [_trained(texts[: len(texts) // 2]) for texts in (good, bad)]
        scorer = Model(*trained, (0.0,)).scorer()
        parts = [(scorer, good[len(good) // 2 :], bad[len(bad) // 2 :])]
    else:
        trained = [_trained(texts) for texts in (good, bad)]
        parts = []
        for fold in range(FOLDS):
            # The only text of a class is its own dictionary: there is no other.
            rest = [[t for i, t in enumerate(x) if i % FOLDS != fold] or x for x in (good, bad)]
            scorer = Model(*map(_trained, rest), (0.0,)).scorer()
            parts.append((scorer, good[fold::FOLDS], bad[fold::FOLDS]))
    x = np.array([scorer.features(t) for scorer, *held in parts for t in [*held[0], *held[1]]])
    y = np.concatenate([[1.0] * len(a) + [0.0] * len(b) for _, a, b in parts])
    w = np.where(y == 1, share_good / y.mean(), (1 - share_good) / (1 - y.mean()))
    return Model(*trained, tuple(map(float, logistic(x, y, w))))


def _trained(texts: list[bytes]) -> bytes:
    return dictionary(texts, min(DICTIONARY_BYTES, max(1024, sum(map(len, texts)) // 8)))


def dictionary(texts: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the texts themselves as a raw one where training finds nothing."""
    pieces = [t[i : i + 2048] for t in texts for i in range(0, len(t), 2048)]
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(texts)[:size]


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 0.03) -> np.ndarray:
    """Weighted ridge logistic regression by Newton's method.

    Inputs are standardised (the first is the constant) and every step is halved until the loss
    falls: nearly separable classes would send plain steps to infinity.
    """
    mean, scale = x.mean(axis=0), x.std(axis=0)
    mean[0], scale[0] = 0.0, 1.0
    scale[scale == 0] = 1.0
    z = (x - mean) / scale
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6

    def loss(beta: np.ndarray) -> float:
        margin = z @ beta
        return float(w @ (np.logaddexp(0, margin) - y * margin) + penalty @ beta**2 / 2)

    beta = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -500, 500)))
        slope = z.T @ (w * (y - p)) - penalty * beta
        curve = (z * (w * p * (1 - p))[:, None]).T @ z + np.diag(penalty)
        step, size, now = np.linalg.solve(curve, slope), 1.0, loss(beta)
        while loss(beta + size * step) > now and size > 1e-9:
            size /= 2
        beta = beta + size * step
        if np.abs(size * step).max() < 1e-7:
            break
    weights = beta / scale
    weights[0] -= float(weights @ mean)
    return weights


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    code = F.pmod(F.crc32(doc_id.cast("string")), F.lit(3))
    return F.coalesce(code == 1, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, sample_bytes: int = SAMPLE_BYTES) -> Model:
    known = labels.filter(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    counts = {row["quality"]: row["count"] for row in known.groupBy("quality").count().collect()}
    texts = []
    for quality in (1, 0):
        chosen = known.filter(F.col("quality") == quality)
        # A bounded sample: ids in hash order. Average texts reach the bytes far earlier.
        chosen = chosen.orderBy(F.md5(F.col("doc_id").cast("string"))).limit(sample_bytes // 1024)
        rows = documents.select("doc_id", body().alias("text")).join(chosen, "doc_id")
        order = F.md5(F.concat(F.col("doc_id").cast("string"), F.lit("-"), "text"))
        rows = rows.filter(F.octet_length("text") > 0).withColumn("_order", order)
        # One row per id, however many copies carry it, so at most as many rows as ids were chosen.
        rows = rows.groupBy("doc_id").agg(
            F.min("_order").alias("_order"), F.min_by("text", "_order").alias("text")
        )
        rows = materialize(rows.withColumn("bytes", F.octet_length("text")))
        used, fitting = 0, []
        for row in rows.select("_order", "bytes").orderBy("_order").collect():
            if used + row["bytes"] <= sample_bytes:
                used += row["bytes"]
                fitting.append(row["_order"])
        taken = rows.filter(F.col("_order").isin(fitting)).orderBy("_order").select("text")
        found = [row["text"].encode("utf-8", "replace") for row in taken.collect()]
        texts.append(found)
    return fit(*texts, counts.get(1, 0) / max(1, sum(counts.values())))


def accepted(documents: DataFrame, model: Model) -> DataFrame:
    """The documents with a score of 0.5 or more, in their own columns; nothing is shuffled."""
    names = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            keep = [scorer.score(encoded(t)) >= 0.5 for t in texts]
            columns = [c.filter(pa.array(keep)) for c in batch.columns[:-1]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = documents.select(*[documents[n] for n in names], body().alias("__text"))
    return rows.mapInArrow(run, documents.schema)


def encoded(text: pa.Scalar) -> bytes:
    return (text.as_py() or "").encode("utf-8", "replace")


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted per document."""
    model = train(documents, labels)
    narrow = documents.select("doc_id", "text")
    rows = narrow.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), body().alias("text")
    )
    scored = _score_only(rows, model)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _score_only(rows: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            texts = batch.column("text")
            marks = [scorer.score(encoded(t)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(marks, pa.float64())],
                names=["doc_id", "held_out", "score"],
            )

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
