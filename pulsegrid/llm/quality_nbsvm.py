"""Quality classifier: naive Bayes support vectors.

A text becomes the indicators of its byte n-grams (hashed into a fixed number of features), each
scaled by the log-count ratio of the two classes, and the vector is brought to unit length. A
linear hinge-loss model is fitted to these vectors by dual coordinate descent, mixed with the
plain ratio model as usual for this method, and its margin is turned into a score by a logistic
curve fitted on the training margins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pick, table

#: Features; n-grams are hashed into this many.
FEATURES = 1 << 16
#: Lengths of the byte n-grams.
NGRAMS = (1, 2, 3)
#: Most labelled rows that the model is fitted on, chosen by a hash of the id. A bound of the
#: method, not of the data: every row is scored.
MAX_TRAIN_ROWS = 8_000
#: A filter rejects what scores below this: less than a half, so that clean texts near the border stay.
REJECT_BELOW = 0.3
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def features(text: str | None, n_features: int = FEATURES) -> np.ndarray:
    """Sorted distinct features of a whole text; none for a null or empty text."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    seen = np.zeros(n_features, bool)
    step = 1 << 20  # long texts by pieces that overlap, so that no n-gram is lost
    bits = np.uint32(32 - (n_features.bit_length() - 1))
    for at in range(0, len(raw), step):
        b = raw[at : at + step + max(NGRAMS) - 1].astype(np.uint32) + 1
        code = np.zeros(len(b), np.uint32)
        for n in range(1, max(NGRAMS) + 1):
            if len(b) < n:
                break
            code = code[: len(b) - n + 1] * np.uint32(257) + b[n - 1 :]
            if n in NGRAMS:
                seen[((code + np.uint32(n)) * _MIX[n - 1]) >> bits] = True
    return np.flatnonzero(seen).astype(np.int32)


@dataclass
class Model:
    weights: np.ndarray  # of each feature's indicator, ratio included
    ratios: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, f: np.ndarray) -> float:
        if not len(f):
            return self.bias
        norm = float(np.sqrt(np.square(self.ratios[f]).sum()))
        return float(self.weights[f].sum()) / max(norm, 1e-9) + self.bias

    def score(self, text: str | None) -> float:
        z = self.slope * self.margin(features(text, len(self.weights))) + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


class Rows:
    """Feature lists of many texts in one flat array, so that a sample takes little more than its features."""

    def __init__(self, flat: np.ndarray, ends: np.ndarray):
        self.flat, self.ends = flat, ends

    @classmethod
    def of(cls, docs: list[np.ndarray]) -> Rows:
        return cls(np.concatenate([*docs, np.zeros(0, np.int32)]).astype(np.int32), np.cumsum([0, *map(len, docs)]))

    def __len__(self) -> int:
        return len(self.ends) - 1

    def __getitem__(self, i: int) -> np.ndarray:
        return self.flat[self.ends[i] : self.ends[i + 1]]

    def __iter__(self) -> Iterator[np.ndarray]:
        return (self[i] for i in range(len(self)))


def log_count_ratios(docs: Rows, y: np.ndarray, n_features: int, smooth: float = 1.0) -> np.ndarray:
    label = np.repeat(y, np.diff(docs.ends))
    b, a = (smooth + np.bincount(docs.flat[label == k], minlength=n_features) for k in (0, 1))
    return np.log((a / a.sum()) / (b / b.sum()))


def dual_coordinate_descent(docs: Rows, scale: np.ndarray, sign: np.ndarray, cost: np.ndarray, epochs: int = 12, seed: int = 7, least: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias minimising |w|^2 / 2 + sum cost * hinge, one dual variable at a time,
    until a sweep moves none by `least`.

    A row's vector is its features' `scale` brought to unit length (a zero vector stays). The bias is the
    weight of a feature that is 1 in every row."""
    w, bias = np.zeros(len(scale)), 0.0
    alpha = np.zeros(len(docs))
    length = np.array([max(float(np.sqrt(np.square(scale[f]).sum())), 1e-9) for f in docs])
    square = np.array([float(np.square(scale[f]).sum()) / n**2 + 1 for f, n in zip(docs, length, strict=True)])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(docs)):
            f = docs[i]
            v = scale[f] / length[i]
            gradient = sign[i] * (float(w[f] @ v) + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                w[f] += step * v
                bias += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < least:
            break
    return w, bias


def fit(docs: Rows, labels: np.ndarray, n_features: int = FEATURES, cost: float = 10.0, mix: float = 0.25) -> Model:
    """A model of feature lists with 0/1 labels. With one class only, or no rows, it scores all alike."""
    y = np.asarray(labels, int)
    n1 = int(y.sum())
    if not len(y) or n1 in (0, len(y)):
        return Model(np.zeros(n_features), np.ones(n_features), 0.0, 0.0, 2.0 if n1 or not len(y) else -2.0)
    r = log_count_ratios(docs, y, n_features)
    weight = np.where(y == 1, len(y) / (2 * n1), len(y) / (2 * (len(y) - n1)))  # the rare class counts as much
    w, bias = dual_coordinate_descent(docs, r, np.where(y == 1, 1.0, -1.0), cost * weight)
    mean = np.abs(w[w != 0]).mean() if w.any() else 0.0
    model = Model(((1 - mix) * mean + mix * w) * r, r, bias, 1.0, 0.0) if mix < 1 else Model(w * r, r, bias, 1.0, 0.0)
    if mix < 1:
        model.bias = _best_bias(np.array([model.margin(f) - model.bias for f in docs]), y, weight)
    m = np.array([model.margin(f) for f in docs])
    model.slope = _slope(m, y, weight)
    return model


def _best_bias(m: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The threshold with the least weighted training error, as a bias."""
    order = np.argsort(m)
    wrong = np.concatenate([[0.0], np.cumsum(np.where(y[order] == 1, weight[order], -weight[order]))])
    k = int(wrong.argmin())
    edge = np.concatenate([[m[order[0]] - 1], m[order], [m[order[-1]] + 1]])
    return -float((edge[k] + edge[k + 1]) / 2)


def _slope(m: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Of the logistic curve through margin 0, by Newton's method."""
    a, t = 1.0, np.where(y == 1, 0.98, 0.02)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * m, -30, 30)))
        g, h = float((weight * m * (p - t)).sum()), float((weight * m * m * p * (1 - p)).sum()) + 1e-9
        a = min(max(a - g / h, 1e-3), 1e3)
    return a


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = MAX_TRAIN_ROWS) -> Model:
    """Fit on the labelled rows whose crc32(id as text) mod 3 isn't 1; at most `max_rows` of them
    (rows without id or with a label other than 0 and 1 aren't used), chosen by a hash of the id."""
    marked = pick(labels, doc_id=id_col, label=label_col).where("doc_id is not null and label in (0, 1)")
    chosen = marked.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = pick(docs, doc_id=id_col, text=text_col).where("doc_id is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [features(x.as_py()).astype("<i4").tobytes() for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.binary()), b.column(2)], names=["doc_id", "f", "label"])

    # at most max_rows ids: small enough to broadcast at any size of the tables
    rows = texts.join(F.broadcast(chosen), "doc_id").select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("label").cast("int")).mapInArrow(run, "doc_id long, f binary, label int")
    # one row for each id, however often it repeats and in whichever order
    once = rows.groupBy("doc_id").agg(F.max(F.struct("f", "label")).alias("r")).select("doc_id", "r.f", "r.label").toArrow().sort_by("doc_id")
    f = once.column("f").combine_chunks().cast(pa.large_binary())
    ends = np.frombuffer(f.buffers()[1], np.int64)[f.offset : f.offset + len(f) + 1]
    flat = np.frombuffer(f.buffers()[2], "<i4") if len(f) and f.buffers()[2] else np.zeros(0, np.int32)
    model = fit(Rows(flat[ends[0] // 4 : ends[-1] // 4] if len(f) else flat, (ends - ends[0]) // 4 if len(f) else np.zeros(1, np.int64)), once.column("label").to_numpy())
    del once, f, flat
    return model


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row; the score depends on the text alone.

    Null texts score as empty ones; a null id gives held_out = false; other columns are not read.
    The model has a fixed number of weights, so it is broadcast whole.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([m.score(x.as_py()) for x in b.column(1)], pa.float64())], names=["doc_id", "held_out", "score"])

    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", least: float = REJECT_BELOW) -> DataFrame:
    """Rows, with all their columns, whose text scores at least `least`. A null text scores as an empty
    one, repeated rows stay or go together, an empty table stays empty; columns may have any names."""
    spark, at = docs.sparkSession, docs.columns.index(text_col)
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            yield b.filter(pa.array([m.score(x.as_py()) >= least for x in b.column(at)], pa.bool_()))

    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def op4_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
