"""Quality classifier: naive Bayes support vectors.

Features are indicators of word n-grams: hashed words, and n-grams (up to
four words long) of word shapes, where a shape says which kinds of characters
a word has and whether it repeats the word before it.  Each indicator is
scaled by the log-count ratio of its n-gram between the classes, counted over
all training rows; a linear model with hinge loss is then fitted by dual
coordinate descent on a bounded sample, and its margin mapped to 0..1.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from geoweave.llm.common import fold_of, text_first, without

WORD_BITS, SHAPE_BITS = 17, 16
DIM = (1 << WORD_BITS) + (1 << SHAPE_BITS)


def _kinds() -> np.ndarray:
    """Bit of the kind of each byte: lower, upper, digit, stop, '!', rule, symbol, beyond ASCII."""
    t = np.full(256, 64, np.uint16)
    t[128:] = 128
    for bit, chars in ((1, range(97, 123)), (2, range(65, 91)), (4, range(48, 58)), (8, b".,;:?'\"()-"),
                       (16, b"!"), (32, b"|/\\<>{}[]")):
        t[list(chars)] = bit
    return t


_KINDS = _kinds()


def features(text: str | None) -> np.ndarray:
    """Sorted distinct feature numbers of a whole text (none for null, empty or blank texts)."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return np.empty(0, np.int64)
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(w) for w in words], np.uint64)
    raw = np.frombuffer(data, np.uint8)
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    kinds = np.where(inside, _KINDS[raw], 0).astype(np.uint16)
    shape = np.bitwise_or.reduceat(kinds, starts).astype(np.uint64)
    shape[1:] |= (h[1:] == h[:-1]).astype(np.uint64) << np.uint64(9)
    shape += np.uint64(1)
    out, gram = [(h >> np.uint64(64 - WORD_BITS)).astype(np.int64)], np.zeros(len(shape), np.uint64)
    for n in range(1, 5):
        if n > len(shape):
            break
        gram = gram[:len(shape) - n + 1] * np.uint64(2048) + shape[n - 1:]
        mixed = np.unique(gram) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
        out.append((mixed >> np.uint64(64 - SHAPE_BITS)).astype(np.int64) + (1 << WORD_BITS))
    return np.unique(np.concatenate(out))


@dataclass
class Model:
    """``weights`` already hold the log-count ratios; ``slope`` and ``shift`` map a margin to 0..1."""
    ratio: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, x: np.ndarray) -> float:
        if len(x) == 0:
            return self.bias
        norm = float(np.sqrt(np.square(self.ratio[x]).sum()))
        return float(self.weights[x].sum()) / norm + self.bias if norm else self.bias

    def score(self, margin):
        return 1 / (1 + np.exp(-np.clip(self.slope * np.asarray(margin) + self.shift, -30, 30)))


def log_count_ratio(good: np.ndarray, bad: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    p, q = good + smooth, bad + smooth
    return np.log((p / p.sum()) / (q / q.sum())).astype(np.float64)


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: np.ndarray,
                            dim: int, epochs: int = 12, seed: int = 5) -> tuple[np.ndarray, float]:
    """Linear SVM with hinge loss: minimise |w|^2/2 + sum cost * loss, one dual variable at a time.

    The bias is the weight of a constant feature.
    """
    w, b, alpha = np.zeros(dim), 0.0, np.zeros(len(rows))
    square = np.array([float(v @ v) + 1.0 for v in values])
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            x, v = rows[i], values[i]
            slope = y[i] * (w[x] @ v + b) - 1.0
            new = min(max(alpha[i] - slope / square[i], 0.0), cost[i])
            if step := (new - alpha[i]) * y[i]:
                w[x] += step * v
                b += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-4:
            break
    return w, b


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through (margin, label), by Newton steps on smoothed targets."""
    pos, neg = max(1, int((y > 0).sum())), max(1, int((y <= 0).sum()))
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    z, p = np.column_stack([margin, np.ones(len(margin))]), np.array([1.0, 0.0])
    for _ in range(50):
        s = 1 / (1 + np.exp(-np.clip(z @ p, -30, 30)))
        grad = z.T @ (s - t) + 1e-6 * p
        hess = (z * (s * (1 - s))[:, None]).T @ z + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        p = p - step
        if np.abs(step).max() < 1e-8:
            break
    return (float(p[0]), float(p[1])) if p[0] > 0 else (1.0, 0.0)


def _views(flat: np.ndarray, rows: list) -> list[np.ndarray]:
    """One slice of ``flat`` per row: a single allocation, which goes back to the system as a whole."""
    ends = np.cumsum([len(x) for x in rows], dtype=np.int64)
    return [flat[end - len(x):end] for end, x in zip(ends.tolist(), rows)]


def fit(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, c: float = 1.0) -> Model:
    """Fit on four fifths of the sample, map margins to 0..1 on the last fifth."""
    y = np.where(np.asarray(labels) > 0, 1.0, -1.0)
    if len(rows) == 0 or abs(y.sum()) == len(y):
        sure = 0.0 if len(rows) == 0 else 3.0 * y[0]
        return Model(ratio, np.zeros(DIM), 0.0, 1.0, sure)
    values = _views(np.empty(sum(map(len, rows))), rows)
    for x, v in zip(rows, values):
        v[:] = ratio[x]
        if n := np.sqrt(v @ v):
            v /= n
    share = {s: (y == s).mean() for s in (1.0, -1.0)}
    cost = np.array([c / (2 * share[s]) for s in y])
    late = np.arange(len(rows)) % 5 == 4
    if len(set(y[late])) < 2 or len(set(y[~late])) < 2:
        late[:] = False
    early = np.flatnonzero(~late)
    w, b = dual_coordinate_descent([rows[i] for i in early], [values[i] for i in early], y[early], cost[early], DIM)
    model = Model(ratio, w * ratio, b, 1.0, 0.0)
    held = np.flatnonzero(late) if late.any() else early
    model.slope, model.shift = calibrate(np.array([model.margin(rows[i]) for i in held]), y[held])
    return model


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, DIM), np.int64)
    for batch in batches:
        for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
            counts[label, features(text.as_py())] += 1
    cls, feature = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(feature, pa.int64()),
                                      pa.array(counts[cls, feature], pa.int64())], names=["cls", "feature", "n"])


def _scorer(shared, first: int, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = pickle.loads(shared.value)
        for batch in batches:
            m = np.array([model.margin(features(t.as_py())) for t in batch.column(0)], float)
            yield pa.RecordBatch.from_arrays([*batch.columns[first:], pa.array(model.score(m), pa.float64())],
                                             names=[*batch.schema.names[first:], out])
    return run


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 12_000, held_out_fold: int | None = 0,
          folds: int = 5, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Learn from labelled documents whose id is not in the held-out fold.

    N-gram counts come from every training row (one partial count per task,
    at most two numbers per hashed n-gram); the linear model is fitted on the
    ``sample_rows`` training documents (labelled and in ``docs``) with the
    smallest hash of their id, a documented bound that keeps the fit in driver
    memory.  Labels other than 0 and 1, and several labels of one id, do not
    train.  Without a training row every text scores 0.5.
    """
    lab = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")) \
        .where("label in (0, 1) and doc_id is not null").groupBy("doc_id") \
        .agg(F.min("label").alias("label"), F.max("label").alias("_hi")).where("label = _hi").drop("_hi")
    if held_out_fold is not None:
        lab = lab.where(fold_of(F.col("doc_id"), folds) != held_out_fold)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # labels grow with the corpus: joined by a shuffle at every size, never by a broadcast that stops working
    rows = d.join(lab.hint("merge"), "doc_id").select("text", "label", "doc_id")
    counts = np.zeros((2, DIM), np.int64)
    # at most 2 * DIM rows whatever the input
    for cls, feature, n in rows.select("text", "label").mapInArrow(_counter, "cls long, feature long, n long") \
            .groupBy("cls", "feature").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[cls, feature] = n
    chosen = rows.select("doc_id", "label").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    sample = d.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label") \
        .mapInArrow(_featuriser, "doc_id long, label int, x binary").collect()
    sample.sort(key=lambda r: (xxhash.xxh64_intdigest(str(r[0])), bytes(r[2])))
    y, x = np.array([r["label"] for r in sample]), [np.frombuffer(r["x"], "<i4") for r in sample]
    x = _views(np.concatenate([np.empty(0, "<i4"), *x]), x)
    del sample
    return fit(x, y, log_count_ratio(counts[1].astype(float), counts[0].astype(float)))


def _featuriser(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = [features(t.as_py()).astype("<i4").tobytes() for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(x, pa.binary())],
                                         names=["doc_id", "label", "x"])


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score", keep_text: bool = False) -> DataFrame:
    """``docs`` (without its text unless ``keep_text``) plus column ``out``: 0..1, higher means label 1 likelier.

    A column of ``docs`` named like ``out`` (in any case) is replaced; other
    columns pass through.  Null, empty and blank texts get the score of a text without n-grams.
    Repeated rows are scored as often as they occur; an empty table gives none.
    """
    d, kept = text_first(without(docs, text_col, out), text_col, keep_text)
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))  # 2 * DIM doubles, fixed size
    schema = StructType([*kept, StructField(out, DoubleType())])
    return d.mapInArrow(_scorer(shared, len(d.columns) - len(kept), out), schema)
