"""Quality classifier: Bradley-Terry pairwise ranking, thresholded at a score quantile.

A document's features are measures of its whole text (shares of byte classes, word and line statistics).
A preference pair holds a document labelled 1 and one labelled 0; weights are learned by the logistic
loss on the difference of their features, so a score is a strength and a difference of scores the log-odds
that one document is preferred.  The threshold is the quantile of the training scores that parts the
labels best; the score returned is the logistic of the distance to it, moved so that the threshold
falls on ``cut``.

The fit takes every labelled training row and every pair of them.  Features are computed once per document; means, spreads,
Newton steps and threshold each come from sums over all rows, made by Spark.  Strengths are compared in steps of
1 / ``STEPS``: the rows of a label within a step count as one strength, their mean, so a step's count and sum of features stand for all
pairs that its rows are in, and the driver holds tables of steps and features, whatever the number of rows.  Sums are of whole numbers
(standardised features are rounded to 1 / ``GRID``, weights to 1 / ``FINE``), so the model does not depend on the
order or the parting of the rows.  Scoring is one pass over all documents with the weights in the closure.

Defined cases: a null text counts as empty; labelled rows with a null label or without a text row are not
used; with no label, or only one, every document scores 1.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import extend_batches, texts_of
from quarry.session import forget, materialize

FEATURES = 24
GRID, FINE = 1 << 10, 1 << 16
STEPS, REACH = 8, 128  # steps of a strength in a unit, and of either sign; what is stronger goes to the last one
_LIMIT = 1 << 14  # of a feature, in its mean and spread
_CLASSES = np.zeros((256, 9))
for _i, _bytes in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b".,;:'\"-()", b"!?",
                             b"|", b"#$%&*@^~<>{}[]\\/=+_`", b" \t\n\r\v\f")):
    _CLASSES[list(_bytes), _i] = 1
_CLASSES[128:, 8] = 1


def features(text: bytes) -> np.ndarray:
    """FEATURES measures of a text, none of them null or infinite."""
    out = np.zeros(FEATURES)
    if not text:
        return out
    raw = np.frombuffer(text, np.uint8)
    out[:9] = np.bincount(raw, minlength=256) @ _CLASSES / len(raw)
    words = text.split()
    n = len(words)
    lines = text.split(b"\n")
    out[9] = np.log1p(len(raw))
    out[10] = np.log1p(n)
    out[15] = np.log1p(len(lines))
    out[16] = len(set(lines)) / len(lines)
    out[17] = np.log1p(len(raw) / len(lines))
    out[18] = sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines) / len(lines)
    if n:
        lengths = np.fromiter(map(len, words), np.int64, n)
        ends = np.frombuffer(b"".join([w[-1:] for w in words]), np.uint8)
        starts = np.frombuffer(b"".join([w[:1] for w in words]), np.uint8)
        out[11] = lengths.mean() / 10
        out[12] = np.log1p(lengths.max())
        out[13] = len(set(words)) / n
        out[14] = (lengths == 1).mean()
        out[19] = _CLASSES[ends, 6].mean()
        out[20] = _CLASSES[ends, 4].mean()
        out[21] = _CLASSES[starts, 0].mean()
        out[22] = lengths.std() / 10
        out[23] = 1 / (1 + n)
    return out


def expand(x: np.ndarray) -> np.ndarray:
    """Features with their squares, roots of the shares, and saturating marks of the rare classes."""
    rare = 1 - np.exp(-50 * x[:, [0, 2, 4, 5, 6, 19, 20]])
    return np.concatenate([x, x ** 2, np.sqrt(np.abs(x)), rare], axis=1)


class Ranker:
    """Bradley-Terry weights on standardised features, and the threshold that a score quantile gave."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, threshold: float, quantile: float, cut: float):
        self.mean, self.scale, self.weights = mean, scale, weights
        self.threshold, self.quantile, self.cut = threshold, quantile, cut

    def strength(self, x: np.ndarray) -> np.ndarray:
        return standardise(x, self.mean, self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(self.strength(x) - self.threshold, -30, 30) + np.log(self.cut / (1 - self.cut))
        return 1 / (1 + np.exp(-z))


def standardise(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.rint(np.clip((expand(x) - mean) / scale, -8, 8) * GRID) / GRID


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """label and features of up to 1024 rows (label, features) at a time."""
    for b in batches:
        for at in range(0, b.num_rows, 1024):
            part = b.slice(at, 1024)
            yield part.column(0).to_numpy(), part.column(1).flatten().to_numpy().reshape(-1, FEATURES)


def _sums(rows: DataFrame, measure: Callable[[np.ndarray, np.ndarray], Iterable[tuple[int, np.ndarray]]]) -> dict[int, np.ndarray]:
    """Sums over all rows of vectors of whole numbers, by key; ``measure`` gives (key, vector) of a block of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for label, x in _blocks(batches):
            for key, vector in measure(label, x):
                vector = np.rint(vector).astype(np.int64)
                held[key] = held[key] + vector if key in held else vector
        for key, vector in held.items():
            at = np.flatnonzero(vector)
            yield pa.RecordBatch.from_pydict({"key": pa.array(np.full(len(at), key)), "at": pa.array(at),
                                              "value": pa.array(vector[at])})

    found = (rows.select("label", "features").mapInArrow(run, "key long, at long, value long")
             .groupBy("key", "at").agg(F.sum("value").alias("value")).toPandas())
    out: dict[int, np.ndarray] = {}
    for key, part in found.groupby("key"):
        vector = np.zeros(int(part["at"].max()) + 1)
        vector[part["at"].to_numpy(np.int64)] = part["value"].to_numpy(float)
        out[int(key)] = vector
    return out


def _padded(vector: np.ndarray | None, width: int) -> np.ndarray:
    return np.zeros(width) if vector is None else np.pad(vector, (0, width - len(vector)))


def _moments(rows: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of the expanded features of all rows."""
    unit, half = 1 << 24, float(1 << 31)

    def first(label: np.ndarray, x: np.ndarray) -> list[tuple[int, np.ndarray]]:
        return [(0, np.r_[len(x), np.rint(np.minimum(expand(x), _LIMIT) * unit).sum(axis=0)])]

    total = _padded(_sums(rows, first)[0], 1 + width)
    mean = total[1:] / total[0] / unit

    def second(label: np.ndarray, x: np.ndarray) -> list[tuple[int, np.ndarray]]:
        square = np.rint((np.minimum(expand(x), _LIMIT) - mean) ** 2 * 2.0 ** 34)
        high = np.floor(square / half)
        return [(0, high.sum(axis=0)), (1, (square - high * half).sum(axis=0))]

    found = _sums(rows, second)
    spread = (_padded(found.get(0), width) * half + _padded(found.get(1), width)) / 2.0 ** 34 / total[0]
    return mean, np.sqrt(spread) + 1e-6


def _step(strength: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(strength * STEPS), -REACH, REACH - 1).astype(np.int64) + REACH


class _Pairs:
    """The loss of all pairs at some weights, with its gradient and what its curvature needs."""

    def __init__(self, rows: DataFrame, mean: np.ndarray, scale: np.ndarray, w: np.ndarray, ridge: float):
        self.rows, self.mean, self.scale, self.w, self.ridge = rows, mean, scale, w, ridge
        steps, width = 2 * REACH, len(w)

        def measure(label: np.ndarray, x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
            z = standardise(x, mean, scale)
            key = label * steps + _step(z @ w)
            order = np.argsort(key, kind="stable")
            keys, starts, counts = np.unique(key[order], return_index=True, return_counts=True)
            for k, n, v in zip(keys.tolist(), counts, np.add.reduceat(z[order] * GRID, starts, axis=0), strict=True):
                yield k, np.r_[n, v]

        found = _sums(rows, measure)
        table = np.stack([_padded(found.get(k), 1 + width) for k in range(2 * steps)]).reshape(2, steps, 1 + width)
        n, self.sums = table[:, :, 0], table[:, :, 1:] / GRID
        at = (self.sums @ w) / np.maximum(n, 1)
        gap = np.clip(at[1][:, None] - at[0][None, :], -700, 700)  # good less bad
        share = n[1][:, None] * n[0][None, :] / (n[1].sum() * n[0].sum())
        self.loss = float((share * np.logaddexp(0, -gap)).sum() + ridge * (w @ w))
        wrong = 1 / (1 + np.exp(np.clip(gap, -30, 30)))  # chance given to the wrong order
        pulls = [(share * wrong).sum(axis=0), (share * wrong).sum(axis=1)]
        means = self.sums / np.maximum(n, 1)[:, :, None]
        self.gradient = pulls[0] @ means[0] - pulls[1] @ means[1] + 2 * ridge * w
        bend = share * wrong * (1 - wrong)
        self.cross = means[1].T @ bend @ means[0]
        self.bends = np.stack([bend.sum(axis=0), bend.sum(axis=1)]) / np.maximum(n, 1)

    def curvature(self) -> np.ndarray:
        mean, scale, w, width = self.mean, self.scale, self.w, len(self.w)
        unit = np.maximum(self.bends.max(axis=1, keepdims=True), 1e-300) / (1 << 14)
        weight = np.rint(self.bends / unit)
        upper = np.triu_indices(width)

        def measure(label: np.ndarray, x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
            z = standardise(x, mean, scale)
            step = _step(z @ w)
            z *= GRID
            for y in (0, 1):
                own = z[label == y]
                yield y, ((own * weight[y][step[label == y]][:, None]).T @ own)[upper]

        found = _sums(self.rows, measure)
        out = np.zeros((width, width))
        for y in (0, 1):
            out[upper] += _padded(found.get(y), len(upper[0])) * unit[y] / GRID ** 2
        return out + np.triu(out, 1).T - self.cross - self.cross.T + 2 * self.ridge * np.eye(width)


def fit_pairs(rows: DataFrame, cut: float, ridge: float = 1e-3) -> Ranker | None:
    """Newton steps on the mean of log(1 + exp(-(s_good - s_bad))) over all pairs of ``rows`` (label, features), with a ridge."""
    if {r["label"] for r in rows.select("label").distinct().collect()} != {0, 1}:
        return None
    width = expand(np.zeros((1, FEATURES))).shape[1]
    mean, scale = _moments(rows, width)
    here = _Pairs(rows, mean, scale, np.zeros(width), ridge)
    for _ in range(25):
        step = np.linalg.solve(here.curvature(), here.gradient)
        if here.gradient @ step < 1e-6:  # twice what the step can still gain
            break
        size, there = 1.0, None
        while size > 1e-3 and (there is None or there.loss > here.loss):
            w = np.rint((here.w - size * step) * FINE) / FINE
            there = _Pairs(rows, mean, scale, w, ridge)
            size /= 2
        if there.loss >= here.loss:
            break
        here = there
    quantile, threshold = _best_quantile(_strengths(rows, Ranker(mean, scale, here.w, 0.0, 0.0, cut)))
    return Ranker(mean, scale, here.w, threshold, quantile, cut)


def _strengths(rows: DataFrame, ranker: Ranker) -> np.ndarray:
    """Bad rows, good rows, least and greatest strength of each 1 / GRID of strength, in its order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for label, x in _blocks(batches):
            yield pa.RecordBatch.from_pydict({"label": pa.array(label, pa.int32()), "s": pa.array(ranker.strength(x))})

    found = (rows.select("label", "features").mapInArrow(run, "label int, s double").groupBy(F.floor(F.col("s") * GRID).alias("place"))
             .agg(F.sum(1 - F.col("label")).alias("bad"), F.sum("label").alias("good"), F.min("s").alias("low"), F.max("s").alias("high"))
             .toPandas().sort_values("place"))
    return found[["bad", "good", "low", "high"]].to_numpy(float)


def _best_quantile(places: np.ndarray) -> tuple[float, float]:
    """The share of documents to reject that parts the labels best (balanced accuracy), and the score there."""
    bad, good, low, high = places.T
    below0, below1 = np.cumsum(bad) / max(1, bad.sum()), np.cumsum(good) / max(1, good.sum())
    at = int(np.argmax(below0 - below1))
    return float((bad + good)[:at + 1].sum() / (bad + good).sum()), float((high[at] + low[min(at + 1, len(low) - 1)]) / 2)


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls in the fold; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def sample_labels(labels: DataFrame, label_col: str, train: Column, per_class: int) -> DataFrame:
    """doc_id and label (0 or 1) of at most ``per_class`` training rows of each label, by the hash of their id."""
    rows = labels.where(train).select("doc_id", F.col(label_col).cast("int").alias("label")).dropna().distinct()
    order = F.xxhash64("doc_id")
    some = [rows.where(F.col("label") == v).orderBy(order, "doc_id").limit(per_class) for v in (0, 1)]
    return some[0].unionByName(some[1])


def add_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    def make():
        def run(b: pa.RecordBatch) -> dict[str, pa.Array]:
            x = np.stack([features(t) for t in texts_of(b, text_col)]) if b.num_rows else np.zeros((0, FEATURES))
            return {"features": pa.array(list(x.astype(np.float64)), pa.list_(pa.float64()))}

        return run

    return extend_batches(docs, make, [T.StructField("features", T.ArrayType(T.DoubleType()))])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", train: Column | None = None, cut: float = 0.3) -> Ranker | None:
    """A ranker from ``docs`` (doc_id, text) and all ``labels`` (doc_id, label); ``train`` picks label rows."""
    train = F.lit(True) if train is None else train
    marks = (labels.where(train).select("doc_id", F.col(label_col).cast("int").alias("label")).where("label IN (0, 1)")
             .dropna().distinct())
    # features first: a join that shuffles then moves them instead of the texts
    found = add_features(docs.select("doc_id", "text")).select("doc_id", "features").join(marks, "doc_id")
    rows = materialize(found.select("label", "features"), "quality-features")
    ranker = fit_pairs(rows, cut)
    forget(rows)
    return ranker


def score_documents(docs: DataFrame, ranker: Ranker | None, text_col: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from the threshold on)."""
    cut = ranker.cut if ranker else 0.0

    def make():
        def run(b: pa.RecordBatch) -> dict[str, pa.Array]:
            if ranker is None:
                s = np.ones(b.num_rows)
            else:
                s = ranker.score(np.stack([features(t) for t in texts_of(b, text_col)]))
            return {"score": pa.array(s, pa.float64()), "predicted": pa.array((s >= cut).astype(np.int32), pa.int32())}

        return run

    return extend_batches(docs, make, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
