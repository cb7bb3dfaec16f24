"""Toxicity: a linear-chain conditional random field over the words of a document.

States are clean (0) and toxic (1).  A word's observation is its class: class 0 for words that say
nothing, the others by how much more often the word stands in toxic training documents than in
clean ones (lower confidence bounds of the log-odds of document counts).  A training word is labelled
toxic if its class is not 0 and its document is labelled toxic.  Classes come from one half of the
training sample and the field from the other, so words that one document happens to repeat earn
a class but no weight.  The field is fitted by gradient steps on the likelihood of the labelled words
of windows around classed words and of background windows.

Scoring runs forward-backward over the whole text: runs of class-0 words are one step by a power of the
neutral transition, so the work per word is one dictionary look-up.  The marginals of the toxic state
are aggregated (largest, and expected number of toxic words) by a logistic fit whose intercept puts the
best threshold on ``cut``; words of marginal 0.5 or more give the offending offsets.

The fit uses at most ``per_class`` labelled documents of each label (the smallest hashes of their ids),
at most ``lexicon_size`` words, and is otherwise the same at every size.

Defined cases: a null text counts as empty; a text without classed words has the base score; without
labels of both kinds every document scores 0.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import extend_batches, texts_of
from quarry.llm.quality import sample_labels
from quarry.session import materialize

CLASSES = 7  # 0 and six steps of the bound
WINDOW = 6  # words on either side of a classed word in a training window
_EDGES = re.compile(rb"^[\x00-\x40\x5b-\x60\x7b-\x7f]+|[\x00-\x40\x5b-\x60\x7b-\x7f]+$")
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def normal(word: bytes) -> bytes:
    """Lower-case A-Z, without digits and ASCII signs at either end."""
    return _EDGES.sub(b"", word).lower()


class Classes(dict):
    """word as it stands -> class; filled as words are met, emptied when it grows large."""

    def __init__(self, lexicon: dict[bytes, int]):
        self.lexicon = lexicon

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        c = self[word] = self.lexicon.get(normal(word), 0)
        return c

    def of(self, text: bytes) -> np.ndarray:
        words = text.split()
        return np.fromiter(map(self.__getitem__, words), np.int8, len(words))


class Field:
    """emission[c]: weight of the toxic state for class c; move[a, b]: weight of a step; start[a]."""

    def __init__(self, emission: np.ndarray, move: np.ndarray, start: np.ndarray):
        self.emission, self.move, self.start = emission, move, start
        self._neutral_powers()

    def _neutral_powers(self) -> None:
        step = np.exp(self.move) * np.exp([0.0, self.emission[0]])[None, :]  # into a class-0 word
        powers = [np.eye(2)]
        for _ in range(64):
            p = powers[-1] @ step
            powers.append(p / p.sum())
        self.powers = [p.ravel().tolist() for p in powers]  # beyond, the last one: rows have converged

    def marginals(self, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, chance of the toxic state) of the words whose class is not 0."""
        at = np.flatnonzero(classes)
        if not len(at):
            return at, np.zeros(0)
        last = len(self.powers) - 1
        gaps = np.diff(at, prepend=-1) - 1  # class-0 words before each
        tail = len(classes) - 1 - int(at[-1])
        factors = np.exp(self.emission)[classes[at]].tolist()
        m00, m01, m10, m11 = np.exp(self.move).ravel().tolist()
        # forward: before the first word stands a start vector; a leading run enters by it
        s0, s1 = np.exp(self.start).tolist()
        forward = []
        a0 = a1 = 0.0
        for i, (gap, f) in enumerate(zip(gaps.tolist(), factors)):
            if i == 0:
                if gap:
                    p = self.powers[min(gap - 1, last)]
                    b0, b1 = s0, s1 * float(np.exp(self.emission[0]))
                    b0, b1 = b0 * p[0] + b1 * p[2], b0 * p[1] + b1 * p[3]
                    a0, a1 = b0 * m00 + b1 * m10, (b0 * m01 + b1 * m11) * f
                else:
                    a0, a1 = s0, s1 * f
            else:
                p = self.powers[min(gap, last)]
                b0, b1 = a0 * p[0] + a1 * p[2], a0 * p[1] + a1 * p[3]
                a0, a1 = b0 * m00 + b1 * m10, (b0 * m01 + b1 * m11) * f
            total = a0 + a1
            a0, a1 = a0 / total, a1 / total
            forward.append((a0, a1))
        p = self.powers[min(tail, last)]
        b0, b1 = p[0] + p[1], p[2] + p[3]
        out = [0.0] * len(at)
        for i in range(len(at) - 1, -1, -1):
            a0, a1 = forward[i]
            out[i] = a1 * b1 / (a0 * b0 + a1 * b1)
            f = factors[i]
            c0, c1 = m00 * b0 + m01 * f * b1, m10 * b0 + m11 * f * b1
            p = self.powers[min(int(gaps[i]), last)]
            b0, b1 = p[0] * c0 + p[1] * c1, p[2] * c0 + p[3] * c1
            total = b0 + b1
            b0, b1 = b0 / total, b1 / total
        return at, np.array(out)


def fit_field(classes: np.ndarray, tags: np.ndarray, weight: np.ndarray, steps: int = 300, rate: float = 0.1,
              ridge: float = 1e-4) -> Field:
    """Adam steps on the log-likelihood of tag sequences (rows of equal length, -1 pads at the end)."""
    n, length = classes.shape
    valid = classes >= 0
    c = np.where(valid, classes, 0)
    total = weight.sum()
    theta = np.zeros(CLASSES + 4 + 2)
    theta[0] = -2.0
    seen = np.zeros_like(theta)  # counts in the data
    w2 = np.where(valid, weight[:, None], 0.0)
    np.add.at(seen, c[tags == 1], w2[tags == 1])
    pair = valid[:, 1:]
    np.add.at(seen, CLASSES + 2 * tags[:, :-1][pair] + tags[:, 1:][pair], w2[:, 1:][pair])
    np.add.at(seen, CLASSES + 4 + tags[:, 0], weight)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        emission, move, start = theta[:CLASSES], theta[CLASSES:CLASSES + 4].reshape(2, 2), theta[CLASSES + 4:]
        node = np.stack([np.zeros((n, length)), emission[c]], axis=2)
        trans = np.exp(move)
        potentials = np.exp(node)
        alpha, beta = np.zeros((n, length, 2)), np.ones((n, length, 2))
        alpha[:, 0] = np.exp(start) * potentials[:, 0]
        alpha[:, 0] /= alpha[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, length):
            a = (alpha[:, t - 1] @ trans) * potentials[:, t]
            a = np.where(valid[:, t, None], a, alpha[:, t - 1])
            alpha[:, t] = a / a.sum(axis=1, keepdims=True)
        for t in range(length - 2, -1, -1):
            b = (potentials[:, t + 1] * beta[:, t + 1]) @ trans.T
            b = np.where(valid[:, t + 1, None], b, beta[:, t + 1])
            beta[:, t] = b / b.sum(axis=1, keepdims=True)
        gamma = alpha * beta
        gamma /= gamma.sum(axis=2, keepdims=True)
        expected = np.zeros_like(theta)
        np.add.at(expected, c[valid], (gamma[:, :, 1] * w2)[valid])
        for t in range(1, length):
            x = alpha[:, t - 1, :, None] * trans[None] * (potentials[:, t] * beta[:, t])[:, None, :]
            x = x / x.sum(axis=(1, 2), keepdims=True) * w2[:, t, None, None]
            expected[CLASSES:CLASSES + 4] += x.sum(axis=0).ravel()
        expected[CLASSES + 4:] += (gamma[:, 0] * weight[:, None]).sum(axis=0)
        gradient = (seen - expected) / total - ridge * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient ** 2
        theta = theta + rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Field(theta[:CLASSES].copy(), theta[CLASSES:CLASSES + 4].reshape(2, 2).copy(), theta[CLASSES + 4:].copy())


class Tagger:
    """Lexicon, field and the logistic aggregate of a document's marginals."""

    def __init__(self, lexicon: dict[bytes, int], field: Field, weights: np.ndarray, cut: float):
        self.lexicon, self.field, self.weights, self.cut = lexicon, field, weights, cut

    def score(self, p: np.ndarray) -> float:
        z = float(aggregate(p) @ self.weights[:-1] + self.weights[-1])
        return 1 / (1 + np.exp(-min(30.0, max(-30.0, z))))


def aggregate(p: np.ndarray) -> np.ndarray:
    """Of a document's marginals: the largest, and the log of one more than the expected toxic words."""
    strong = p[p >= 0.5]
    return np.array([p.max(initial=0.0), np.log1p(strong.sum())])


def _fit_logistic(x: np.ndarray, y: np.ndarray, cut: float) -> np.ndarray:
    """Ridge logistic weights; the intercept is then moved so that the best F1 threshold scores ``cut``."""
    z = np.c_[x, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        curve = (z * (p * (1 - p))[:, None]).T @ z + 0.1 * np.eye(len(w))
        w = w + np.linalg.solve(curve, z.T @ (y - p) - 0.1 * w)
    s = z @ w
    values = np.unique(s)
    best, at = -1.0, 0.0
    for low, high in zip(np.r_[values[0] - 1, values[:-1]], values):
        hit = s >= high
        f1 = 2 * (hit & (y == 1)).sum() / max(1, hit.sum() + (y == 1).sum())
        if f1 > best:
            best, at = f1, (low + high) / 2
    w[-1] += np.log(cut / (1 - cut)) - at
    return w


def _word_counts(rows: DataFrame) -> DataFrame:
    """word, toxic, clean: documents of each label that hold the word."""
    schema = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("label", T.IntegerType())])

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                words, label = [], []
                for t, y in zip(texts_of(part, "text"), part.column(part.schema.get_field_index("label")).to_pylist()):
                    own = {normal(w) for w in set(t.split())} - {b""}
                    words.extend(own)
                    label.extend([y] * len(own))
                yield pa.RecordBatch.from_pydict({"word": pa.array(words, pa.binary()), "label": pa.array(label, pa.int32())})

    return rows.select("text", "label").mapInArrow(run, schema).groupBy("word").agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", train: Column | None = None, per_class: int = 4000,
        lexicon_size: int = 5000, min_docs: int = 3, windows: int = 20_000, per_text: int = 8, cut: float = 0.3) -> Tagger | None:
    """A tagger from ``docs`` (doc_id, text) and ``labels`` (doc_id, label); ``train`` picks label rows.

    Learned from at most ``per_class`` labelled ids of each kind (by the hash of the id); repeated ids bring at most
    4 x ``per_class`` texts to the field.  Of a text the field sees up to ``per_text`` windows of its classed words and one
    without, of all texts ``windows``, both picked by hash over their whole length.  The lexicon is learned from one half
    of the texts and the field from the other; with a kind missing in a half both learn from all.  None, which scores 0
    everywhere, where a kind of label is missing, or the toxic texts hold no word that tells them apart.
    """
    some = sample_labels(labels, label_col, F.lit(True) if train is None else train, per_class)
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")  # 2 x per_class ids
    rows = rows.withColumn("half", F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)))
    rows = materialize(rows, "toxic-sample")
    sizes = {(r["half"], r["label"]): r["n"] for r in rows.groupBy("half", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if {label for _, label in sizes} != {0, 1}:
        return None
    split = len(sizes) == 4
    n1, n0 = (sizes[0, label] if split else sum(n for (_, own), n in sizes.items() if own == label) for label in (1, 0))
    odds = (F.log((F.col("toxic") + 0.5) / (n1 + 1 - F.col("toxic"))) - F.log((F.col("clean") + 0.5) / (n0 + 1 - F.col("clean"))))
    spread = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    counted = (_word_counts(rows.where("half = 0") if split else rows).where(F.col("toxic") >= min_docs)
               .withColumn("bound", odds - spread).where("bound > 0.5")
               .orderBy(F.col("bound").desc(), "word").limit(lexicon_size).collect())
    lexicon = {bytes(r["word"]): 1 + min(CLASSES - 2, int((r["bound"] - 0.5) / 0.6)) for r in counted}
    found = _fit_rows(rows.where("half = 1") if split else rows, lexicon)
    sample = found.orderBy(F.xxhash64("doc_id"), "doc_id").limit(4 * per_class).toPandas()
    tables = [t for c, g, n, y in zip(sample["classes"], sample["at"], sample["n_words"], sample["label"])
              if len(t := _windows(np.array(c, np.int64), np.array(g, np.int64), n, y, per_text))]
    if not tables:
        return None
    table = np.concatenate(tables)
    table = table[np.argsort(_mixed(np.arange(len(table))), kind="stable")[:windows]]
    classes, tags = table[:, 0], table[:, 1]
    if not tags.any():
        return None
    field = fit_field(classes, tags, np.ones(len(classes)))
    marks = [field.marginals(_spread(c, g, n))[1] for c, g, n in zip(sample["classes"], sample["at"], sample["n_words"])]
    x = np.stack([aggregate(p) for p in marks])
    return Tagger(lexicon, field, _fit_logistic(x, sample["label"].to_numpy().astype(float), cut), cut)


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """A fixed scrambling of numbers, to pick some of them as if by lot."""
    h = numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h * np.uint64(0xBF58476D1CE4E5B9)


def _fit_rows(rows: DataFrame, lexicon: dict[bytes, int]) -> DataFrame:
    """doc_id, label, n_words, and class and position of each classed word."""
    def make():
        table = Classes(lexicon)

        def run(b: pa.RecordBatch) -> dict[str, pa.Array]:
            found = [table.of(t) for t in texts_of(b, "text")]
            at = [np.flatnonzero(c) for c in found]
            return {"n_words": pa.array([len(c) for c in found], pa.int64()),
                    "at": pa.array([a.tolist() for a in at], pa.list_(pa.int64())),
                    "classes": pa.array([c[a].tolist() for c, a in zip(found, at)], pa.list_(pa.int64()))}

        return run

    longs = T.ArrayType(T.LongType())
    return extend_batches(rows.select("doc_id", "label", "text"), make, [
        T.StructField("n_words", T.LongType()), T.StructField("at", longs), T.StructField("classes", longs)]).drop("text")


def _spread(classes, at, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    out[np.asarray(at, np.int64)] = np.asarray(classes, np.int64)
    return out


def _windows(classes: np.ndarray, at: np.ndarray, n: int, label: int, per_text: int = 8) -> np.ndarray:
    """(windows, 2, length): classes (-1 pads) and tags of up to ``per_text`` disjoint windows and one more.

    Windows around classed words are found over the whole text and picked by a hash of their place; the one more
    starts at a hashed place, unless that lies in one of them.
    """
    length = 2 * WINDOW + 1
    full = _spread(classes, at, n)
    tags = (full > 0) & (label == 1)
    starts, upto = [], 0
    for a in at.tolist():
        if a >= upto:
            starts.append(max(0, a - WINDOW))
            upto = starts[-1] + length
    if len(starts) > per_text:
        order = np.argsort(_mixed(np.array(starts) + 977 * n), kind="stable")[:per_text]
        starts = sorted(starts[i] for i in order)
    if n:
        anywhere = int(_mixed(np.array([n]))[0] % np.uint64(max(1, n - length + 1)))
        if all(abs(anywhere - s) >= length for s in starts):
            starts.append(anywhere)
    out = np.full((len(starts), 2, length), 0, np.int64)
    out[:, 0] = -1
    for i, s in enumerate(starts):
        part = full[s:s + length]
        out[i, 0, :len(part)] = part
        out[i, 1, :len(part)] = tags[s:s + length]
    return out


def spans(text: bytes, at: np.ndarray, p: np.ndarray) -> list[dict]:
    """start, end (code points) and chance of the words at the positions ``at``."""
    if not len(at):
        return []
    chance = dict(zip(at.tolist(), p.tolist()))
    out, bytes_before, chars_before = [], 0, 0
    for i, m in enumerate(_WORD.finditer(text)):
        if i in chance:
            chars_before += len(text[bytes_before:m.start()].decode())
            size = len(m.group().decode())
            out.append({"start": chars_before, "end": chars_before + size, "chance": chance[i]})
            bytes_before, chars_before = m.end(), chars_before + size
    return out


def tag_documents(docs: DataFrame, tagger: Tagger | None, text_col: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1), predicted, and spans of the offending words (code point offsets)."""
    cut = tagger.cut if tagger else 1.0

    def make():
        table = Classes(tagger.lexicon) if tagger else None

        def run(b: pa.RecordBatch) -> dict[str, pa.Array]:
            scores, found = [], []
            for t in texts_of(b, text_col):
                if tagger is None:
                    scores.append(0.0)
                    found.append([])
                    continue
                at, p = tagger.field.marginals(table.of(t))
                scores.append(tagger.score(p))
                found.append(spans(t, at[p >= 0.5], p[p >= 0.5]))
            return {"score": pa.array(scores, pa.float64()),
                    "predicted": pa.array([int(s >= cut) for s in scores], pa.int32()),
                    "spans": pa.array(found, SPANS)}

        return run

    one = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                        T.StructField("chance", T.DoubleType())])
    return extend_batches(docs, make, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
                                       T.StructField("spans", T.ArrayType(one))])


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("chance", pa.float64())]))
