"""Document fingerprints by a homomorphic multiset hash.

A text is cut into paragraphs (at newlines) and each paragraph, where it is long, into pieces at spaces
that its own bytes choose, so an edit moves no cut but those beside it.  Every piece is hashed to 256
lanes of +1 or -1 (BLAKE2b), and a document's fingerprint is the sum of its pieces' vectors modulo 2^32
a lane.  A text has fewer than 2^31 bytes, so no lane of one wraps, however often a piece repeats.  Sums commute, so equal multisets of pieces have equal fingerprints in any order, and pieces
are inserted or deleted by adding or subtracting their vectors without reading the rest.

Lanes read as signed numbers form a tug-of-war sketch: the product of two fingerprints estimates the
pieces they share, each weighed by the product of its two counts, and likeness is twice that over the
sum of their own sizes.  In memory a lane is two 16-bit halves, the low one first.

Defined cases: a null text counts as empty; an empty text has one empty piece; equal ids are in
order of a hash of their texts, null ids are last; a table of one row has itself as its next row.
Rows of one id are spread by that hash; rows equal in id and text stay in one bucket.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import extend_batches, row_hash, texts_of

LANES = 256


def pieces(text: bytes) -> list[bytes]:
    """Paragraphs, cut after spaces whose three bytes before add up to a multiple of 8 (about every eighth)."""
    raw = np.frombuffer(text, np.uint8)
    newline = np.flatnonzero(raw == 10)
    space = np.flatnonzero(raw == 32)
    space = space[space >= 3]
    if len(space):
        mark = raw[space - 1].astype(np.int64) * 5 + raw[space - 2].astype(np.int64) * 3 + raw[space - 3]
        space = space[mark & 7 == 0]
    ends = np.union1d(newline, space).tolist()
    out, at = [], 0
    for e in ends:
        out.append(text[at:e])
        at = e + 1
    out.append(text[at:])
    return out


def vector(parts: Iterable[bytes]) -> np.ndarray:
    """The sum of the pieces' vectors modulo 2^32, as LANES pairs of unsigned 16-bit halves."""
    total = np.zeros(LANES, np.int64)
    digests = bytearray()

    def add() -> None:
        bits = np.unpackbits(np.frombuffer(bytes(digests), np.uint8).reshape(-1, LANES // 8), axis=1)
        total[:] += 2 * bits.sum(axis=0, dtype=np.int64) - len(bits)
        digests.clear()

    for p in parts:
        digests += hashlib.blake2b(p, digest_size=LANES // 8).digest()
        if len(digests) >= 1 << 17:
            add()
    if digests:
        add()
    return _halves(total.astype(np.uint32))  # the low 32 bits: modulo 2^32


def _halves(lanes: np.ndarray) -> np.ndarray:
    return lanes.astype("<u4").view("<u2")


def _lanes(print_: np.ndarray) -> np.ndarray:
    return print_.view("<u4")


def fingerprint(text: bytes) -> np.ndarray:
    return vector(pieces(text))


def inserted(print_: np.ndarray, parts: Iterable[bytes]) -> np.ndarray:
    return _halves(_lanes(print_) + _lanes(vector(parts)))


def deleted(print_: np.ndarray, parts: Iterable[bytes]) -> np.ndarray:
    return _halves(_lanes(print_) - _lanes(vector(parts)))


def to_hex(print_: np.ndarray) -> str:
    return _lanes(print_).astype(">u4").tobytes().hex()


def from_hex(digits: str) -> np.ndarray:
    return _halves(np.frombuffer(bytes.fromhex(digits), ">u4"))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    x, y = a.view("<i4").astype(np.float64), b.view("<i4").astype(np.float64)
    size = x @ x + y @ y
    return float(min(1.0, max(0.0, 2.0 * (x @ y) / size))) if size else 1.0


def add_fingerprints(docs: DataFrame, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint as hex digits."""

    def make():
        return lambda b: {out_col: pa.array([to_hex(fingerprint(t)) for t in texts_of(b, text_col)], pa.string())}

    return extend_batches(docs, make, [T.StructField(out_col, T.StringType())])


def _rank(points: list) -> Column:
    """How many of the sorted split points are not above the id, found in two steps: the group of points, then the point."""
    if not points:
        return F.lit(0)
    step = max(1, int(len(points) ** 0.5))
    groups = [points[i:i + step] for i in range(0, len(points), step)]
    lead = F.array(*[F.lit(g[0]) for g in groups])
    above = F.size(F.filter(lead, lambda p: p <= F.col("doc_id")))  # groups whose first point is not above the id
    tables = F.array(F.array(F.lit(points[0])), *[F.array(*[F.lit(p) for p in g]) for g in groups])
    inside = F.size(F.filter(F.element_at(tables, above + 1), lambda p: p <= F.col("doc_id")))
    return F.when(above == 0, F.lit(0)).otherwise((above - 1) * step + inside)


def _buckets(docs: DataFrame, number: int) -> tuple[Column, list[tuple]]:
    """The bucket of a row by (doc_id, order), and (bucket, id, order or None) of the first row of those that have rows.

    Ids fall from bucket to bucket, null ids are last.  An id (or null) that holds more rows than a bucket should is cut
    into equal ranges of the order, which is a hash; at most ``number`` ids are such.
    """
    ids = docs.select("doc_id")
    share = [i / number for i in range(1, number)]
    points = ids.agg(F.percentile_approx("doc_id", share, 20 * number)).first()[0] if share else []
    points = points or []
    repeated = sorted({p for p, q in zip(points, points[1:]) if p == q})  # an id of two shares stands twice
    points = sorted(set(points))
    candidate = F.col("doc_id").isin(repeated) if repeated else F.lit(False)
    counts = (ids.groupBy(F.when(candidate, F.col("doc_id")).alias("id"), F.col("doc_id").isNull().alias("missing"))
              .count().collect())  # one row a candidate, one for null and one for all others
    mean = max(1.0, sum(r["count"] for r in counts) / number)
    parts = {(None if r["missing"] else r["id"]): math.ceil(r["count"] / mean) for r in counts if r["missing"] or r["id"] is not None}
    hot = {i: n for i, n in parts.items() if n > 1}
    width = max(hot.values(), default=1)
    known = sorted(i for i in hot if i is not None)
    # a hot id is a rank of its own: split points up to it, then those below the next id
    major = _rank(sorted(set(points) | set(known)))
    if known:
        major = major + F.size(F.filter(F.array(*[F.lit(i) for i in known]), lambda p: p < F.col("doc_id")))
    last = len(set(points) | set(known)) + len(known)
    major = F.when(F.col("doc_id").isNull(), F.lit(last + 1)).otherwise(F.lit(last) - major).cast("long")
    cut = F.lit(1)
    for some in ([known[i:i + 500] for i in range(0, len(known), 500)]):
        table = F.create_map(*[F.lit(x) for i in some for x in (i, hot[i])])
        cut = F.coalesce(F.element_at(table, F.col("doc_id")), cut)
    cut = F.when(F.col("doc_id").isNull(), F.lit(hot.get(None, 1))).otherwise(cut)
    place = F.col("order").cast("double") / 2.0 ** 64 + 0.5  # 0 to 1, rising with the order
    bucket = major * width + F.least(F.floor(place * cut), cut - 1)
    is_hot = F.col("doc_id").isin(known) if known else F.lit(False)
    if None in hot:
        is_hot = F.col("doc_id").isNull() | F.coalesce(is_hot, F.lit(False))
    cold = ids.where(~F.coalesce(is_hot, F.lit(False))).withColumn("order", F.lit(0).cast("long"))
    heads = [(r["bucket"], r["head"], None) for r in
             cold.select(bucket.alias("bucket"), "doc_id").groupBy("bucket").agg(F.max("doc_id").alias("head")).collect()]
    if hot:  # the buckets of one id: the smallest order is first
        rows = docs.where(is_hot).select("doc_id", row_hash("text").alias("order"))
        heads += [(r["bucket"], r["doc_id"], r["order"]) for r in rows.select(bucket.alias("bucket"), "doc_id", "order")
                  .groupBy("bucket", "doc_id").agg(F.min("order").alias("order")).collect()]
    return bucket, sorted(heads, key=lambda h: h[0])  # one row a bucket


def with_next(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Rows (bucket, tail, doc_id, order, text) sorted within partitions; a bucket's rows stand in falling order of
    doc_id (equal ids by a hash of their texts), and after them (tail = 1) the first row of the next bucket; the last
    bucket's is the first of all.

    Texts cross one shuffle; per bucket one row is sent twice.
    """
    spark = docs.sparkSession
    number = buckets or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucket, heads = _buckets(docs, number)
    ordered = docs.select("doc_id", row_hash("text").alias("order"), "text")
    rows = ordered.select(bucket.alias("bucket"), F.lit(0).alias("tail"), "doc_id", "order", "text")
    if heads:
        following = heads[1:] + heads[:1]
        pairs = [(b, head, order) for (b, _, _), (_, head, order) in zip(heads, following, strict=True)]
        schema = T.StructType([T.StructField("to", T.LongType()), T.StructField("head", docs.schema["doc_id"].dataType),
                               T.StructField("at", T.LongType())])
        first = F.broadcast(spark.createDataFrame(pairs, schema))  # one row a bucket
        same = F.col("doc_id").eqNullSafe(F.col("head")) & (F.col("at").isNull() | (F.col("at") == F.col("order")))
        # the rows of that id, or of that id and order: the first of them, once, however often it is there
        copies = (ordered.join(first, same).groupBy(F.col("to").alias("bucket"))
                  .agg(F.min(F.struct("order", "doc_id", "text")).alias("r"))
                  .select("bucket", F.lit(1).alias("tail"), "r.doc_id", "r.order", "r.text"))
        rows = rows.unionByName(copies)
    return (rows.repartition("bucket").sortWithinPartitions("bucket", "tail", F.col("doc_id").desc_nulls_last(), "order"))


def _edited(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Each row with its next one; tails are only looked at."""
    out: list[tuple] = []
    last = None  # bucket, id, text, fingerprint of the row whose next one is awaited
    for b in batches:
        columns = [b.column(i).to_pylist() for i in (0, 1, 2)]  # bucket, tail, doc_id
        for bucket, tail, doc_id, text in zip(*columns, texts_of(b, "text"), strict=True):
            if last is not None and last[0] == bucket or not tail:
                text, own = text.decode(), fingerprint(text)
                if last is not None and last[0] == bucket:
                    out.append(_pair(last, text, own))
                last = None if tail else (bucket, doc_id, text, own)
            if len(out) >= 512:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _pair(row: tuple, next_text: str, next_print: np.ndarray) -> dict:
    _, doc_id, text, own = row
    cut = len(text) // 3
    edited = (text[:len(text) - cut] + next_text[:cut]).encode()
    changed = fingerprint(edited)
    return {"doc_id": doc_id, "n_chars": len(text), "edited_sha256": hashlib.sha256(edited).hexdigest(),
            "fingerprint": to_hex(own), "edited_fingerprint": to_hex(changed), "near_edited": likeness(own, changed),
            "near_next": likeness(own, next_print)}


def edit_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next per row of ``docs``.

    The edited text has its last third (rounded down) replaced by as many first code points of the next
    row, in falling order of id.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kinds = [("n_chars", T.LongType()), ("edited_sha256", T.StringType()), ("fingerprint", T.StringType()),
             ("edited_fingerprint", T.StringType()), ("near_edited", T.DoubleType()), ("near_next", T.DoubleType())]
    schema = T.StructType([T.StructField("doc_id", slim.schema["doc_id"].dataType)] + [T.StructField(*k) for k in kinds])
    return paired(with_next(slim), schema)


def paired(laid: DataFrame, schema: T.StructType) -> DataFrame:
    """The measures of every row of ``with_next`` against the row after it."""
    arrow = {T.LongType(): pa.int64(), T.StringType(): pa.string(), T.DoubleType(): pa.float64(), T.IntegerType(): pa.int32()}
    out = pa.schema([(f.name, arrow[f.dataType]) for f in schema])
    return laid.mapInArrow(lambda it: _edited(it, out), schema)
