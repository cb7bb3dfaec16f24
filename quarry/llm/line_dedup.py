"""Line dedup: two Bloom filters find suspected repeats, and only those shuffle for an exact count.

A line's key is the line without space and 0x09-0x0D at its ends and with A-Z lower-cased.
Every task hashes the distinct keys of each of its documents into a pair of bit arrays: positions
hit by at least one document, and by at least two.  The arrays travel as slices of 8 kB, only those
that are not empty; a slice's pairs are merged as a stream (once: OR; twice: OR of the twice parts
and of every overlap of the once parts).  A key that two documents hold has all its
positions in the merged twice filter, so nothing is lost; other keys pass it rarely and are
put right by the exact count.

The filter has 8 bits a line, from a count over all lines, at most ``max_bits`` (2^28 bits = 32 MB,
the bound of what is broadcast).  Beyond that more unique lines pass as suspects; the result is the
same and only the shuffle grows.  Keys that are confirmed go back to their documents by a join
(a frequent key's documents are split by the join, a document's keys are no more than its lines).

Defined cases: a null or empty text is one empty line; every row is a document of its own for the
counts, equal rows included; a null id is an id like any other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import extend_batches, row_hash, texts_of
from quarry.session import materialize

SLICE = 1 << 13  # bytes of a slice of a filter


def line_key(line: bytes) -> bytes:
    return line.strip().lower()


def _keys(text: bytes, min_chars: int) -> set[bytes]:
    keys = {line_key(x) for x in text.split(b"\n")}
    return {k for k in keys if len(k) >= min_chars and (min_chars <= 1 or len(k.decode()) >= min_chars)}


def _probes(keys: list[bytes], bits: int) -> np.ndarray:
    """Two positions a key, shape (2, keys)."""
    h = np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))
    mask = np.uint64(bits - 1)
    return np.stack([h & mask, (h >> np.uint64(32)) & mask]).astype(np.int64)


def _test(packed: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _set(packed: np.ndarray, at: np.ndarray) -> None:
    """Set bits at sorted distinct positions."""
    if not len(at):
        return
    byte, bit = at >> 3, (1 << (at & 7)).astype(np.uint8)
    first = np.flatnonzero(np.r_[True, byte[1:] != byte[:-1]])
    packed[byte[first]] |= np.bitwise_or.reduceat(bit, first)


def _task_filters(bits: int, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        seen = False
        for b in batches:
            for start in range(0, b.num_rows, 512):
                keys: list[bytes] = []
                for t in texts_of(b.slice(start, 512), "text"):
                    keys.extend(_keys(t, min_chars))
                at, n = np.unique(_probes(keys, bits), return_counts=True)
                _set(twice, at[(n > 1) | _test(once, at)])
                _set(once, at)
                seen |= bool(keys)
        if seen:
            once, twice = once.reshape(-1, SLICE), twice.reshape(-1, SLICE)
            used = np.flatnonzero(once.any(axis=1))
            for part in np.array_split(used, max(1, len(used) // 64)):
                yield pa.RecordBatch.from_pydict({
                    "slice": pa.array(part, pa.int32()),
                    "once": pa.array([zlib.compress(once[i].tobytes(), 1) for i in part], pa.binary()),
                    "twice": pa.array([zlib.compress(twice[i].tobytes(), 1) for i in part], pa.binary())})

    return run


def _merge_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by slice; gives the twice part of each slice where it is not empty."""
    current, once, twice = None, None, None

    def done() -> Iterator[pa.RecordBatch]:
        if current is not None and twice.any():
            yield pa.RecordBatch.from_pydict({"slice": pa.array([current], pa.int32()),
                                              "twice": pa.array([zlib.compress(twice.tobytes(), 1)], pa.binary())})

    for b in batches:
        for i, o, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            o, t = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (o, t))
            if i != current:
                yield from done()
                current, once, twice = i, o.copy(), t.copy()
            else:
                twice |= t | (once & o)
                once |= o
    yield from done()


def filter_bits(lines: int, max_bits: int) -> int:
    """8 bits a line, a power of two from one slice to ``max_bits``."""
    return min(max_bits, max(SLICE * 8, 1 << max(0, int(8 * lines - 1)).bit_length()))


def twice_filter(docs: DataFrame, min_chars: int, max_bits: int) -> tuple[int, bytes]:
    """(bits, packed filter) of positions that keys of two documents hit; at most ``max_bits / 8`` bytes."""
    n = F.length("text") - F.length(F.translate("text", "\n", "")) + 1
    lines = docs.agg(F.sum(n)).first()[0] or 0
    bits = filter_bits(lines, max_bits)
    parts = docs.select("text").mapInArrow(_task_filters(bits, min_chars), "slice int, once binary, twice binary")
    merged = (parts.repartition("slice").sortWithinPartitions("slice")
              .mapInArrow(_merge_slices, "slice int, twice binary"))
    packed = np.zeros((bits // 8 // SLICE, SLICE), np.uint8)
    for row in merged.toLocalIterator():
        packed[row["slice"]] = np.frombuffer(zlib.decompress(bytes(row["twice"])), np.uint8)
    return bits, packed.tobytes()


def repeated_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, max_bits: int = 1 << 28
                   ) -> tuple[DataFrame, DataFrame]:
    """(occurrences, keys): doc_id, row, key of suspected repeats, and key, n_docs, first_doc of the confirmed.

    ``docs`` has doc_id and text; ``first_doc`` is the smallest id that holds the key (null ids last).
    """
    spark = docs.sparkSession
    bits, packed = twice_filter(docs, min_chars, max_bits)
    shared = spark.sparkContext.broadcast(packed)
    id_type = docs.schema["doc_id"].dataType

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = np.frombuffer(shared.value, np.uint8)
        for b in batches:
            for start in range(0, b.num_rows, 512):
                part = b.slice(start, 512)
                keys: list[bytes] = []
                of: list[int] = []
                for i, t in enumerate(texts_of(part, "text")):
                    own = _keys(t, min_chars)
                    keys.extend(own)
                    of.extend([i] * len(own))
                if not keys:
                    continue
                hit = np.flatnonzero(_test(twice, _probes(keys, bits)).all(axis=0))
                at = pa.array(np.array(of, np.int64)[hit])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), pa.array([keys[i] for i in hit], pa.binary())],
                    ["doc_id", "row", "key"])

    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("row", T.LongType()),
                           T.StructField("key", T.BinaryType())])
    source = docs.select("doc_id", row_hash("doc_id", "text").alias("row"), "text")
    found = materialize(source.mapInArrow(suspects, schema), "line-suspects")
    counted = (found.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"))
               .where(F.col("n_docs") >= min_docs))
    return found, materialize(counted, "line-repeats")


def drop_repeated_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False,
                        max_bits: int = 1 << 28, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``text`` cut to its kept lines, and n_lines, n_dropped.

    Lines whose key stands in ``min_docs`` documents or more go everywhere, or, with
    ``keep_first``, everywhere but in the document with the smallest id.  A text that loses
    nothing is returned as it is (null stays null).
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found, repeats = repeated_lines(slim, min_docs, min_chars, max_bits)
    gone = found.join(repeats, "key")
    if keep_first:
        gone = gone.where(~F.col("doc_id").eqNullSafe(F.col("first_doc")))
    gone = gone.groupBy(F.col("doc_id").alias("__id"), F.col("row").alias("__row")).agg(
        F.collect_set("key").alias("__gone"))
    row = row_hash(id_col, text_col)
    joined = docs.join(gone, docs[id_col].eqNullSafe(gone["__id"]) & (row == gone["__row"]), "left").drop("__id", "__row")

    def make():
        def cut(b: pa.RecordBatch) -> dict[str, pa.Array]:
            column = b.column(b.schema.get_field_index(text_col))
            drops = b.column(b.schema.get_field_index("__gone")).to_pylist()
            kept, lines, dropped = [], [], []
            for t, raw, drop in zip(texts_of(b, text_col), column.is_null().to_pylist(), drops, strict=True):
                all_lines = t.split(b"\n")
                stay = all_lines
                if drop:
                    drop = set(drop)
                    stay = [x for x in all_lines if line_key(x) not in drop]
                kept.append(None if raw else t if stay is all_lines else b"\n".join(stay))
                lines.append(len(all_lines))
                dropped.append(len(all_lines) - len(stay))
            return {text_col: pa.array(kept, pa.binary()).cast(pa.string()), "n_lines": pa.array(lines, pa.int64()),
                    "n_dropped": pa.array(dropped, pa.int64())}

        return cut

    out = extend_batches(joined, make, [T.StructField(text_col, T.StringType()), T.StructField("n_lines", T.LongType()),
                                        T.StructField("n_dropped", T.LongType())])
    return out.drop("__gone")
