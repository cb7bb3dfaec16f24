"""SimHash near-dedup by covering locality-sensitive hashing.

A document's fingerprint has 64 bits; two link when at most ``radius`` bits differ.  Every
bit position is given a nonzero vector of radius + 1 bits, and there is one table for each
nonzero mask vector: the table keeps the positions whose vector has an odd product with the
mask.  Any ``radius`` positions span less than the whole space, so some mask is orthogonal
to all of them: a pair within the radius agrees on all kept bits of at least one table.
Collision is certain, not likely.

The tables run over distinct fingerprints (copies were reduced to one row before).  A
fingerprint alone in all its buckets has no link.  The members of the others are linked without
pairs: two fingerprints are within radius 2 exactly if some word is within one bit of both,
so each member names itself and its one-bit neighbours in the bits its table does not keep;
a word is named by at most 65 fingerprints, all within 2 of each other, and points them at
the smallest.  Work is linear in the members, however large a bucket is, and no link is lost.
``radius`` 0 and 1 use the same tables with no neighbour, or neighbours on one side.

Defined cases: a null or empty text has fingerprint 0 and links like any other; a null id
takes part under its fingerprint and counts as larger than every id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import extend_batches, row_hash, texts_of
from quarry.llm.components import components
from quarry.session import materialize

BITS = 64


def simhash(text: bytes, shingle: int = 3) -> int:
    """Majority of each bit over the XXH64 (seed 42) of all word shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.empty_like(ends)
    starts[0] = 0
    starts[1:] = ends[:-1] + 1
    first, last = starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist()
    counts = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(first), 1 << 16):  # whole text, bounded memory
        h = np.fromiter((digest(line[a:b], 42) for a, b in zip(first[at:at + (1 << 16)], last[at:at + (1 << 16)])),
                        np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    on = counts * 2 > len(first)
    return int(np.packbits(on, bitorder="little").view(np.uint64)[0])


def add_fingerprints(docs: DataFrame, shingle: int = 3, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint as a signed 64-bit long."""

    def make():
        def run(b: pa.RecordBatch) -> dict[str, pa.Array]:
            prints = np.array([simhash(t, shingle) for t in texts_of(b, text_col)], np.uint64)
            return {out_col: pa.array(prints.view(np.int64), pa.int64())}

        return run

    return extend_batches(docs, make, [T.StructField(out_col, T.LongType())])


def cover_masks(radius: int) -> list[int]:
    """The kept bits of each covering table, as signed 64-bit numbers; 2^(radius+1) - 1 tables."""
    top = (1 << (radius + 1)) - 1
    vector = [1 + i % top for i in range(BITS)]
    masks = [sum(1 << i for i in range(BITS) if bin(vector[i] & m).count("1") % 2) for m in range(1, top + 1)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """(u, v) over distinct fingerprints ``fp``: edges whose components are those of all pairs within ``radius``.

    Both ends of an edge are within ``radius``.
    """
    if not 0 <= radius <= 2:
        raise ValueError("radius 0, 1 or 2")
    if radius == 0:
        return prints.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)
    masks = cover_masks(radius)
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.lit(m).alias("mask")) for i, m in enumerate(masks)])
    rows = prints.select("fp", F.explode(tables).alias("x")).select("fp", "x.t", F.col("fp").bitwiseAND(F.col("x.mask")).alias("kept"))
    shared = rows.groupBy("t", "kept").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi").select("t", "kept")
    near = materialize(rows.join(shared, ["t", "kept"]).select("fp", "t"), "cover-members")
    bits = F.array(*[F.lit(1 << i if i < 63 else -(1 << 63)) for i in range(BITS)])
    # the masks as one array literal by table; a member's free bits are those its table does not keep
    own_mask = F.element_at(F.array(*[F.lit(m) for m in masks]), F.col("t") + 1)
    free = F.filter(bits, lambda b: b.bitwiseAND(own_mask) == 0)
    around = F.transform(free, lambda b: F.col("fp").bitwiseXOR(b))
    if radius == 1:
        # a word is named by itself and by those one bit away: edges go through the fingerprint itself
        named = near.select("fp", F.explode(around).alias("z"))
        members = prints.select(F.col("fp").alias("z"))
        return named.join(members, "z").select(F.col("fp").alias("u"), F.col("z").alias("v")).distinct()
    named = near.select("fp", F.explode(F.concat(F.array(F.col("fp")), around)).alias("z"))
    stars = named.groupBy("z").agg(F.collect_set("fp").alias("members")).where(F.size("members") > 1)  # 65 at most
    return stars.select(F.explode("members").alias("u"), F.array_min("members").alias("v")).where("u <> v")


def _roots(distinct: DataFrame, radius: int) -> tuple[DataFrame, DataFrame]:
    """The rows of ``distinct`` (fingerprints ``fp``) with the ``root`` of their component, and the edges."""
    edges = materialize(links(distinct.select("fp"), radius).distinct(), "simhash-links")
    roots = components(edges)
    labelled = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return labelled.withColumn("root", F.coalesce("root", "fp")), edges


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text"
                    ) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest id reachable), n_links per row of ``docs``.

    ``n_links`` counts the edges of the document's fingerprint in the link table.
    """
    prints = add_fingerprints(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), shingle)
    prints = materialize(prints.select("doc_id", "fingerprint"), "simhash")
    distinct = materialize(prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("first_id")),
                           "simhash-distinct")
    labelled, edges = _roots(distinct, radius)
    degree = edges.select(F.explode(F.array("u", "v")).alias("fp")).groupBy("fp").agg(F.count(F.lit(1)).alias("n_links"))
    least = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = labelled.join(least, "root").select("fp", "component_id").join(degree, "fp", "left")
    return (prints.join(materialize(classes, "simhash-classes"), F.col("fingerprint") == F.col("fp"))
            .select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id",
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """One row of each component: that with the smallest id (of its rows with that id, the one whose text hashes lowest).

    Components are those of texts: rows that share an id, or have none, but are not linked all stay.  Rows
    without an id stay only where no row of their component has one.
    """
    # a row is known by its id and 128 bits of its text: rows that agree in them are copies, in one component
    key = [F.col(id_col).alias("__id"), row_hash(text_col).alias("__h"), F.xxhash64(F.lit(1), text_col).alias("__g")]
    prints = add_fingerprints(docs.select(*key, F.col(text_col).alias("text")), shingle)
    prints = materialize(prints.select("__id", "__h", "__g", "fingerprint"), "simhash")
    first = F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "__h", "__g"))
    distinct = materialize(prints.groupBy(F.col("fingerprint").alias("fp")).agg(first.alias("first")), "simhash-distinct")
    labelled, _ = _roots(distinct, radius)
    keep = materialize(labelled.groupBy("root").agg(F.min("first").alias("first"))
                       .select("first.__id", "first.__h", "first.__g"), "simhash-kept")

    def rows_of(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        same = left["__id"].eqNullSafe(right["__id"]) & (left["__h"] == right["__h"]) & (left["__g"] == right["__g"])
        return left.join(right, same, how)

    out = [F.struct(F.col(f"`{c}`")).getField(c).alias(c) for c in docs.columns]
    stay = rows_of(docs.select("*", *key), keep, "left_semi")
    # copies under one id are rare: only their rows are looked at again
    copies = prints.groupBy("__id", "__h", "__g").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    copies = materialize(rows_of(copies, keep, "left_semi"), "repeated-rows")
    if not copies.head(1):
        return stay.select(*out)
    single = rows_of(stay, copies, "left_anti")
    again = rows_of(stay, copies, "left_semi")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    again = again.groupBy("__id", "__h", "__g").agg(F.min_by(row, F.to_json(row)).alias("__row")).select("__row.*")
    return single.select(*out).unionByName(again.select(*[F.col(f"`{c}`") for c in docs.columns]))
