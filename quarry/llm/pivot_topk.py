"""Exact top-k by inner product with pivot-table elimination.

Vectors become integers, floor(1024 x).  They are dealt into shards of about ``shard_rows`` rows; a shard's task
picks pivots among its rows (each the farthest from those before it) and keeps the distance of
every row to every pivot.  For a query, |d(q, p) - d(o, p)| over the pivots gives a lower bound of its distance to
a row, its largest value the best one, and with the norms an upper bound of the inner product.  Rows are
evaluated exactly in falling order of that bound until the k-th best score is above every bound left, so
the result is that of a full scan, ties included.

Query rows are sent to every shard of their dimension and stream through it in blocks; a shard gives at most k rows
a query, and those are ranked once more.  Memory is one shard and one block, whatever the number
of queries.

Scores are exact whatever the numbers: by the norms of a query and of the shard, its products are taken in doubles that
hold every partial sum, in 64-bit integers, or in Python's integers.

Defined cases: rows with a null id, or a vector that is null or holds a null, NaN or infinity (1024 x beyond a double
counts as one), take no part; a score that does not fit a long is left out; vectors of different lengths
do not compare; rows that share a query's id are its own; of equal query ids the smallest vector asks; equal rows
are candidates each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import materialize

INDEX = "dim int, vec_id long, vec binary"
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def quantized(batches: Iterator[pa.RecordBatch], factor: float = 1024.0) -> Iterator[pa.RecordBatch]:
    """(vec_id, vector) batches -> dim, vec_id and the integers, packed in 2 or 4 bytes each, or as doubles that hold them."""
    for b in batches:
        ids, lists = b.column(0).cast(pa.int64()).to_pylist(), b.column(1)
        dims, out_ids, packed = [], [], []
        for i, doc in enumerate(ids):
            v = lists[i]
            if doc is None or not v.is_valid or v.values.null_count:
                continue
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.floor(factor * v.values.to_numpy(zero_copy_only=False).astype(np.float64))
            if not np.isfinite(x).all():
                continue
            most = np.abs(x).max(initial=0.0)
            kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8"
            dims.append(len(x))
            out_ids.append(doc)
            packed.append(x.astype(kind).tobytes())
        yield pa.RecordBatch.from_pydict({"dim": pa.array(dims, pa.int32()), "vec_id": pa.array(out_ids, pa.int64()),
                                          "vec": pa.array(packed, pa.binary())})


def unpack(packed: bytes, dim: int) -> np.ndarray:
    kind = {2: "<i2", 4: "<i4", 8: "<f8"}[len(packed) // dim] if dim else "<f8"
    return np.frombuffer(packed, kind).astype(np.float64)


def exact_products(rows: np.ndarray, query: np.ndarray, reach: float) -> list[int] | np.ndarray:
    """Inner products of whole numbers held as doubles; ``reach`` bounds their size and that of every partial sum."""
    if reach < 2.0 ** 52:
        return (rows @ query).astype(np.int64)
    most = max(float(np.abs(query).max(initial=0.0)), float(np.abs(rows).max(initial=0.0)))
    if reach < 2.0 ** 61 and most < 2.0 ** 62:
        return rows.astype(np.int64) @ query.astype(np.int64)
    whole = [int(v) for v in query]
    return np.array([sum(int(a) * b for a, b in zip(r, whole)) for r in rows], object)


class Shard:
    """Rows of one shard and their pivot table; vectors are whole numbers held as doubles."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, pivots: int):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], vectors[order]
        with np.errstate(over="ignore", invalid="ignore"):
            self.norm = (self.x * self.x).sum(axis=1)  # rounded: they bound, they do not score
            self.longest = float(np.sqrt(self.norm.max(initial=0.0))) * (1 + 1e-9)
            self.far = self._choose(self.x, pivots)
            self.table = self._distances(self.x, self.norm)

    def _choose(self, x: np.ndarray, pivots: int) -> np.ndarray:
        """Farthest-first among at most 2,048 rows evenly spread over the shard."""
        pool = x[np.unique(np.linspace(0, len(x) - 1, min(len(x), 2048)).astype(np.int64))]
        chosen = [0]
        gap = ((pool - pool[0]) ** 2).sum(axis=1)
        while len(chosen) < pivots and gap.max() > 0:
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, ((pool - pool[chosen[-1]]) ** 2).sum(axis=1))
        return pool[chosen]

    def _distances(self, x: np.ndarray, norm: np.ndarray) -> np.ndarray:
        own = (self.far ** 2).sum(axis=1)
        return np.sqrt(np.maximum(norm[:, None] + own[None, :] - 2 * (x @ self.far.T), 0.0))

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int, block: int = 256) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query id, ids, scores) of each query's k best rows here, best first."""
        with np.errstate(over="ignore", invalid="ignore"):
            norms = (queries * queries).sum(axis=1)
            to_pivots = self._distances(queries, norms)
        for query_id, q, norm, near in zip(ids.tolist(), queries, norms.tolist(), to_pivots):
            with np.errstate(over="ignore", invalid="ignore"):
                low = np.abs(self.table - near).max(axis=1)
                size = norm + self.norm
                # distances are rounded: their squares are off by far less than this part of the norms
                bound = (size - low * low) / 2 + 1e-6 * size + 1e-3
            bound[np.isnan(bound)] = np.inf  # beyond doubles nothing is known: evaluate
            bound[self.ids == query_id] = -np.inf
            reach = float(np.sqrt(norm)) * (1 + 1e-9) * self.longest  # no partial sum is larger
            best_ids, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
            left = np.flatnonzero(bound > -np.inf)
            while len(left):
                if len(left) > block:  # the rows with the highest bounds left
                    part = np.argpartition(-bound[left], block)
                    now, left = left[part[:block]], left[part[block:]]
                else:
                    now, left = left, left[:0]
                scores = exact_products(self.x[now], q, reach)
                if scores.dtype == object:
                    fits = np.array([-(1 << 63) <= v < 1 << 63 for v in scores], bool)
                    now, scores = now[fits], np.array([int(v) for v in scores[fits]], np.int64)
                best_ids, best = np.r_[best_ids, self.ids[now]], np.r_[best, scores]
                # -1 - score orders like -score, and has no overflow
                top = np.lexsort((best_ids, -1 - best))[:k]
                best_ids, best = best_ids[top], best[top]
                if len(best) == k:
                    left = left[bound[left] >= best[-1]]
            yield query_id, best_ids, best


def _search_shards(k: int, pivots: int, query_block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, shard = None, None
        ids: list[int] = []
        vectors: list[np.ndarray] = []
        asking = False

        def answers() -> Iterator[pa.RecordBatch]:
            found = list(shard.search(np.array(ids, np.int64), np.stack(vectors), k)) if shard and ids else []
            if found:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]), pa.int64()),
                    pa.array(np.concatenate([f[1] for f in found]), pa.int64()),
                    pa.array(np.concatenate([f[2] for f in found]), pa.int64())], schema=FOUND)

        for b in batches:
            for dim, part, asks, vec_id, packed in zip(*(b.column(i).to_pylist() for i in range(5))):
                if (dim, part) != key:
                    if asking:
                        yield from answers()
                    key, shard, ids, vectors, asking = (dim, part), None, [], [], False
                if asks and not asking:
                    shard = Shard(np.array(ids, np.int64), np.stack(vectors), pivots) if ids else None
                    ids, vectors, asking = [], [], True
                ids.append(vec_id)
                vectors.append(unpack(packed, dim))
                if asking and len(ids) == query_block:
                    yield from answers()
                    ids, vectors = [], []
        if asking:
            yield from answers()

    return run


def pivot_topk(vectors: DataFrame, is_query: Column, k: int = 10, pivots: int = 32, shard_rows: int = 16_384,
               query_block: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of highest integer inner product with each query row.

    ``is_query`` is a condition on the id column; ties go to the smaller id.
    """
    slim = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    index = materialize(slim.mapInArrow(quantized, INDEX), "pivot-index")
    shards = materialize(index.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("shards")),
                         "pivot-shards")
    placed = index.join(shards, "dim")
    data = placed.select("dim", F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int").alias("shard"),
                         F.lit(0).alias("asks"), "vec_id", "vec")
    queries = (placed.withColumnRenamed("vec_id", id_col).where(is_query).withColumnRenamed(id_col, "vec_id")
               .groupBy("vec_id").agg(F.min(F.struct("vec", "dim", "shards")).alias("q"))
               .select("q.dim", F.explode(F.sequence(F.lit(0), F.col("q.shards") - 1)).alias("shard"), F.lit(1).alias("asks"),
                       "vec_id", "q.vec"))
    found = (data.unionByName(queries).repartition("dim", "shard").sortWithinPartitions("dim", "shard", "asks")
             .mapInArrow(_search_shards(k, pivots, query_block), "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
