"""Approximate nearest neighbours of a table of questions: a proximity graph and a beam search over it.

The graph links every distinct vector to near ones.  It starts from ``orders`` random directions: along each, the
vectors are range-partitioned and sorted, and the rows of a block of ``block`` neighbours find their nearest within it.
Then rounds of refinement follow: the neighbours of a vector, out and in, meet in a join, and each pair that is closer
than what either has becomes a candidate (a neighbour's neighbour is likely a neighbour).  Pairs seen in an earlier
round are not measured again, and a candidate leaves its task only if it beats its vector's current k-th distance.

The search keeps a beam of the ``beam`` nearest nodes per question.  A round joins the nearest unexpanded ones with
the graph, drops what the question has met, and measures the rest; it ends when every beam is expanded.  All
questions move together, so the number of jobs follows the path length, not the number of questions.

Equal vectors are one node, so a vector that a third of all rows share fills no neighbourhood; a node answers
with its ``copies`` smallest ids.  Rows whose vector is NULL or has a NULL or non-finite element are not indexed (the exact
operators sort them last).  Recall is a matter of the parameters: measure it against ``vector_topk_batch``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import forget, materialize

EDGE = "u long, v long, distance double, fresh boolean"
EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("distance", pa.float64()), ("fresh", pa.bool_())])


@dataclass
class GraphIndex:
    """nodes(node, vector), members(node, embedding_id, article_id), links(node, neighbours)."""

    nodes: DataFrame
    members: DataFrame
    links: DataFrame


def _rows(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _indexable(embedding: Column, dim: int) -> Column:
    return (F.size(embedding) == dim) & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _first_per(rows: DataFrame, key: str, n: int, *order) -> DataFrame:
    """The first ``n`` rows of every key; tasks cut hot keys to ``n`` before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def _nearest_in_block(k: int, block: int):
    """(node, vector) in the order of a direction -> each row's k nearest among its block."""

    def edges(nodes: list, vectors: list) -> pa.RecordBatch:
        ids, x = np.array(nodes, np.int64), np.stack(vectors)
        gap = _gaps(x)
        np.fill_diagonal(gap, np.inf)
        near = np.argsort(gap, axis=1, kind="stable")[:, :k]
        near = near[:, :max(0, len(ids) - 1)]
        u = np.repeat(np.arange(len(ids)), near.shape[1])
        v = near.ravel()
        return pa.RecordBatch.from_arrays([pa.array(ids[u]), pa.array(ids[v]), pa.array(_exact(x, u, x, v)),
                                           pa.array(np.ones(len(u), bool))], schema=EDGES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, vectors = [], []
        for b in batches:
            if not b.num_rows:
                continue
            for node, vector in zip(b.column(0).to_pylist(), _rows(b.column(1))):
                nodes.append(node)
                vectors.append(vector)
                if len(nodes) == block:
                    yield edges(nodes, vectors)
                    # half of a block meets the next one too
                    nodes, vectors = nodes[block // 2:], vectors[block // 2:]
        if len(nodes) > 1:
            yield edges(nodes, vectors)

    return run


def _gaps(x: np.ndarray) -> np.ndarray:
    """Squared distances between all rows of a small matrix (they choose; ``_exact`` measures)."""
    norm = (x * x).sum(axis=1)
    return np.maximum(norm[:, None] + norm[None, :] - 2 * (x @ x.T), 0.0)


def _exact(x: np.ndarray, i: np.ndarray, y: np.ndarray, j: np.ndarray) -> np.ndarray:
    return np.sqrt(((x[i] - y[j]) ** 2).sum(axis=1))


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, member, fresh, vector, worst) sorted by u: pairs of a node's neighbours that improve on what one side has."""

    def pairs(t: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        u, member, fresh = (t.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        x, worst = _rows(t.column(3)), t.column(4).to_numpy()
        cuts = np.r_[0, np.flatnonzero(np.diff(u)) + 1, len(u)]
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, z in zip(cuts[:-1], cuts[1:]):  # a node's neighbours: ``degree`` rows at most
            useful = (fresh[a:z, None] | fresh[None, a:z]) & (_gaps(x[a:z]) <= worst[a:z, None] ** 2 * (1 + 1e-9))
            np.fill_diagonal(useful, False)
            i, j = np.nonzero(useful)
            left.append(i + a)
            right.append(j + a)
        i, j = np.concatenate(left), np.concatenate(right)
        for at in range(0, len(i), 1 << 16):
            p, q = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(member[p]), pa.array(member[q]), pa.array(_exact(x, p, x, q)),
                                              pa.array(np.ones(len(p), bool))], schema=EDGES)

    held = None
    for b in batches:
        t = b if held is None else pa.concat_batches([held, b])
        if not t.num_rows:
            continue
        u = t.column(0).to_numpy()
        last = int(np.flatnonzero(u != u[-1])[-1]) + 1 if u[0] != u[-1] else 0  # the last node may go on
        if last:
            yield from pairs(t.slice(0, last))
        held = t.slice(last)
    if held is not None:
        yield from pairs(held)


def _both_ways(edges: DataFrame, degree: int) -> DataFrame:
    """Out and in edges of every node, its ``degree`` nearest."""
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"), "distance", "fresh")
    one = edges.unionByName(back).groupBy("u", "v").agg(F.min("distance").alias("distance"), F.max("fresh").alias("fresh"))
    return _first_per(one, "u", degree, "distance", "v")


def build_graph(embeddings: DataFrame, k: int = 12, degree: int = 24, orders: int = 4, block: int = 512, rounds: int = 8,
                settled: float = 0.001, copies: int = 64, seed: int = 7) -> GraphIndex:
    """The graph over embeddings(embedding_id, article_id, embedding).

    ``k`` nearest neighbours a node are sought; with the edges that come in a node has up to ``degree`` links.  Rounds
    end when fewer than ``settled`` of the edges changed, or after ``rounds`` of them.
    """
    shape = embeddings.select(F.size("embedding").alias("dim")).where("dim > 0").agg(F.max("dim")).first()
    dim = shape[0] or 0
    rows = embeddings.where(_indexable(F.col("embedding"), dim)).select("embedding_id", "article_id", "embedding")
    same = Window.partitionBy("embedding").orderBy("embedding_id")
    kept = (rows.withColumn("_no", F.row_number().over(same)).where(F.col("_no") <= copies)
            .withColumn("node", F.first("embedding_id").over(same)))
    kept = materialize(kept, "graph-rows")
    members = kept.select("node", "embedding_id", "article_id")
    nodes = kept.where("_no = 1").select("node", F.col("embedding").alias("vector"))

    rng = np.random.default_rng(seed)
    edges = None
    for _ in range(orders):
        direction = rng.normal(size=dim)

        def along(batches: Iterator[pa.RecordBatch], direction=direction) -> Iterator[pa.RecordBatch]:
            for b in batches:
                at = _rows(b.column(1)) @ direction if b.num_rows else np.zeros(0)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at)], ["node", "vector", "at"])

        placed = nodes.mapInArrow(along, f"node long, vector {nodes.schema['vector'].dataType.simpleString()}, at double")
        found = (placed.repartitionByRange("at", "node").sortWithinPartitions("at", "node").select("node", "vector")
                 .mapInArrow(_nearest_in_block(k, block), EDGE))
        edges = found if edges is None else edges.unionByName(found)
    one = edges.groupBy("u", "v").agg(F.min("distance").alias("distance"), F.max("fresh").alias("fresh"))
    edges = materialize(_first_per(one, "u", k, "distance", "v"), "graph-edges")

    for _ in range(rounds):
        around = _both_ways(edges, degree)
        # a node with fewer than k edges takes any candidate
        worst = edges.groupBy(F.col("u").alias("node")).agg(
            F.when(F.count(F.lit(1)) >= k, F.max("distance")).otherwise(F.lit(float("inf"))).alias("worst"))
        known = nodes.join(worst, "node", "left").select(F.col("node").alias("member"), "vector",
                                                         F.coalesce("worst", F.lit(float("inf"))).alias("worst"))
        met = (around.select("u", F.col("v").alias("member"), "fresh").join(known, "member").repartition("u")
               .sortWithinPartitions("u").select("u", "member", "fresh", "vector", "worst").mapInArrow(_meet, EDGE))
        old = edges.withColumn("fresh", F.lit(False))
        merged = (old.unionByName(met).groupBy("u", "v")
                  .agg(F.min("distance").alias("distance"), F.min("fresh").alias("fresh")))
        after = materialize(_first_per(merged, "u", k, "distance", "v"), "graph-edges")
        forget(edges)
        edges = after
        changed, total = edges.agg(F.count_if("fresh"), F.count(F.lit(1))).first()
        if changed <= settled * total:
            break
    links = (_both_ways(edges, degree).groupBy("u")
             .agg(F.sort_array(F.collect_list(F.struct("distance", "v"))).alias("near"))
             .select(F.col("u").alias("node"), F.col("near.v").alias("neighbours")))
    return GraphIndex(nodes, members, materialize(links, "graph-links"))


def write_graph(index: GraphIndex, path: str) -> None:
    """Persist an index; node tables are clustered by node, so a lookup skips row groups."""
    for name in ("nodes", "members", "links"):
        table = getattr(index, name)
        table.repartitionByRange("node").sortWithinPartitions("node").write.mode("overwrite").parquet(f"{path}/{name}")


def load_graph(spark: SparkSession, path: str) -> GraphIndex:
    return GraphIndex(*(spark.read.parquet(f"{path}/{name}") for name in ("nodes", "members", "links")))


def _measured(pairs: DataFrame) -> DataFrame:
    """(no, node, vector, qvec) -> (no, node, distance)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = _rows(b.column(2)), _rows(b.column(3))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.sqrt(((x - y) ** 2).sum(axis=1)))],
                                                 ["no", "node", "distance"])

    return pairs.select("no", "node", "vector", "qvec").mapInArrow(run, "no long, node long, distance double")


def search_graph(index: GraphIndex, questions: DataFrame, k: int = 10, beam: int = 16, expand: int = 4,
                 entries: int = 32, seed: int = 7) -> DataFrame:
    """qid, embedding_id, article_id, distance, rank and ``compared`` (vectors measured for the question).

    questions(qid, qvec).  All start at the same ``entries`` nodes (those whose ids hash lowest: a fixed number of vectors, which
    every task holds); a round expands the ``expand`` nearest open nodes of each beam.
    Questions without a vector of the index's width get no rows; those that share a qid are answered each.
    """
    spark = index.nodes.sparkSession
    first = index.nodes.orderBy(F.xxhash64("node", F.lit(seed)), "node").limit(entries).collect()  # ``entries`` rows
    schema = "qid long, embedding_id long, article_id long, distance double, rank int, compared long"
    if not first:
        return spark.createDataFrame([], schema)
    names, x = np.array([r["node"] for r in first], np.int64), np.array([r["vector"] for r in first], np.float64)
    asked = materialize(questions.select(F.col("qid").cast("long").alias("qid"), "qvec").where(_indexable(F.col("qvec"), x.shape[1]))
                        .withColumn("no", F.monotonically_increasing_id()), "graph-questions")

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q = _rows(b.column(1)) if b.num_rows else np.zeros((0, x.shape[1]))
            i, j = np.repeat(np.arange(len(q)), len(x)), np.tile(np.arange(len(x)), len(q))
            yield pa.RecordBatch.from_arrays([pa.array(b.column(0).to_numpy()[i]), pa.array(names[j]), pa.array(_exact(q, i, x, j))],
                                             ["no", "node", "distance"])

    start = asked.select("no", "qvec").mapInArrow(enter, "no long, node long, distance double")
    state = materialize(start.withColumn("open", F.lit(True)), "graph-beam")
    nearest = Window.partitionBy("no").orderBy("distance", "node")
    while True:
        held = state.withColumn("_rank", F.row_number().over(nearest)).where(F.col("_rank") <= beam).where("open")
        edge = materialize(_first_per(held.drop("_rank"), "no", expand, "distance", "node").select("no", "node"), "graph-frontier")
        if not edge.head(1):
            forget(edge)
            break
        reached = (edge.join(index.links, "node").select("no", F.explode("neighbours").alias("node")).distinct()
                   .join(state.select("no", "node"), ["no", "node"], "left_anti"))
        met = _measured(reached.join(index.nodes, "node").join(asked.select("no", "qvec"), "no"))
        done = edge.withColumn("_done", F.lit(True))
        after = (state.join(done, ["no", "node"], "left")
                 .select("no", "node", "distance", (F.col("open") & F.col("_done").isNull()).alias("open"))
                 .unionByName(met.withColumn("open", F.lit(True))))
        after = materialize(after, "graph-beam")
        forget(state, edge)
        state = after
    compared = state.groupBy("no").agg(F.count(F.lit(1)).alias("compared"))
    best = _first_per(state, "no", k, "distance", "node").join(index.members, "node")
    order = Window.partitionBy("no").orderBy("distance", "embedding_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return (ranked.join(compared, "no").join(asked.select("no", "qid"), "no")
            .select("qid", "embedding_id", "article_id", "distance", "rank", "compared"))


def vector_topk_graph(embeddings: DataFrame, questions: DataFrame, k: int = 10, index: GraphIndex | None = None,
                      **search) -> DataFrame:
    """Approximate k nearest embeddings of every question, over ``index`` or a graph built here."""
    return search_graph(index or build_graph(embeddings), questions, k, **search)
