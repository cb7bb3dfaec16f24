"""Retrieval over chunk embeddings: exact / approximate top-k, rerank, references, prompt.

embeddings(embedding_id, article_id, chunk, embedding array<float>), articles(article_id, title, ...).
Distances are Euclidean (L2), nearest first; ties broken by embedding_id.
"""

from __future__ import annotations

from itertools import chain, groupby
from typing import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.scalar import l2_distance
from quarry.session import materialize

# Candidates, references kept and the prompt template.
TOP_K = 10
REFERENCES_KEPT = 3
REFERENCE_FORMAT = "Reference {n} from {title}\n\n{chunk}\n\n"
PROMPT_TEMPLATE = """<|im_start|>system
You are a PostgreSQL database platform expert tasked with answering difficult user questions. You should defer to the following references in all respects, but are otherwise welcome to fill in gaps with your existing knowledge: 

{refs}

Produce thorough and insightful answers whenever possible, and do not answer any questions unrelated to Postgres.
<|im_end|>

<|im_start|>user
{q}
<|im_end|>

<|im_start|>assistant
"""

# Questions that a task of the batched top-k holds at once, the byte bound that shrinks that for wide
# vectors, and the rows of a shard of embeddings, which are streamed.
QUESTION_BLOCK = 4096
QUESTION_BLOCK_BYTES = 64 << 20
SHARD_ROWS = 1 << 20


def vector_topk(embeddings: DataFrame, query: Sequence[float], k: int = TOP_K) -> DataFrame:
    """The k nearest embeddings to one query vector: (embedding_id, article_id, distance).

    An ordered limit over the distance expression: every task keeps k rows, and only those
    reach the merge.  Only ids and the vector are read, and nothing leaves the JVM; a missing
    vector has a NULL distance, sorted last.
    """
    d = embeddings.select("embedding_id", "article_id", l2_distance(F.col("embedding"), query).alias("distance"))
    return d.orderBy(F.col("distance").asc_nulls_last(), "embedding_id").limit(k)


def article_score(matches: DataFrame) -> DataFrame:
    """Add ``score``: number of matches of the same article (window count)."""
    return matches.withColumn("score", F.count(F.lit(1)).over(Window.partitionBy("article_id")))


def rerank_top3(matches: DataFrame, keep: int = REFERENCES_KEPT) -> DataFrame:
    """Keep the matches of the best-covered articles: score desc, distance, id."""
    s = article_score(matches)
    return s.orderBy(F.col("score").desc(), F.col("distance").asc_nulls_last(), "embedding_id").limit(keep)


def fetch_context(winners: DataFrame, embeddings: DataFrame, articles: DataFrame) -> DataFrame:
    """(title, chunk) of the winning matches, plus their rank (1 = best) for numbering.

    Late materialisation: top-k ran on ids and vectors only; the chunk text and the
    title are joined back for the few winners (broadcast into both tables: ``winners``
    holds at most ``keep`` rows, and each meets one chunk), so neither table is shuffled.
    """
    w = winners.select("embedding_id", "article_id", "score", "distance")
    ranked = w.withColumn("ref_no", F.row_number().over(
        Window.orderBy(F.col("score").desc(), F.col("distance").asc_nulls_last(), "embedding_id")))
    e = embeddings.select("embedding_id", "article_id", "chunk")
    a = articles.select("article_id", "title")
    won = e.join(F.broadcast(ranked), ["embedding_id", "article_id"])
    return a.join(F.broadcast(won), "article_id").select("ref_no", "title", "chunk")


def build_references(context: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Concatenate numbered references, in ``ref_no`` order, per question (or overall)."""
    text = F.format_string(REFERENCE_FORMAT.replace("{n}", "%d").replace("{title}", "%s").replace("{chunk}", "%s"),
                           F.col("ref_no"), F.col("title"), F.col("chunk"))
    return (context.select(*group_cols, "ref_no", text.alias("_ref"))
            .groupBy(*group_cols)
            .agg(F.expr("listagg(_ref, '') WITHIN GROUP (ORDER BY ref_no)").alias("refs")))


def build_prompt(refs: DataFrame, question) -> DataFrame:
    """Fill the chat template with the references and the question text (a column or a literal)."""
    q = F.lit(question) if isinstance(question, str) else question
    head, rest = PROMPT_TEMPLATE.split("{refs}")
    mid, tail = rest.split("{q}")
    return refs.select("*", F.concat(F.lit(head), F.col("refs"), F.lit(mid), q, F.lit(tail)).alias("prompt"))


def retrieve(embeddings: DataFrame, articles: DataFrame, query: Sequence[float], question: str,
             k: int = TOP_K, keep: int = REFERENCES_KEPT) -> DataFrame:
    """Question vector -> references and prompt (one row)."""
    winners = rerank_top3(vector_topk(embeddings, query, k), keep)
    ctx = fetch_context(winners, embeddings, articles)
    return build_prompt(build_references(ctx), question)


def retrieve_batch(embeddings: DataFrame, articles: DataFrame, questions: DataFrame, k: int = TOP_K,
                   keep: int = REFERENCES_KEPT) -> DataFrame:
    """The whole question pipeline for a table of questions(qid, qvec, question): (qid, refs, prompt).

    Exact top-k per question (``vector_topk_batch``), matches per (question, article) as
    the score, the ``keep`` best per question by score desc, distance, id, numbered in that
    order; chunk text and titles are joined back for those rows only.  Every window is
    partitioned by question and holds exactly k rows, so no group grows with the data.
    """
    top = vector_topk_batch(embeddings, questions.select("qid", "qvec"), k)
    scored = top.withColumn("score", F.count(F.lit(1)).over(Window.partitionBy("qid", "article_id")))
    order = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("distance").asc_nulls_last(), "embedding_id")
    winners = scored.withColumn("ref_no", F.row_number().over(order)).filter(F.col("ref_no") <= keep)
    # written, so that the size of the winners is known when the chunks are joined: broadcast below Spark's threshold;
    # above it the chunk rows that no question needs go before their text is shuffled
    winners = materialize(winners.select("qid", "embedding_id", "article_id", "ref_no"), "winners")
    chunks = embeddings.select("embedding_id", "article_id", "chunk").join(
        winners.select("embedding_id", "article_id").distinct(), ["embedding_id", "article_id"], "left_semi")
    ctx = (winners.join(chunks, ["embedding_id", "article_id"])
           .join(articles.select("article_id", "title"), "article_id"))
    refs = build_references(ctx.select("qid", "ref_no", "title", "chunk"), group_cols=["qid"])
    return build_prompt(refs.join(questions.select("qid", "question"), "qid"), F.col("question")).select(
        "qid", "refs", "prompt")


def chat_field(df: DataFrame, col: str, field: str = "chat_response", alias: str | None = None) -> DataFrame:
    """Pull one field out of a JSON text column (as unquoted text)."""
    return df.select("*", F.get_json_object(F.col(col), f"$.{field}").alias(alias or field))


# ---- batched exact top-k ----------------------------------------------------------------

# Largest array formed at once inside a task: question x vector cells of the squared-distance
# slice, and pair x width cells when exact distances are computed.
_MAX_CELLS = 1 << 22
_MAX_TENSOR = 1 << 24


def _matrix(vectors, dim: int):
    """Stack vectors into a float64 matrix; a missing vector, one of another width or with a
    missing element becomes a row of NaN, whose distance is NULL (sorted last), as in SQL."""
    try:
        m = np.stack(vectors).astype(np.float64)
        if m.ndim == 2 and m.shape[1] == dim:
            return m
    except (ValueError, TypeError):
        pass
    m = np.full((len(vectors), dim), np.nan)
    for i, v in enumerate(vectors):
        if v is not None and len(v) == dim:
            m[i] = np.asarray(v, dtype=np.float64)
    return m


def _first_k_per_group(q, d, ids, arts, k: int):
    """Rows sorted by (question, distance, id); keep the first k of every question."""
    order = np.lexsort((ids, d, q))
    q, d, ids, arts = q[order], d[order], ids[order], arts[order]
    starts = np.r_[0, np.flatnonzero(np.diff(q)) + 1]
    rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))
    keep = rank < k
    return q[keep], d[keep], ids[keep], arts[keep]


def _partial_topk(bq, k: int):
    """mapInPandas body: this task's k best embeddings for every question of the block.

    Exact, in two steps per slice of vectors: squared distances from one matrix product
    (``|q|^2 + |e|^2 - 2 q.e``, no question x vector x width tensor) keep only the pairs
    within each question's current k-th distance plus a margin far above that formula's
    rounding error; for those, distances are computed directly and merged by (distance,
    id).  Missing vectors (NULL distance) are kept apart, at most k of them by id.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        qids, qmat = bq.value
        nq = len(qids)
        if nq == 0:
            return
        dim = qmat.shape[1]
        qn = (qmat ** 2).sum(axis=1)
        q_missing = np.isnan(qn)                        # a question with a missing element: all distances NULL
        any_ids, any_arts = np.empty(0, np.int64), np.empty(0, object)
        thr = np.full(nq, np.inf)                       # squared k-th exact distance per question
        best = (np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64), np.empty(0, object))
        null_ids, null_arts = np.empty(0, np.int64), np.empty(0, object)
        step = max(1, _MAX_CELLS // nq)
        exact_step = max(1, _MAX_TENSOR // max(1, dim))
        for b in batches:
            if b.empty:
                continue
            emat = _matrix(b["embedding"].to_numpy(), dim)
            ids = b["embedding_id"].to_numpy(dtype=np.int64)
            arts = b["article_id"].to_numpy(dtype=object)
            if q_missing.any():
                any_ids, any_arts = np.concatenate([any_ids, ids]), np.concatenate([any_arts, arts])
                first = np.argsort(any_ids, kind="stable")[:k]
                any_ids, any_arts = any_ids[first], any_arts[first]
            missing = np.isnan(emat).any(axis=1)
            if missing.any():
                null_ids = np.concatenate([null_ids, ids[missing]])
                null_arts = np.concatenate([null_arts, arts[missing]])
                first = np.argsort(null_ids, kind="stable")[:k]
                null_ids, null_arts = null_ids[first], null_arts[first]
                emat, ids, arts = emat[~missing], ids[~missing], arts[~missing]
            en = (emat ** 2).sum(axis=1)
            for s0 in range(0, len(ids), step):
                e, e_n = emat[s0:s0 + step], en[s0:s0 + step]
                approx = qn[:, None] + e_n[None, :] - 2.0 * (qmat @ e.T)
                # rounding margin per question, valid for every vector of the slice
                margin = 1e-9 * (qn + e_n.max()) + 1e-300
                t = thr
                if e.shape[0] >= k:
                    # the k smallest approximations bound the exact k-th distance from above
                    t = np.minimum(thr, np.partition(approx, k - 1, axis=1)[:, k - 1] + margin)
                qi, ej = np.nonzero(approx <= (t + margin)[:, None])
                if len(qi) == 0:
                    continue
                d = np.empty(len(qi))
                for t0 in range(0, len(qi), exact_step):
                    a, c = qi[t0:t0 + exact_step], ej[t0:t0 + exact_step]
                    d[t0:t0 + exact_step] = np.sqrt(((qmat[a] - e[c]) ** 2).sum(axis=1))
                best = _first_k_per_group(np.concatenate([best[0], qi]), np.concatenate([best[1], d]),
                                          np.concatenate([best[2], ids[s0:s0 + step][ej]]),
                                          np.concatenate([best[3], arts[s0:s0 + step][ej]]), k)
                counts = np.bincount(best[0], minlength=nq)
                last = np.r_[np.flatnonzero(np.diff(best[0])), len(best[0]) - 1]
                full = counts[best[0][last]] >= k
                thr = np.full(nq, np.inf)
                thr[best[0][last][full]] = best[1][last][full] ** 2
        q, d, ids, arts = best
        if len(null_ids):
            good_q = np.flatnonzero(~q_missing)         # the others get their k smallest ids below
            nn = len(null_ids)
            q = np.concatenate([q, np.repeat(good_q, nn)])
            d = np.concatenate([d, np.full(len(good_q) * nn, np.nan)])
            ids = np.concatenate([ids, np.tile(null_ids, len(good_q))])
            arts = np.concatenate([arts, np.tile(null_arts, len(good_q))])
        if q_missing.any() and len(any_ids):
            bad_q = np.flatnonzero(q_missing)
            q = np.concatenate([q, np.repeat(bad_q, len(any_ids))])
            d = np.concatenate([d, np.full(len(bad_q) * len(any_ids), np.nan)])
            ids = np.concatenate([ids, np.tile(any_ids, len(bad_q))])
            arts = np.concatenate([arts, np.tile(any_arts, len(bad_q))])
        if len(q):
            yield pd.DataFrame({"qid": qids[q], "embedding_id": ids, "article_id": pd.array(list(arts), dtype="Int64"),
                                "distance": d})

    return run


class _Block:
    """The questions of a task's block, as the kernel reads them."""

    def __init__(self, rows: list, dim: int):
        self.value = (np.arange(len(rows)), _matrix([r["vector"] for r in rows], dim))


def _runs(batches: Iterator[pd.DataFrame]):
    """Sorted rows of (shard, block, asks) -> ((shard, block), asks, rows), in pieces."""
    for b in batches:
        if b.empty:
            continue
        keys = b[["_shard", "_block", "_asks"]].to_numpy()
        cuts = np.r_[0, np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, len(b)]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            yield (int(keys[lo, 0]), int(keys[lo, 1])), bool(keys[lo, 2]), b.iloc[lo:hi]


def _topk_pairs(k: int, dim: int):
    """One (shard, block) after another: hold the block's questions, stream the shard's vectors past them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, pieces in groupby(_runs(batches), key=lambda r: r[0]):
            asked: list = []
            first = None
            for _, asks, rows in pieces:
                if not asks:
                    first = rows
                    break
                asked += rows[["id", "_h", "_n", "vector"]].to_dict("records")
            if not asked or first is None:
                continue
            stream = chain([first], (rows for _, _, rows in pieces))
            named = (r.rename(columns={"id": "embedding_id", "vector": "embedding"}) for r in stream)
            for best in _partial_topk(_Block(asked, dim), k)(named):
                of = best["qid"].to_numpy()
                yield best.assign(qid=[asked[i]["id"] for i in of], _h=[asked[i]["_h"] for i in of], _n=[asked[i]["_n"] for i in of])[
                    ["qid", "_h", "_n", "embedding_id", "article_id", "distance"]]

    return run


def vector_topk_batch(embeddings: DataFrame, questions: DataFrame, k: int = TOP_K, block: int = QUESTION_BLOCK,
                      shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Exact k nearest embeddings for every question: (qid, embedding_id, article_id, distance, rank).

    questions(qid, qvec).  Embeddings are dealt into shards of about ``shard_rows`` and questions into blocks of up to
    ``block`` (fewer where the widest vector would pass ``QUESTION_BLOCK_BYTES``), both by hash; one job brings every
    block to every shard.  A task holds a block's questions and streams the shard's vectors past them with numpy, keeping k per
    question; a ``row_number`` per question merges the shards' lists.  Nothing passes
    through the driver, and no question x embedding pair table is formed.  What is shuffled are the vectors times the number of
    blocks and the questions times the number of shards, so larger blocks and shards cost memory and save shuffle.

    Questions that share a qid each get their own k rows.  A NULL question
    vector, or one of another width than the widest, has NULL distances: its k smallest ids.
    """
    sc = embeddings.sparkSession.sparkContext
    # equal questions are asked once and answered as often as they came
    asked = questions.select(F.col("qid").cast("bigint").alias("id"), F.col("qvec").alias("vector")).groupBy("id", "vector").agg(
        F.count(F.lit(1)).alias("_n"))
    n, dim = questions.agg(F.count(F.lit(1)), F.max(F.size("qvec"))).first()
    dim = max(dim or 0, 1)
    block = max(1, min(block, QUESTION_BLOCK_BYTES // (8 * dim)))
    shards = max(1, -(-embeddings.count() // shard_rows))
    blocks = min(max(-(-n // block), -(-2 * sc.defaultParallelism // shards), 1), max(n, 1))
    wide = F.col("vector").cast("array<double>")
    e = embeddings.select(F.col("embedding_id").cast("bigint").alias("id"), F.col("article_id").cast("bigint").alias("article_id"),
                          F.col("embedding").alias("vector"))
    e = e.withColumn("_shard", F.pmod(F.xxhash64("id", "vector"), F.lit(shards)).cast("int")).select(
        "_shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"), F.lit(False).alias("_asks"), "id", "article_id",
        wide.alias("vector"), F.lit(0).cast("bigint").alias("_h"), F.lit(0).cast("bigint").alias("_n"))
    q = asked.withColumn("_h", F.xxhash64("id", "vector")).select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("_shard"), F.pmod("_h", F.lit(blocks)).cast("int").alias("_block"),
        F.lit(True).alias("_asks"), "id", F.lit(None).cast("bigint").alias("article_id"), wide.alias("vector"), "_h", "_n")
    dealt = (q.unionByName(e).repartition("_shard", "_block")
             .sortWithinPartitions("_shard", "_block", F.col("_asks").desc()))
    found = dealt.mapInPandas(_topk_pairs(k, dim), "qid long, _h long, _n long, embedding_id long, article_id long, distance double")
    w = Window.partitionBy("qid", "_h").orderBy(F.col("distance").asc_nulls_last(), "embedding_id")
    best = found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return best.select("qid", "embedding_id", "article_id", "distance", "rank", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))).alias("_i")).drop("_i")


# ---- approximate top-k (LSH) -----------------------------------------------------------------

def index_vectors(embeddings: DataFrame, bucket_length: float = 2.0, num_tables: int = 4, seed: int = 7):
    """Fit a random-projection LSH model on the vectors (Euclidean buckets)."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    v = embeddings.withColumn("features", array_to_vector(F.col("embedding")))
    model = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=bucket_length,
                                        numHashTables=num_tables, seed=seed).fit(v)
    return model, v


def lsh_buckets(model, vectors: DataFrame, id_col: str = "embedding_id") -> DataFrame:
    """The index as a table: (id, table, bucket), one row per vector and hash table."""
    from pyspark.ml.functions import vector_to_array

    h = model.transform(vectors).select(id_col, F.posexplode("hashes").alias("table", "_h"))
    return h.select(id_col, "table", vector_to_array("_h")[0].cast("bigint").alias("bucket"))


def write_index(model, vectors: DataFrame, path: str, id_col: str = "embedding_id",
                num_partitions: int | None = None) -> None:
    """Persist the LSH index: the model under ``path/model`` and the (table, bucket, id) rows
    under ``path/buckets``, range-clustered by (table, bucket) so that a probe's filter on a
    few buckets skips all other row groups (parquet min/max statistics)."""
    n = num_partitions or int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    model.write().overwrite().save(f"{path}/model")
    (lsh_buckets(model, vectors, id_col).repartitionByRange(n, "table", "bucket")
     .sortWithinPartitions("table", "bucket").write.mode("overwrite").parquet(f"{path}/buckets"))


def load_index(spark, path: str):
    """(model, bucket table) written by ``write_index``."""
    from pyspark.ml.feature import BucketedRandomProjectionLSHModel

    return BucketedRandomProjectionLSHModel.load(f"{path}/model"), spark.read.parquet(f"{path}/buckets")


def vector_topk_lsh(embeddings: DataFrame, query: Sequence[float], k: int = TOP_K, index=None,
                    **index_args) -> DataFrame:
    """Approximate k nearest neighbours of one vector (single-probe LSH): exact L2 distance,
    but only over vectors sharing a bucket with the query in at least one hash table.

    Written as joins on the bucket table: the query's (table, bucket) pairs (one per hash
    table, broadcast) select candidates by a semi-join; ties are broken by id.  Vectors in
    no shared bucket are missed, which is the approximation.
    """
    from pyspark.ml.linalg import Vectors

    from functools import reduce

    spark = embeddings.sparkSession
    key = spark.createDataFrame([(-1, Vectors.dense([float(x) for x in query]))], ["embedding_id", "features"])
    if index is not None:
        # a stored index (``load_index``): the query's buckets, one per hash table, become a
        # pushed-down filter on the clustered bucket table
        model, buckets = index
        probe = [(r.table, r.bucket) for r in lsh_buckets(model, key).collect()]   # num_tables rows
        cond = reduce(lambda a, b: a | b, [(F.col("table") == t) & (F.col("bucket") == b) for t, b in probe])
        cand = buckets.filter(cond).select("embedding_id").distinct()
    else:
        model, v = index_vectors(embeddings, **index_args)
        probe = lsh_buckets(model, key).select("table", "bucket")     # num_tables rows
        cand = lsh_buckets(model, v).join(F.broadcast(probe), ["table", "bucket"], "left_semi").select("embedding_id").distinct()
    d = (embeddings.select("embedding_id", "article_id", "embedding").join(cand, "embedding_id", "left_semi")
         .select("embedding_id", "article_id", l2_distance(F.col("embedding"), query).alias("distance")))
    return d.orderBy(F.col("distance").asc_nulls_last(), "embedding_id").limit(k)


def vector_join_lsh(embeddings: DataFrame, questions: DataFrame, threshold: float, **index_args) -> DataFrame:
    """Approximate similarity join: (qid, embedding_id, distance) pairs closer than ``threshold``."""
    from pyspark.ml.functions import array_to_vector

    model, v = index_vectors(embeddings, **index_args)
    q = questions.withColumn("features", array_to_vector(F.col("qvec")))
    j = model.approxSimilarityJoin(q, v, threshold, distCol="distance")
    return j.select(F.col("datasetA.qid").alias("qid"), F.col("datasetB.embedding_id").alias("embedding_id"),
                    "distance")
