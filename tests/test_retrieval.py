import random

from pyspark.sql import functions as F

from quarry.operators import retrieval as rv


def _emb(spark, n=300, dim=8, seed=3):
    rnd = random.Random(seed)
    rows = [(i, i % 7, f"chunk {i}", [rnd.uniform(-1, 1) for _ in range(dim)]) for i in range(n)]
    return spark.createDataFrame(rows, "embedding_id long, article_id long, chunk string, embedding array<float>")


def test_rerank_golden(spark):
    arts = [1, 2, 2, 3, 2, 1, 4, 5, 6, 7]
    m = spark.createDataFrame([(i, a, float(i)) for i, a in enumerate(arts)], "embedding_id long, article_id long, distance double")
    got = [(r.embedding_id, r.article_id, r.score) for r in rv.rerank_top3(m).collect()]
    assert got == [(1, 2, 3), (2, 2, 3), (4, 2, 3)]


def test_topk_batch_equals_single(spark):
    e = _emb(spark)
    qs = e.filter(F.col("embedding_id") < 12).select(F.col("embedding_id").alias("qid"), F.col("embedding").alias("qvec"))
    batch = rv.vector_topk_batch(e.repartition(5), qs, k=10)
    got = {}
    for r in batch.collect():
        got.setdefault(r.qid, []).append((r.rank, r.embedding_id))
    for q in qs.collect():
        single = [r.embedding_id for r in rv.vector_topk(e, list(q.qvec), k=10).collect()]
        assert [i for _, i in sorted(got[q.qid])] == single


def test_topk_batch_blocks(spark):
    e = _emb(spark, n=120)
    qs = e.select(F.col("embedding_id").alias("qid"), F.col("embedding").alias("qvec"))
    a = sorted(tuple(r) for r in rv.vector_topk_batch(e, qs, k=5).collect())
    b = sorted(tuple(r) for r in rv.vector_topk_batch(e, qs, k=5, block=25).collect())
    assert a == b and len(a) == 120 * 5


def test_lsh_recall(spark):
    e = _emb(spark, n=400, dim=4)
    q = list(e.filter("embedding_id = 0").first().embedding)
    exact = {r.embedding_id for r in rv.vector_topk(e, q, k=10).collect()}
    approx = {r.embedding_id for r in rv.vector_topk_lsh(e, q, k=10, bucket_length=1.0, num_tables=6).collect()}
    assert len(exact & approx) >= 5


def test_references_and_prompt(spark):
    e = _emb(spark, n=50)
    arts = spark.createDataFrame([(i, f"Title {i}") for i in range(7)], "article_id long, title string")
    q = list(e.filter("embedding_id = 3").first().embedding)
    out = rv.retrieve(e, arts, q, "Why?").first()
    assert out.refs.startswith("Reference 1 from Title ") and out.refs.count("Reference ") == 3
    assert out.prompt.startswith("<|im_start|>system") and "Why?\n<|im_end|>" in out.prompt and out.refs in out.prompt


def test_chat_field(spark):
    df = spark.createDataFrame([('{"chat_response": "yes", "x": 1}',), ("not json",)], "answer string")
    assert [r.chat_response for r in rv.chat_field(df, "answer").collect()] == ["yes", None]


def test_lsh_projections_follow_the_seed(spark):
    # the oracle rebuilds Spark's projection vectors from java.util.Random(seed)
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.linalg import Vectors

    from quarry.plans.oracle_vectors import projections

    df = spark.createDataFrame([(Vectors.dense([0.0] * 8),)], ["features"])
    model = BucketedRandomProjectionLSH(inputCol="features", outputCol="h", bucketLength=0.001, numHashTables=3,
                                        seed=11).fit(df)
    probe = spark.createDataFrame([(Vectors.dense([1.0 if i == j else 0.0 for i in range(8)]),) for j in range(8)],
                                  ["features"])
    # bucket of a unit vector e_j with bucket length 1/1000: floor(1000 * u[t][j])
    got = [[int(h[0]) for h in r.h] for r in model.transform(probe).collect()]
    want = [[int(1000 * u[j] // 1) for u in projections(11, 3, 8)] for j in range(8)]
    assert got == want


def test_lsh_join_pairs_are_true_and_within_threshold(spark):
    import math

    e = _emb(spark, n=200, dim=4)
    vecs = {r.embedding_id: list(r.embedding) for r in e.collect()}
    qs = e.filter("embedding_id < 20").select(F.col("embedding_id").alias("qid"), F.col("embedding").alias("qvec"))
    pairs = rv.vector_join_lsh(e, qs, threshold=0.5, bucket_length=1.0, num_tables=6).collect()
    exact = {(q, i) for q in range(20) for i, v in vecs.items() if math.dist(vecs[q], v) < 0.5}
    got = {(r.qid, r.embedding_id) for r in pairs}
    assert got <= exact and len(got) >= len(exact) // 2
    assert all(abs(r.distance - math.dist(vecs[r.qid], vecs[r.embedding_id])) < 1e-5 for r in pairs)


def test_retrieve_batch_equals_single_question(spark):
    e = _emb(spark, n=150)
    arts = spark.createDataFrame([(a, f"Article {a}") for a in range(7)], "article_id long, title string")
    qs = e.filter("embedding_id IN (3, 40, 99)").select(F.col("embedding_id").alias("qid"), F.col("embedding").alias("qvec"),
                                                         F.col("chunk").alias("question"))
    batch = {r.qid: (r.refs, r.prompt) for r in rv.retrieve_batch(e, arts, qs).collect()}
    for r in qs.collect():
        one = rv.retrieve(e, arts, list(r.qvec), r.question).first()
        assert batch[r.qid] == (one.refs, one.prompt)


def test_topk_missing_vectors_sort_last_like_sql(spark):
    from quarry.functions.scalar import l2_distance

    rows = [(1, 1, [0.0, 0.0]), (2, 1, None), (3, 2, [3.0, 4.0]), (4, 2, [1.0]), (5, 3, [1.0, None]), (6, None, [0.0, 1.0])]
    e = spark.createDataFrame(rows, "embedding_id long, article_id long, embedding array<float>")
    got = [(r.embedding_id, r.article_id, r.distance) for r in rv.vector_topk(e, [0.0, 0.0], k=6).collect()]
    assert got[:3] == [(1, 1, 0.0), (6, None, 1.0), (3, 2, 5.0)]
    assert sorted(got[3:]) == [(2, 1, None), (4, 2, None), (5, 3, None)]
    sql = {r.embedding_id: r.d for r in e.select("embedding_id", l2_distance(F.col("embedding"), [0.0, 0.0]).alias("d")).collect()}
    assert {i: d for i, _a, d in got} == sql


def test_topk_kernel_matches_brute_force():
    import numpy as np
    import pandas as pd

    class Broadcast:
        def __init__(self, value):
            self.value = value

    rnd = np.random.default_rng(11)
    for trial in range(8):
        dim, n, nq, k = [2, 8, 64, 3][trial % 4], 400, 25, [1, 3, 10][trial % 3]
        base = rnd.choice([-1.0, 0.0, 0.5, 1.0], size=(60, dim)) if trial % 2 else rnd.standard_normal((60, dim))
        vecs = base[rnd.integers(0, 60, n)]                      # duplicates -> distance ties
        ids = rnd.permutation(10 * n)[:n]
        missing = rnd.random(n) < 0.03
        q = base[rnd.integers(0, 60, nq)].astype(np.float64)
        q[0, 0] = np.nan                                            # a question with a missing element
        batches = [pd.DataFrame({"embedding_id": ids[s:s + 50], "article_id": ids[s:s + 50] % 7,
                                 "embedding": [None if missing[i] else vecs[i].astype(np.float32) for i in range(s, min(s + 50, n))]})
                   for s in range(0, n, 50)]
        out = pd.concat(list(rv._partial_topk(Broadcast((np.arange(nq), q)), k)(iter(batches))))
        out = out.assign(_n=out["distance"].isna()).sort_values(["qid", "_n", "distance", "embedding_id"]).groupby("qid").head(k)
        ev = vecs.astype(np.float32).astype(np.float64)
        for j in range(nq):
            d = np.sqrt(((ev - q[j]) ** 2).sum(axis=1))
            d[missing | np.isnan(d)] = np.inf
            want = [int(ids[i]) for i in np.lexsort((ids, d))[:k]]
            assert out[out.qid == j]["embedding_id"].tolist() == want, (trial, j)


def test_stored_lsh_index_gives_the_same_neighbours_and_prunes(spark):
    from quarry.session import scratch_path

    e = _emb(spark, n=400, dim=4)
    q = list(e.filter("embedding_id = 5").first().embedding)
    model, v = rv.index_vectors(e, bucket_length=1.0, num_tables=3)
    path = scratch_path(spark, "lsh-index")
    rv.write_index(model, v, path, num_partitions=6)
    idx = rv.load_index(spark, path)
    direct = [tuple(r) for r in rv.vector_topk_lsh(e, q, k=10, bucket_length=1.0, num_tables=3).collect()]
    stored_df = rv.vector_topk_lsh(e, q, k=10, index=idx)
    assert [tuple(r) for r in stored_df.collect()] == direct
    plan = stored_df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan or "PushedFilters: [Or" in plan, plan


def test_topk_batch_repeated_ids_and_missing_vectors(spark):
    e = _emb(spark, n=60)
    v = [list(r.embedding) for r in e.orderBy("embedding_id").limit(3).collect()]
    qs = spark.createDataFrame([(7, v[0])] * 5 + [(8, v[1]), (9, None), (10, v[2][:4])], "qid long, qvec array<float>")
    for block in (3, 100):
        rows = rv.vector_topk_batch(e, qs, k=4, block=block).collect()
        assert len(rows) == 8 * 4
        by = {q: sorted((r.rank, r.embedding_id, r.distance) for r in rows if r.qid == q) for q in (7, 8, 9, 10)}
        single = [r.embedding_id for r in rv.vector_topk(e, v[0], k=4).collect()]
        assert [i for _, i, _ in by[7]] == [i for i in single for _ in range(5)]
        assert by[9] == by[10] == [(n + 1, n, None) for n in range(4)]
    assert rv.vector_topk_batch(e, qs.limit(0), k=4).count() == 0


def test_fetch_context_shuffles_neither_table(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        e = _emb(spark, n=50)
        arts = spark.createDataFrame([(i, f"Title {i}") for i in range(7)], "article_id long, title string")
        top = rv.rerank_top3(rv.vector_topk(e, list(e.first().embedding)))
        plan = rv.fetch_context(top, e, arts)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" not in plan and "hashpartitioning(article_id" not in plan.split("Window")[0], plan
