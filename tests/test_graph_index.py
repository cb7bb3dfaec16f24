"""The proximity graph: recall against the exact operator at the registered settings, and awkward rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators.graph_index import build_graph, load_graph, search_graph, vector_topk_graph, write_graph
from quarry.operators.retrieval import vector_topk_batch

SF = "/root/testdata/sf0.1"


def questions(e):
    return e.where("embedding_id % 50 = 0").select(F.col("embedding_id").alias("qid"), F.col("embedding").alias("qvec"))


def answers(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["qid"], {})[r["rank"]] = (r["embedding_id"], round(r["distance"], 6))
    return out


def test_recall_at_registered_settings(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet").select(
        F.col("vec_id").alias("embedding_id"), F.col("label").cast("long").alias("article_id"), "embedding")
    got = vector_topk_graph(e, questions(e)).collect()
    exact = answers(vector_topk_batch(e, questions(e)))
    found = {}
    for r in got:
        found.setdefault(r["qid"], set()).add(r["embedding_id"])
    hits = sum(len({i for i, _ in rows.values()} & found[q]) for q, rows in exact.items())
    assert hits >= 0.9 * sum(len(rows) for rows in exact.values())
    compared = {r["qid"]: r["compared"] for r in got}
    assert sum(compared.values()) < 0.2 * len(exact) * e.count()


def points(spark):
    r = random.Random(3)
    rows = [(i, i % 7, [r.gauss(0, 1) for _ in range(6)]) for i in range(400)]
    rows += [(1000 + i, 1, rows[5][2]) for i in range(300)]  # copies of one vector
    rows += [(2000, 1, None), (2001, 1, [math.nan] * 6), (2002, 1, [None] * 6), (2003, 1, [1.0]), (2004, 1, [math.inf] * 6)]
    return spark.createDataFrame(rows, "embedding_id long, article_id long, embedding array<double>").withColumn("node", F.lit("x"))


def test_copies_missing_vectors_and_a_stored_index(spark, tmp_path):
    e = points(spark)
    index = build_graph(e, k=8, degree=16, orders=3, block=32)
    write_graph(index, str(tmp_path / "g"))
    stored = load_graph(spark, str(tmp_path / "g"))
    ask = questions(e).unionByName(spark.createDataFrame([(7, [0.0] * 6), (7, [0.1] * 6), (8, None), (9, [1.0])], "qid long, qvec array<double>"))
    got = search_graph(stored, ask, k=10, beam=24).collect()
    good = e.where("size(embedding) = 6 AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf'))")
    once = answers(search_graph(stored, questions(good), beam=24))
    exact = answers(vector_topk_batch(good, questions(good)))
    assert once.keys() == exact.keys()
    assert sum(once[q] == exact[q] for q in exact) >= 0.9 * len(exact)
    assert once[1000] == {n + 1: (i, 0.0) for n, i in enumerate([5] + [1000 + i for i in range(9)])}  # smallest ids of the copies
    assert {r["qid"] for r in got} == set(exact) | {7}
    assert len([r for r in got if r["qid"] == 7]) == 20  # each of the two that share an id
    links = index.links.collect()
    assert max(len(r["neighbours"]) for r in links) <= 16 and len(links) == 400


@pytest.mark.parametrize("rows", [[], [(1, 1, None)], [(1, 1, [0.5, 0.5])], [(1, 1, [0.5, 0.5]), (2, 1, [0.25, 0.5])]])
def test_few_rows(spark, rows):
    e = spark.createDataFrame(rows, "embedding_id long, article_id long, embedding array<double>")
    q = spark.createDataFrame([(5, [0.5, 0.5])], "qid long, qvec array<double>")
    got = [(r["embedding_id"], r["rank"]) for r in vector_topk_graph(e, q).orderBy("rank").collect()]
    assert got == [(i, n + 1) for n, (i, _, v) in enumerate(r for r in rows if r[2] is not None)]
