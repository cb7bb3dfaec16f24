"""The pipeline's stages, each against brute force on what its predecessor kept."""

import os
import re
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from quarry.llm import mixing, simhash  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_dedup", "mix", "encode"]
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept[-1], SF).write.parquet(str(tmp_path / name))
        kept.append(spark.read.parquet(str(tmp_path / name)))
    rows = [[r.asDict() for r in k.collect()] for k in kept]
    assert all(k.columns == docs.columns for k in kept[:-1])
    # quality: rows go, none change
    all_rows = {r["doc_id"]: r for r in rows[0]}
    assert 0 < len(rows[1]) < len(rows[0]) and all(r == all_rows[r["doc_id"]] for r in rows[1])
    # lines
    key = lambda x: "".join(c.lower() if c.isascii() else c for c in x.strip(" \t\n\v\f\r"))
    n = Counter(k for r in rows[1] for k in {key(x) for x in r["text"].split("\n")} if k)
    want = {r["doc_id"]: "\n".join(x for x in r["text"].split("\n") if n[key(x)] < 10) for r in rows[1]}
    assert {r["doc_id"]: r["text"] for r in rows[2]} == want
    assert all(r["n_chars"] == len(r["text"]) for r in rows[2])
    # near duplicates: the smallest id of every component of the all-pairs graph
    prints = {r["doc_id"]: simhash.simhash(r["text"].encode()) for r in rows[2]}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in prints.items():
        for j, b in prints.items():
            if bin(a ^ b).count("1") <= 2:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    assert sorted(r["doc_id"] for r in rows[3]) == sorted(i for i in prints if find(i) == i)
    # mix: rows as often as planned
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix_table(kept[3]).collect()}
    assert Counter(r["doc_id"] for r in rows[4]) == Counter({i: c for i, c in plan.items() if c})
    # encoding
    text = {r["doc_id"]: r["text"] for r in rows[4]}
    assert len(rows[5]) == len(rows[4])
    for r in rows[5]:
        ids = tok.encode(text[r["doc_id"]], add_special_tokens=False).ids
        assert b"".join(i.to_bytes(4, "little") for i in ids) == bytes(r["ids"])
    # run() gives the same rows
    got = Counter((r["doc_id"], bytes(r["ids"])) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == Counter((r["doc_id"], bytes(r["ids"])) for r in rows[5])
    assert all(re.fullmatch(r"[a-z_]+", n) for n in names)


@pytest.fixture
def odd(spark):
    """Documents with missing and repeated ids, missing and empty texts, repeated rows and columns of awkward names."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    none = docs.where("doc_id < 20").withColumn("doc_id", F.lit(None).cast("long"))
    same = docs.where("doc_id BETWEEN 20 AND 39").withColumn("doc_id", F.lit(5).cast("long"))
    bare = docs.where("doc_id IN (1, 2, 3)").withColumn("text", F.when(F.col("doc_id") > 1, "")).withColumn("source", F.lit(None).cast("string"))
    rows = docs.unionByName(none).unionByName(none).unionByName(same).unionByName(bare)
    return (rows.withColumn("a.b", F.concat_ws("/", "lang", "doc_id")).withColumn("n_lines", F.lit(-1)).withColumn("n_dropped", F.lit(9))
            .withColumn("row", F.lit("mine")).withColumn("score", F.lit(2.0)).withColumn("fingerprint", F.lit("f")))


def test_stages_of_odd_rows(spark, odd, tmp_path):
    kept = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        stage(spark, before, SF).write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        assert kept.columns == odd.columns
        for r in kept.select("doc_id", "lang", "`a.b`", "n_lines", "n_dropped", "row", "score", "fingerprint").collect():
            at = "/".join(str(x) for x in (r["lang"], r["doc_id"]) if x is not None)
            assert tuple(r)[2:] == (at, -1, 9, "mine", 2.0, "f")
        if name == "line_dedup":
            assert kept.count() == before.count()
        elif name != "mix":
            assert kept.exceptAll(before).isEmpty()
        else:
            assert kept.dropDuplicates().exceptAll(before.dropDuplicates()).isEmpty()
    last = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    assert last.count() == kept.count() > 0 and last.where("ids IS NULL").isEmpty()


def test_stages_of_an_empty_table(spark, odd):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), SF).isEmpty()
