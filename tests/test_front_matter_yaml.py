"""Front matter as VARIANT and the SQL table functions."""

import json

import pytest
from pyspark.sql import functions as F

from quarry.operators.corpus import chunk_text, parse_front_matter
from quarry.operators.front_matter import header_get, parse_front_matter_yaml
from quarry.plans.table_functions import register_table_functions
from test_yaml import HEADERS, load

TEXTS = [f"---\n{h}\n---\nBody of {n}\n" for n, h in HEADERS.items()] + [
    "no header", "", None, "---\na: [1\n---\nbroken", "---\r\na: 1\r\n---\r\nx", "---\na: 1\n---\nbody\n---\nb: 2\n---\nmore", "---\na: .inf\n---\n",
    "---\na: 123456789012345678901234567890\n---\nbig", "---\n" + "k: v\n" * 20_000 + "---\n" + "long " * 50_000]


def test_meta_is_the_whole_header(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "id long, text string, `meta.error` string")
    got = {r["id"]: r for r in parse_front_matter_yaml(docs).select("id", F.to_json("meta").alias("json"), "meta_error", "content").collect()}
    for i, (name, h) in enumerate(HEADERS.items()):
        want = load(h)
        assert (json.loads(got[i]["json"]) if got[i]["json"] else None) == want, name
    assert [got[len(HEADERS) + i]["content"] for i in range(6)] == ["no header", "", None, "broken", "x", "body\nmore"]
    assert got[len(HEADERS) + 3]["meta_error"] and got[len(HEADERS) + 3]["json"] is None
    assert json.loads(got[len(HEADERS) + 5]["json"]) == {"a": 1, "b": 2}
    flat = {r["id"]: r["content"] for r in parse_front_matter(docs.select("id", "text")).collect()}
    assert all(flat[i] == got[i]["content"] for i in got if i < len(HEADERS) + 6 and "content" not in (load(HEADERS[list(HEADERS)[i]]) or {}
                                                                                                     if i < len(HEADERS) else {}))


def test_typed_reads(spark):
    text = "---\nauthor: {name: Ann, age: 41}\ndate: 2024-03-29\ntags: [a, b]\nok: yes\n---\n"
    meta = parse_front_matter_yaml(spark.createDataFrame([(text,)], "text string"))
    row = meta.select(header_get(F.col("meta"), "$.author.name", "string").alias("name"), header_get(F.col("meta"), "$.author.age", "int").alias("age"),
                      header_get(F.col("meta"), "$.date", "date").alias("date"), header_get(F.col("meta"), "$.tags", "array<string>").alias("tags"),
                      header_get(F.col("meta"), "$.ok", "boolean").alias("ok"), header_get(F.col("meta"), "$.author.name", "int").alias("bad"),
                      header_get(F.col("meta"), "$.none", "string").alias("none")).first()
    assert (row["name"], row["age"], str(row["date"]), row["tags"], row["ok"], row["bad"], row["none"]) == (
        "Ann", 41, "2024-03-29", ["a", "b"], True, None, None)


def test_table_functions(spark):
    register_table_functions(spark)
    spark.createDataFrame([(i, t, f"p{i % 3}") for i, t in enumerate(TEXTS[:20])], "article_id int, text string, part string").createOrReplaceTempView("fm_docs")
    got = spark.sql("SELECT * FROM chunk_text(TABLE(SELECT article_id, text AS content, part FROM fm_docs) PARTITION BY part)")
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [("article_id", "int"), ("chunk_no", "int"), ("chunk", "string")]
    want = chunk_text(spark.table("fm_docs").withColumnRenamed("text", "content"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    named = spark.sql("SELECT count(*) FROM chunk_text(TABLE(fm_docs), 'part', 'text')").first()[0]
    assert named == want.count()
    head = spark.sql("SELECT article_id, part, header, header_error, content FROM front_matter(TABLE(fm_docs))")
    form = parse_front_matter_yaml(spark.table("fm_docs")).select("article_id", "part", F.to_json("meta"), "meta_error", "content")
    plain = lambda rows: sorted(((r[0], r[1], json.loads(r[2]) if r[2] else None, r[3], r[4]) for r in rows), key=lambda r: r[0])
    assert plain(head.collect()) == plain(form.collect())
    joined = spark.sql("SELECT d.part, c.chunk_no FROM VALUES ('p0') AS d(part), LATERAL (SELECT * FROM chunk_text(TABLE(fm_docs), 'part', 'text')) c "
                       "WHERE c.part = d.part")
    assert joined.count() == sum(1 for r in spark.sql("SELECT part FROM chunk_text(TABLE(fm_docs), 'part', 'text')").collect() if r[0] == "p0")


@pytest.mark.parametrize("call", ["chunk_text(TABLE(fm_docs), 'nope')", "chunk_text(1)", "front_matter(TABLE(SELECT 1 AS text, 2 AS header))"])
def test_table_function_arguments_are_checked(spark, call):
    register_table_functions(spark)
    spark.createDataFrame([(1, "t")], "article_id int, content string").createOrReplaceTempView("fm_docs")
    with pytest.raises(Exception, match="has no column|is a table|already"):
        spark.sql(f"SELECT * FROM {call}").collect()
