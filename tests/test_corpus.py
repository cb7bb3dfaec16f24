import os
import tempfile

from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.operators import corpus as cp
from quarry.sources.corpus import scan_corpus


def test_front_matter_toggles(spark):
    text = "---\ntitle: A\n---\nbody\n---\nk: v\n---\nend\n"
    df = spark.createDataFrame([("x.md", text), ("y.md", "no header\r\nat all\n"),
                                ("z.md", "---\ntitle: 'Quoted: yes'\ntitle: second\nauthor: \"Me\"\n---\nhi")], "path string, text string")
    got = {r.path: (dict(r.headers), r.content) for r in cp.parse_front_matter(df).collect()}
    assert got["x.md"] == ({"title": "A", "k": "v"}, "body\nend\n")
    assert got["y.md"] == ({}, "no header\nat all\n")
    assert got["z.md"] == ({"title": "second", "author": "Me"}, "hi")


def test_articles_typed_and_rejects(spark):
    df = spark.createDataFrame([("a.md", "---\nauthor: me\ntitle: T\ndate: 2024-03-29 23:30:00-02:00\n---\nx"),
                                ("b.md", "---\ntitle: T\n---\ny"), ("c.md", "plain")], "path string, text string")
    ok, bad = cp.articles(cp.parse_front_matter(df))
    r = ok.first()
    assert (r.path, r.author, r.title, str(r.publish_date), r.content) == ("a.md", "me", "T", "2024-03-30", "x")
    rej = {x.path: x.reason for x in bad.collect()}
    assert set(rej) == {"b.md", "c.md"} and "author" in rej["b.md"] and "date" in rej["c.md"]


def test_reject_filter_does_not_repeat_the_parse(spark):
    # the reject check must read the parsed headers, not re-run the regex split of the text
    df = spark.createDataFrame([("a.md", "---\nauthor: me\ntitle: T\ndate: 2024-01-01\n---\nx")], "path string, text string")
    ok, _bad = cp.articles(cp.parse_front_matter(df))
    plan = ok._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("---[^\\S\\n]*(?:\\n|$)") == 1, plan


def test_chunk_goldens():
    assert cp.split_text("one two three four five", 10, 4) == ["one two", "two three", "four five"]
    assert cp.split_text("p1 aa\n\np2 bb cc dd ee\n\np3", 8, 3) == ["p1 aa", "p2 bb", "bb cc", "cc dd", "dd ee", "p3"]
    assert cp.split_text("aaaa.bbbb.cccc", 6, 0) == ["aaaa", ".bbbb", ".cccc"]
    assert cp.split_text("a" * 600, 500, 20) == ["a" * 600]
    assert [len(c) for c in cp.split_text(" ".join(["word"] * 300), 500, 20)] == [499, 499, 499, 59]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab .\n`")), max_size=400), st.integers(5, 60))
def test_chunk_properties(text, size):
    chunks = cp.split_text(text, size, min(3, size - 1))
    for c in chunks:
        assert c
        # merged chunks are stripped and fit; only an unbreakable piece (kept as cut) may exceed the size
        assert (c == c.strip() and len(c) <= size) or (len(c) >= size and not any(s in c[1:] for s in cp.SEPARATORS))
    # every non-space character is covered, in order
    flat = "".join(text.split())
    it = iter("".join("".join(c.split()) for c in chunks))
    assert all(ch in it for ch in flat)


def test_chunk_text_rows(spark):
    df = spark.createDataFrame([(1, "one two three four five"), (2, None), (3, "x")], "article_id long, content string")
    rows = sorted((r.article_id, r.chunk_no, r.chunk) for r in cp.chunk_text(df, size=10, overlap=4).collect())
    assert rows == [(1, 0, "one two"), (1, 1, "two three"), (1, 2, "four five"), (3, 0, "x")]


def test_embed_is_normalised_and_deterministic(spark):
    df = spark.createDataFrame([(1, "the cat sat"), (2, "the cat sat"), (3, ""), (4, None)], "id long, chunk string")
    rows = {r.id: r.embedding for r in cp.embed_chunks(df, dim=16).collect()}
    assert len(rows[1]) == 16 and rows[1] == rows[2]
    assert abs(sum(x * x for x in rows[1]) - 1.0) < 1e-5
    assert all(x == 0 for x in rows[3])


def test_scan_corpus_reads_whole_files(spark):
    d = tempfile.mkdtemp(prefix="corpus-test-")
    with open(os.path.join(d, "a.md"), "w") as f:
        f.write("---\ntitle: A\n---\nline1\r\nline2\n")
    with open(os.path.join(d, "skip.txt"), "w") as f:
        f.write("ignored")
    rows = scan_corpus(spark, d).collect()
    assert len(rows) == 1 and rows[0].path.endswith("a.md") and rows[0].text == "---\ntitle: A\n---\nline1\nline2\n"


def test_assign_ids_consecutive(spark):
    df = spark.range(0, 1000).selectExpr("concat('doc', lpad(cast(id as string), 4, '0')) AS path")
    ids = [r.article_id for r in cp.assign_ids(df.repartition(7), ["path"]).orderBy("path").collect()]
    assert ids == list(range(1, 1001))


def test_chunk_oracle_sql_matches_splitter():
    # the DuckDB oracle of chunk_text is generated SQL; it must agree with split_text exactly
    import random

    import duckdb

    from quarry.plans.oracle_chunks import chunk_sql

    rnd = random.Random(7)
    alpha = list("ab .\n`é'") + ["\n\n", "```", "  "]
    con = duckdb.connect()
    for _ in range(12):
        size, ov = rnd.randint(3, 40), rnd.randint(0, 12)
        docs = [(i, "".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 250)))) for i in range(30)]
        con.execute("CREATE OR REPLACE TABLE d(doc_id BIGINT, text VARCHAR)")
        con.executemany("INSERT INTO d VALUES (?, ?)", docs)
        got = set(con.execute("WITH " + chunk_sql("d", "doc_id", "text", size, ov) + " SELECT * FROM chunks").fetchall())
        assert got == {(d, i, c) for d, t in docs for i, c in enumerate(cp.split_text(t, size, ov))}


def test_embed_oracle_sql_matches_hashing_encoder(spark):
    # the SQL encoder (murmur3 seed 42, non-negative mod, L2) must give the same float vectors
    import duckdb

    from quarry.plans.oracle_chunks import embed_sql

    texts = [(1, "Hello, hello WORLD_1"), (2, "..."), (3, None), (4, "abcd abcde a ab abc zz9 déjà vu"),
             (5, " ".join(f"w{i % 37}x" for i in range(400)))]
    df = spark.createDataFrame(texts, "id long, chunk string")
    got = {r.id: list(r.embedding) for r in cp.embed_chunks(df, "chunk", 16).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE src(id BIGINT, chunk VARCHAR)")
    con.executemany("INSERT INTO src VALUES (?, ?)", texts)
    want = dict(con.execute("WITH " + embed_sql("src", ["id"], "chunk", 16) + " SELECT id, embedding FROM embedded").fetchall())
    assert got == want


def test_append_articles_continues_ids(spark):
    from quarry.session import scratch_path
    from quarry.sources.corpus import append_articles

    md = spark.createDataFrame([(f"d{i}.md", f"---\nauthor: a\ntitle: T{i}\ndate: 2024-01-0{i + 1}\n---\nbody {i}")
                                for i in range(3)], "path string, text string")
    ok, _bad = cp.articles(cp.parse_front_matter(md))
    out = scratch_path(spark, "append-articles")
    append_articles(ok, out)
    append_articles(ok, out)  # a re-import appends duplicates under new ids
    rows = sorted((r.article_id, r.path) for r in spark.read.parquet(out).collect())
    assert [i for i, _ in rows] == [1, 2, 3, 4, 5, 6]
    assert [p for _, p in rows] == ["d0.md", "d1.md", "d2.md"] * 2


def test_embed_with_a_pluggable_encoder(spark):
    import numpy as np

    def letters(texts):  # a stand-in model: counts of a, b, c per text
        return np.array([[t.count("a"), t.count("b"), t.count("c")] for t in texts])

    df = spark.createDataFrame([(1, "aab"), (2, "ccc"), (3, ""), (4, None)], "id long, chunk string")
    got = {r.id: [round(x, 5) for x in r.embedding] for r in cp.embed_chunks(df, "chunk", 3, encoder=letters).collect()}
    assert got[1] == [round(2 / 5 ** 0.5, 5), round(1 / 5 ** 0.5, 5), 0.0]
    assert got[2] == [0.0, 0.0, 1.0] and got[3] == [0.0, 0.0, 0.0] and got[4] == [0.0, 0.0, 0.0]


def test_front_matter_nested_comments_and_content(spark):
    head = "cover:\n  title: Picture\n  date: 1999-01-01\ntags:\n- title: not this\n# date: nor this\n"
    df = spark.createDataFrame([
        ("n.md", f"---\ntitle: Real # the title\nauthor: \"Bob # B\" # quoted\n{head}date: 2024-03-29 # day\n---\nbody"),
        ("c.md", "---\ntitle: T\nauthor: A#1\ndate: 2024-01-01\ncontent: from the header\n---\nbody")],
        "path string, text string")
    parsed = cp.parse_front_matter(df)
    got = {r.path: (r.headers, r.content) for r in parsed.collect()}
    assert got["n.md"] == ({"title": "Real", "author": "Bob # B", "cover": None, "tags": None, "date": "2024-03-29"}, "body")
    assert got["c.md"][0]["author"] == "A#1" and got["c.md"][1] == "from the header"
    ok, bad = cp.articles(parsed)
    assert {(r.path, r.title, str(r.publish_date)) for r in ok.collect()} == {
        ("n.md", "Real", "2024-03-29"), ("c.md", "T", "2024-01-01")}
    assert bad.count() == 0


def test_articles_reject_bad_dates_and_empty_values(spark):
    df = spark.createDataFrame([("d.md", "---\ntitle: T\nauthor: A\ndate: soon\n---\nx"),
                                ("e.md", "---\ntitle: T\nauthor:\ndate: 2024-01-01\n---\nx"),
                                ("q.md", "---\ntitle: T\nauthor: ''\ndate: 2024-01-01\n---\nx"),
                                ("0.md", None)], "path string, text string")
    ok, bad = cp.articles(cp.parse_front_matter(df))
    assert [(r.path, r.author) for r in ok.collect()] == [("q.md", "")]
    reasons = {r.path: r.reason for r in bad.collect()}
    assert "date" in reasons["d.md"] and reasons["e.md"].endswith(": author") and set(reasons) == {"d.md", "e.md", "0.md"}


def test_export_writes_one_file_a_document_in_few_folders(spark):
    from quarry.session import scratch_path
    from quarry.sources.corpus import EXPORT_FOLDERS, export_markdown

    docs = [(f"corpus/{i}.md", f"---\ntitle: é{i}\n---\n\nline\n" if i % 3 else "") for i in range(600)]
    odd = [("twice.md", "b"), ("twice.md", "a"), ("null.md", None), (None, "x"), ("", "y"), ("crlf.md", "1\r\n2\r3\n\n")]
    root = scratch_path(spark, "export")
    export_markdown(spark.createDataFrame([("old.md", "gone")], "path string, text string"), root)
    assert export_markdown(spark.createDataFrame(docs + odd, "path string, text string").repartition(5), root) == 606
    local = root.removeprefix("file:")
    files = [f for _, _, names in os.walk(local) for f in names]
    assert len(files) == 604 and all(f.endswith(".md") for f in files) and len(os.listdir(local)) <= EXPORT_FOLDERS
    got = scan_corpus(spark, root, recursive=True, logical_names=True).collect()
    want = docs + [("twice.md", "a\nb"), ("null.md", ""), ("", "x\ny"), ("crlf.md", "1\n2\n3\n\n")]
    assert sorted((r.path, r.text) for r in got) == sorted(want)
    empty = spark.createDataFrame([], "path string, text string")
    assert export_markdown(empty, root) == 0 and scan_corpus(spark, root, recursive=True, logical_names=True).count() == 0


def test_chunks_leave_a_task_in_bounded_batches(spark, monkeypatch):
    import pyarrow as pa

    docs = spark.createDataFrame([(1, "x")], "article_id long, content string")
    caught = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, fn, schema: caught.append(fn))
    cp.chunk_text(docs)
    texts = [f"word{i} " * 2500 for i in range(400)] + [None, ""]
    whole = pa.RecordBatch.from_arrays([pa.array([None, *range(1, 402)], pa.int64()), pa.array(texts)], ["article_id", "content"])
    made = list(caught[0](iter([whole])))
    assert len(made) > 3 and max(sum(map(len, b.column(2).to_pylist())) for b in made) <= cp.CHUNK_BATCH + cp.CHUNK_SIZE
    got = [row for b in made for row in zip(*(c.to_pylist() for c in b.columns))]
    assert got == [(i or None, n, c) for i, t in enumerate(texts) if t for n, c in enumerate(cp.split_text(t))]


def test_scan_lists_files_in_tasks_and_keeps_spark_names(spark, tmp_path):
    names = ["a.md", "sub dir/b %1+é#;=&~.md", "sub dir/deep/c.md", "_k=v/x.md", "_a=b.md", "_metadata/m.md", "é/q{1}.md", "　w\x85😀.md",
             "u.MD", "_d.md", ".z.md", ".h/x.md", "_x/x.md", "_metadata.md", "x.md._COPYING_", "sub dir/empty.md"]
    root = str(tmp_path / "docs")
    for name in names:
        os.makedirs(os.path.dirname(os.path.join(root, name)), exist_ok=True)
        with open(os.path.join(root, name), "wb") as f:
            f.write(b"" if "empty" in name else b"\xff\r\n" + name.encode())
    os.symlink("nothing", os.path.join(root, "link.md"))

    def by_index(folder, glob, recursive):
        df = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", recursive).load(folder)
        return sorted((r.p, r.t) for r in df.selectExpr("_metadata.file_path AS p", r"regexp_replace(cast(content AS string), '\r', '') AS t").collect())

    for folder, glob, recursive in ((root, "*.md", True), (root, "*.{MD,m?}", True), (root + "/sub dir", "[!c].md", True), ("file:" + root + "/é/", "*.md", False)):
        scan = scan_corpus(spark, folder, glob, recursive)
        assert not [f for f in scan.inputFiles() if "/docs/" in f]  # no document's file is listed in the driver
        assert sorted((r.path, r.text) for r in scan.collect()) == by_index(folder, glob, recursive)
    assert scan_corpus(spark, root, recursive=True).count() == 8
    # without recursive, folders below are not read; patterns and single files are
    flat = str(tmp_path / "flat")
    os.makedirs(flat + "/below")
    for name in ("a.md", "below/b.md"):
        with open(f"{flat}/{name}", "w") as f:
            f.write(name)
    for path in (flat, flat + "/a.md", flat + "/*.md"):
        assert [r.text for r in scan_corpus(spark, path).collect()] == ["a.md"]


def test_scan_reads_files_that_were_there_in_few_partitions(spark, tmp_path):
    import pytest

    for i in range(300):
        (tmp_path / f"{i}.md").write_text(f"{i}")
    scan = scan_corpus(spark, str(tmp_path))
    (tmp_path / "late.md").write_text("late")
    assert sorted(int(r.text) for r in scan.collect()) == list(range(300))
    assert scan.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism  # not one for a few files each
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_corpus(spark, str(tmp_path / "none"), recursive=True)
