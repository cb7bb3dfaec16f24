"""The Markdown data source: packing, headers alone, and incremental runs."""

import os
import time

import pytest

from quarry.sources import markdown as md


def write(root, name, text):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode())


CORPUS = {
    "a.md": "---\ntitle: A\n---\nBody", "sub/b.md": "no header", "c.md": "", "d e.md": "---\r\nx: 1\r\n---\r\nline\r\nend", "e.md": "--- \nopen",
    "f.md": "text\n---\nnot: header\n---\n", "g.md": b"---\nk: \xff\n---\n", "h.md": "---\n---\n", "long.md": "---\n" + "k: v\n" * 3000 + "---\n" + "w " * 300_000,
    "i.md": "---\na: 1\n---", "é ü.md": "ü",
}
OTHERS = {"x.txt": "no", ".hidden.md": "no", "sub/_draft.md": "no"}


@pytest.fixture
def folder(tmp_path):
    for name, text in (CORPUS | OTHERS).items():
        write(str(tmp_path / "docs"), name, text)
    return str(tmp_path / "docs")


def expected():
    out = {}
    for name, text in CORPUS.items():
        text = (text if isinstance(text, bytes) else text.encode()).decode("utf-8", "replace").replace("\r\n", "\n")
        out[name] = (md.split_header(text), text)
    return out


def test_reads_every_file_once(spark, folder):
    got = {r["path"]: (r["header"], r["text"]) for r in md.scan_markdown(spark, folder).collect()}
    assert got == expected()
    assert got["a.md"][0] == "title: A\n" and got["h.md"][0] == "" and got["e.md"][0] is got["f.md"][0] is got["c.md"][0] is None
    assert got["i.md"][0] == "a: 1\n" and got["d e.md"] == ("x: 1\n", "---\nx: 1\n---\nline\nend")
    flat = {r["path"] for r in md.scan_markdown(spark, folder, recursive=False, glob="*.m?").collect()}
    assert flat == {n for n in CORPUS if "/" not in n}
    assert md.scan_markdown(spark, folder + "/nothing").count() == 0


def test_files_are_packed_by_bytes(spark, folder):
    assert md.scan_markdown(spark, folder).rdd.getNumPartitions() == 1
    assert md.scan_markdown(spark, folder, partitionBytes=3 * md.BLOCK).rdd.getNumPartitions() > 3
    sizes = [(0, f"f{i:03d}", 10) for i in range(100)]
    packed = md._Corpus({"path": folder, "partitionBytes": 10 * md.BLOCK}).pack(sizes)
    assert len(packed) == 10 and sorted(p for f in packed for p in f.paths) == [s[1] for s in sizes]


def test_headers_alone_read_only_the_head(spark, folder, monkeypatch):
    got = md.scan_markdown(spark, folder, headers_only=True)
    assert got.columns == ["path", "header"]
    assert {r["path"]: r["header"] for r in got.collect()} == {n: h for n, (h, _) in expected().items()}

    class Counted:
        def __init__(self, data):
            self.data, self.at = data, 0

        def read(self, n):
            self.at += n
            return self.data[self.at - n:self.at]

    text = ("---\n" + "k: v\n" * 3000 + "---\n").encode()
    f = Counted(text + b"w " * 3_000_000)
    assert md._Corpus._header(f) == "k: v\n" * 3000 and f.at <= len(text) + 2 * md.BLOCK
    f = Counted(b"no header\n" + b"w " * 3_000_000)
    assert md._Corpus._header(f) is None and f.at == md.BLOCK


def test_a_second_run_reads_new_files_only(spark, tmp_path):
    folder, out, ckpt = (str(tmp_path / x) for x in ("docs", "out", "ckpt"))
    seen = []
    for run in range(3):
        for i in range(5):
            write(folder, f"r{run}/f{i}.md", f"---\nrun: {run}\n---\n{i}")
        time.sleep(0.05)
        s = md.stream_markdown(spark, folder, settleSeconds=0)
        q = s.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        q.awaitTermination()
        seen.append(sum(p["numInputRows"] for p in q.recentProgress))
        assert sorted(r["path"] for r in spark.read.parquet(out).collect()) == sorted(f"r{r}/f{i}.md" for r in range(run + 1) for i in range(5))
    assert seen == [5, 5, 5]
    write(folder, "young.md", "x")
    assert md.MarkdownStream({"path": folder, "settleSeconds": 60}).latestOffset() == {"time": -1, "path": ""}


def test_export_and_scan_give_the_texts_back(spark, tmp_path):
    rows = [(f"a/{i} %é?.md", f"---\nn: {i}\n---\ntext {i}\n") for i in range(30)] + [("null.md", None), (None, "lost")]
    docs = spark.createDataFrame(rows, "path string, text string")
    assert md.export_markdown_files(docs, str(tmp_path / "x")) == 31
    got = {r["path"]: r["text"] for r in md.scan_markdown(spark, str(tmp_path / "x")).collect()}
    assert got == {p: t or "" for p, t in rows if p is not None}
