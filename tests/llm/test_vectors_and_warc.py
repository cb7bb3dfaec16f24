"""Top-k by pivots and the WARC source against brute force; registered queries against DuckDB."""

import gzip
import hashlib
import math
import os
import random
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import functions as F  # noqa: E402

from quarry.llm import pivot_topk, warc  # noqa: E402
from quarry.llm.queries import ORACLE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_op1_equals_full_scan(spark):
    r = random.Random(4)
    base = [[r.gauss(0, 1) for _ in range(6)] for _ in range(150)]
    rows = [(i, v) for i, v in enumerate(base)] + [(200 + i, base[0]) for i in range(30)]  # many ties
    rows += [(300, None), (301, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (302, [math.nan] * 6), (303, [math.inf] * 6), (None, base[1]),
             (310, [1.0, 2.0]), (320, [3.0, 2.0]), (330, []), (340, [1e30] * 6), (345, [3e6] * 6), (350, [5e5] * 6), (360, [3e5] * 6), (10, base[10])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("shard", F.lit("x"))
    got = pivot_topk.pivot_topk(table, F.col("vec_id") % 10 == 0, k=10, pivots=5, shard_rows=40, query_block=3).collect()
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None
          and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, a in dict(ok).items():
        if q % 10 == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q and len(a) == len(b))
            found = [(s, i) for s, i in found if -(1 << 63) <= -s < 1 << 63]
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:10])]
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("shard_rows", [16_384, 20])
@pytest.mark.parametrize("size", [1.0, 4e4, 1e6, 3e6, 1e9, 1e15])
def test_op1_is_exact_at_every_size_and_shard_count(spark, size, shard_rows):
    r = random.Random(int(size))
    rows = [(i, [r.uniform(-1, 1) for _ in range(6)]) for i in range(200)] + [(200 + i, [r.uniform(-size, size) for _ in range(6)]) for i in range(20)]
    rows += [(400, [size] * 6), (401, [0.5 / 1024] * 6), (402, [-size] * 6)]
    got = pivot_topk.pivot_topk(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, shard_rows=shard_rows)
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    want = []
    for q, a in whole:
        if q % 20 == 0:
            scores = ((sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q)
            found = sorted((-s, i) for s, i in scores if -(1 << 63) <= s < 1 << 63)
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:10])]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_op1_empty(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert pivot_topk.pivot_topk(table, F.col("vec_id") % 2 == 0).count() == 0


PAGES = [(3, "http://a/é x\n", "<p>é</p>" * 40), (1, "http://b", "<p>é</p>" * 40), (2, None, "short"), (4, "http://c", "short"), (5, "u", None),
         (6, "v", ""), (7, "w", "WARC/1.1\r\n\r\n\r\n\r\nWARC/1.0\r\nContent-Length: 5\r\n\r\n" * 9), (None, "x", "<p>é</p>" * 40),
         (8, "long", "y" * 300_000), (1, "http://b", "<p>é</p>" * 40)]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string")


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_op5_round_trip(spark, tmp_path, compression):
    warc.write_warc(pages(spark), str(tmp_path / "w"), compression=compression)
    got = sorted(map(tuple, warc.page_records(warc.read_warc(spark, str(tmp_path / "w"))).collect()), key=str)
    want = []
    for i, _, html in PAGES:
        raw = (html or "").encode()
        same = [j for j, _, h in PAGES if j is not None and (h or "").encode() == raw]
        again = len(raw) >= 100 and i != min(same)
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", min(same) if again else None))
    assert got == sorted(want, key=str)
    texts = {r["record_id"]: bytes(r["payload"]).decode() for r in warc.read_warc(spark, str(tmp_path / "w")).collect() if r["payload"] is not None}
    assert texts["<urn:page:7>"] == PAGES[6][2] and texts["<urn:page:8>"] == PAGES[8][2]


def test_op5_filters_are_pushed(spark, tmp_path):
    warc.write_warc(pages(spark), str(tmp_path / "w"))
    read = warc.read_warc(spark, str(tmp_path / "w"))
    for condition in ("record_type = 'revisit'", "record_type in ('revisit', 'x')", "record_type = 'response' and target_uri like 'http://%'",
                      "target_uri is not null and content_length > 100"):
        everything = read.toPandas()
        got = read.where(condition)
        assert got.count() == duckdb.sql(f"SELECT count(*) FROM everything WHERE {condition}").fetchall()[0][0]
    plan = read.where("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan warc" in plan and " Filter " not in plan  # the source has taken the whole condition
    reader = warc.WarcReader({"path": str(tmp_path / "w"), "payload": "false"})
    rows = [x for p in reader.partitions() for b in reader.read(p) for x in b.to_pylist()]
    assert len(rows) == len(PAGES) and all(x["payload"] is None for x in rows)


def test_op5_files_are_archives(spark, tmp_path):
    warc.write_warc(pages(spark).coalesce(1), str(tmp_path / "w"))
    raw = b"".join(gzip.decompress(f.read_bytes()) for f in sorted((tmp_path / "w").glob("part-*")))
    at, n = 0, 0
    while at < len(raw):  # by the standard: header, its length of block, blank line
        head = raw.index(b"\r\n\r\n", at)
        fields = dict(x.split(b": ", 1) for x in raw[at:head].split(b"\r\n")[1:])
        at = head + 4 + int(fields[b"Content-Length"])
        assert raw[at:at + 4] == b"\r\n\r\n"
        at, n = at + 4, n + 1
    assert n == len(PAGES)


def test_op5_empty(spark, tmp_path):
    warc.write_warc(pages(spark, []), str(tmp_path / "w"))
    assert warc.read_warc(spark, str(tmp_path / "w")).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    res = con.execute(ORACLE[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(got.columns)
    want = sorted(map(str, res.fetchall()))
    assert sorted(str(tuple(r)) for r in got.select(columns).collect()) == want


def test_ten_queries_are_registered():
    assert {k.split("_")[0] for k in QUERIES} == {f"op{i}" for i in range(1, 11)}
