"""Append units, manifests and the embedding table: failed and repeated writes, late changes, compaction."""

import datetime as dt
import json
import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from quarry.operators.corpus import embed_chunks
from quarry.sources import embedding_table as et
from quarry.sources import manifest, unit_log

READING = "location string, reading long, reading_date timestamp_ntz"
T0 = dt.datetime(2024, 1, 1)


def readings(spark, n, start=0):
    return spark.createDataFrame([(f"A{i % 7}", i, T0 + dt.timedelta(seconds=i // 3)) for i in range(start, start + n)], READING)


def test_units_number_their_rows_and_repeat_once(spark, tmp_path):
    path = str(tmp_path / "log")
    assert unit_log.read_units(spark, path, READING).collect() == []
    for batch, (n, start) in enumerate([(100, 0), (50, 100), (0, 0), (25, 150)]):
        unit_log.append_unit(readings(spark, n, start), path, ["reading_date", "location", "reading"], "import", batch)
    unit_log.append_unit(readings(spark, 50, 100), path, ["reading_date"], "import", 1)  # a retry
    got = unit_log.read_units(spark, path, READING).orderBy("id").collect()
    assert [r["id"] for r in got] == list(range(1, 176))
    for lo, hi in ((0, 100), (100, 150), (150, 175)):
        unit = [(r["reading_date"], r["location"], r["reading"]) for r in got[lo:hi]]
        assert unit == sorted(unit) and {r[2] for r in unit} == set(range(lo, hi))
    names = {f["name"] for v in os.listdir(f"{path}/_units") for f in json.load(open(f"{path}/_units/{v}"))["files"]}
    assert {n for n in os.listdir(f"{path}/data") if n.endswith(".parquet")} == names  # the retry's files are gone


def test_a_failed_unit_leaves_no_row(spark, tmp_path):
    path = str(tmp_path / "log")
    unit_log.append_unit(readings(spark, 10), path)

    def fail(batches):
        for i, b in enumerate(batches):
            yield b
        raise RuntimeError("killed half-way")

    half = readings(spark, 30, 10).repartition(3).mapInArrow(fail, READING)
    with pytest.raises(Exception, match="killed half-way"):
        unit_log.append_unit(half, path)
    # whole files that no entry names, and a cut one, as a lost executor leaves them
    readings(spark, 5, 90).coalesce(1).write.mode("append").parquet(f"{path}/data")
    (tmp_path / "log" / "data" / ".part-9-cut.parquet").write_bytes(b"PAR1 cut")
    assert sorted(r["reading"] for r in unit_log.read_units(spark, path, READING).collect()) == list(range(10))
    unit_log.append_unit(readings(spark, 4, 10), path)
    assert sorted((r["id"], r["reading"]) for r in unit_log.read_units(spark, path, READING).collect()) == [(i + 1, i) for i in range(14)]


def test_unit_stream_restarts(spark, tmp_path):
    unit_log.register(spark)
    src, path, ckpt = (str(tmp_path / x) for x in ("src", "log", "ckpt"))
    for start in (0, 40):
        readings(spark, 40, start).repartition(2).write.mode("append").parquet(src)
        s = spark.readStream.schema(READING).option("maxFilesPerTrigger", 1).parquet(src)
        s.writeStream.format("unit_log").option("checkpointLocation", ckpt).trigger(availableNow=True).start(path).awaitTermination()
    got = unit_log.read_units(spark, path, READING).collect()
    assert sorted(r["id"] for r in got) == list(range(1, 81)) and sorted(r["reading"] for r in got) == list(range(80))


def test_writers_at_once_get_different_ids(tmp_path):
    """Commits race in threads; every one lands, ids do not overlap."""
    writer = unit_log.UnitBatchWriter({"path": str(tmp_path)}, None)
    jobs = [threading.Thread(target=writer._commit, args=([unit_log.Written(0, f"f{i}", 10)], "", -1)) for i in range(12)]
    [j.start() for j in jobs]
    [j.join() for j in jobs]
    files = [f for n in sorted(os.listdir(tmp_path / "_units")) for f in json.load(open(tmp_path / "_units" / n))["files"]]
    assert [f["first_id"] for f in files] == list(range(1, 121, 10)) and len({f["name"] for f in files}) == 12


def test_manifest_versions_never_overwrite(spark, tmp_path):
    path = str(tmp_path)
    assert manifest.latest(spark, path) == (-1, {})
    assert manifest.commit(spark, path, 0, {"a": 1}) and not manifest.commit(spark, path, 0, {"a": 2})
    assert manifest.latest(spark, path) == (0, {"a": 1})
    seen = []

    def change(now):
        seen.append(now["a"])
        if len(seen) == 1:
            manifest.commit(spark, path, 1, {"a": 5})  # another writer comes first
        return {"a": now["a"] + 1}

    assert manifest.update(spark, path, change) == {"a": 6} and seen == [1, 5]
    assert manifest.update(spark, path, lambda now: None) == {"a": 6}


CHANGE = "chunk_id long, article_id long, chunk string, last_updated timestamp_ntz, deleted boolean"


def change(spark, rows):
    return spark.createDataFrame([(i, (i or 0) % 5, text, None if at is None else T0 + dt.timedelta(seconds=at), gone) for i, text, at, gone in rows],
                                 CHANGE).withColumn("bucket", F.lit("x"))


def expected(spark, batches):
    """The rebuilt table: newest change per chunk by (time, batch, delete first), embedded from scratch."""
    best = {}
    for n, rows in enumerate(batches):
        for i, text, at, gone in rows:
            if i is not None:
                key = (-1 if at is None else at, n, bool(gone))
                if i not in best or key >= best[i][0]:
                    best[i] = (key, text, at, gone)
    live = [(i, text, at, False) for i, (_, text, at, gone) in best.items() if not gone]
    return sorted(map(str, embed_chunks(change(spark, live), "chunk", 16).select("chunk_id", "article_id", "last_updated", "embedding").collect()))


def test_embedding_table_equals_a_rebuild(spark, tmp_path):
    path = str(tmp_path / "t")
    r = random.Random(2)
    assert et.read_embedding_table(spark, path).collect() == [] and not et.compact(spark, path)
    batches = []
    for n in range(6):
        rows = {}
        for _ in range(40):
            i = r.choice([None, *range(30)])
            rows[i, r.randint(0, 100) if r.random() < 0.9 else None] = (f"text {n} {r.randint(0, 9)}", r.random() < 0.3)
        batches.append([(i, text, at, gone) for (i, at), (text, gone) in rows.items()])
        assert et.apply_changes(change(spark, batches[-1]), path, n, dim=16)
        assert not et.apply_changes(change(spark, batches[-1]), path, n, dim=16)  # a retry
        if n in (1, 4):
            assert et.compact(spark, path) and manifest.latest(spark, path)[1]["deltas"] == []
        assert sorted(map(str, et.read_embedding_table(spark, path).collect())) == expected(spark, batches), n
    # reads touch the base and the open delta only
    content = manifest.latest(spark, path)[1]
    allowed = set(content["deltas"]) | set(content["base"].values())
    files = et.read_embedding_table(spark, path).inputFiles()
    assert len(content["deltas"]) == 1 and files and {f.split(f"{path}/")[1].split("/")[0] for f in files} <= allowed


def test_a_late_older_change_does_not_bring_a_chunk_back(spark, tmp_path):
    path = str(tmp_path / "t")
    et.apply_changes(change(spark, [(1, "a", 10, False), (2, "b", 10, False)]), path, 0, dim=8)
    et.apply_changes(change(spark, [(1, None, 20, True)]), path, 1, dim=8)
    et.compact(spark, path)
    et.apply_changes(change(spark, [(1, "old", 15, False), (2, "old", 5, False)]), path, 2, dim=8)
    for _ in range(2):
        got = [(r["chunk_id"], r["last_updated"]) for r in et.read_embedding_table(spark, path).collect()]
        assert got == [(2, T0 + dt.timedelta(seconds=10))]
        et.compact(spark, path)


def test_a_batch_during_compaction_stays_open(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    et.apply_changes(change(spark, [(1, "a", 1, False)]), path, 0, dim=8)
    real = et._merged

    def slow(*args):
        out = real(*args)
        if manifest.latest(spark, path)[1]["batches"] == 1:
            et.apply_changes(change(spark, [(1, "b", 2, False), (3, "c", 2, None)]), path, 1, dim=8)
        return out

    monkeypatch.setattr(et, "_merged", slow)
    assert et.compact(spark, path)
    monkeypatch.undo()
    assert len(manifest.latest(spark, path)[1]["deltas"]) == 1
    assert sorted(r["chunk_id"] for r in et.read_embedding_table(spark, path).collect()) == [1, 3]


def test_embedding_table_stream(spark, tmp_path):
    src, path, ckpt = (str(tmp_path / x) for x in ("src", "t", "ckpt"))
    batches = [[(i, f"t{n}", 10 * n + i % 3, i % (n + 2) == 0) for i in range(20)] for n in range(4)]
    for n, rows in enumerate(batches):
        change(spark, rows).drop("bucket").coalesce(1).write.mode("append").parquet(src)
        s = spark.readStream.schema(CHANGE).parquet(src)
        et.start_embedding_table(s, path, ckpt, dim=16, compact_every=2).awaitTermination()
    assert sorted(map(str, et.read_embedding_table(spark, path).collect())) == expected(spark, batches)
