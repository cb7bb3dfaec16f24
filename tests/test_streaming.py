import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from quarry.operators.lifecycle import pet_replay
from quarry.streaming import jobs as sj

T0 = dt.datetime(2024, 1, 1)
EV = "player string, ts timestamp_ntz, seq long, action string"


def _write_parts(spark, rows, schema, folder, parts):
    for i in range(parts):
        spark.createDataFrame(rows[i::parts], schema).coalesce(1).write.mode("append").parquet(folder)


def test_pet_stream_equals_batch_replay_over_many_batches(spark):
    acts = ["tick", "tick", "feed", "tick", "train", "tick", "tick"]
    rows = [(f"p{p}", T0 + dt.timedelta(minutes=i), i, acts[(i * (p + 1)) % 7]) for p in range(4) for i in range(120)]
    base = tempfile.mkdtemp(prefix="pet-stream-")
    src = os.path.join(base, "src")
    # time-ordered files: each micro-batch holds later events than the previous one
    rows.sort(key=lambda r: r[1])
    for i in range(4):
        spark.createDataFrame(rows[i * 120:(i + 1) * 120], EV).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(EV).option("maxFilesPerTrigger", 1).parquet(src)
    q = sj.start_pet_replay(stream, os.path.join(base, "sink"), os.path.join(base, "ckpt"))
    q.awaitTermination()
    got = sorted(tuple(r) for r in sj.read_pet_states(spark, os.path.join(base, "sink")).collect())
    want = sorted(tuple(r) for r in pet_replay(spark.createDataFrame(rows, EV)).collect())
    assert got == want


def test_append_log_restart_is_exactly_once(spark):
    schema = "id long, location string, reading long, reading_date timestamp_ntz"
    base = tempfile.mkdtemp(prefix="log-stream-")
    src, sink, ckpt = (os.path.join(base, x) for x in ("src", "sink", "ckpt"))
    rows = [(i, f"A{i % 100 + 1}", i % 100 + 1, T0 + dt.timedelta(seconds=i // 100)) for i in range(900)]
    _write_parts(spark, rows[:500], schema, src, 2)
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    sj.start_append_log(stream(), sink, ckpt).awaitTermination()
    assert spark.read.parquet(sink).count() == 500
    _write_parts(spark, rows[500:], schema, src, 2)
    sj.start_append_log(stream(), sink, ckpt).awaitTermination()   # restart from the checkpoint
    out = spark.read.parquet(sink)
    assert out.count() == 900 and out.select("id").distinct().count() == 900


def test_auth_audit_never_writes_passwords(spark):
    base = tempfile.mkdtemp(prefix="audit-")
    src = os.path.join(base, "src")
    spark.createDataFrame([("alice",), ("mallory",)], "username string").write.parquet(src)
    allowed = spark.createDataFrame([("alice", "hash")], "username string, password string")
    req = spark.readStream.schema("username string").parquet(src)
    sj.start_auth_audit(req, allowed, os.path.join(base, "sink"), os.path.join(base, "ckpt")).awaitTermination()
    out = spark.read.parquet(os.path.join(base, "sink"))
    assert out.columns == ["username", "allowed"]
    assert sorted(tuple(r) for r in out.collect()) == [("alice", True), ("mallory", False)]


def test_embed_incremental_keeps_newest(spark):
    schema = "chunk_id long, article_id long, chunk string, last_updated timestamp_ntz"
    base = tempfile.mkdtemp(prefix="embed-")
    src = os.path.join(base, "src")
    spark.createDataFrame([(1, 1, "old text", T0), (2, 1, "other", T0)], schema).write.mode("append").parquet(src)
    spark.createDataFrame([(1, 1, "new text", T0 + dt.timedelta(hours=1))], schema).write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    sj.start_embed_incremental(stream, os.path.join(base, "sink"), os.path.join(base, "ckpt"), dim=8).awaitTermination()
    cur = {r.chunk_id: r for r in sj.read_embeddings(spark, os.path.join(base, "sink")).collect()}
    assert set(cur) == {1, 2} and cur[1].last_updated == T0 + dt.timedelta(hours=1) and len(cur[1].embedding) == 8


def test_pet_stream_skips_out_of_order_events(spark):
    base = tempfile.mkdtemp(prefix="pet-late-")
    src = os.path.join(base, "src")
    first = [("p", T0 + dt.timedelta(minutes=i), i, "tick") for i in range(10, 20)]
    late = [("p", T0 + dt.timedelta(minutes=i), i, "feed") for i in range(0, 3)]
    spark.createDataFrame(first, EV).coalesce(1).write.mode("append").parquet(src)
    spark.createDataFrame(late, EV).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(EV).option("maxFilesPerTrigger", 1).parquet(src)
    sj.start_pet_replay(stream, os.path.join(base, "sink"), os.path.join(base, "ckpt")).awaitTermination()
    r = sj.read_pet_states(spark, os.path.join(base, "sink"), with_late=True).first()
    assert (r.food, r.mood, r.late_events) == (14, 14, 3)


def test_append_log_dedup_within_watermark(spark):
    schema = "id long, location string, reading long, reading_date timestamp_ntz"
    base = tempfile.mkdtemp(prefix="log-dedup-")
    src = os.path.join(base, "src")
    rows = [(1, "A1", 5, T0), (2, "A1", 6, T0), (3, "A2", 7, T0)]
    spark.createDataFrame(rows, schema).write.parquet(src)
    stream = spark.readStream.schema(schema).parquet(src)
    sj.start_append_log(stream, os.path.join(base, "sink"), os.path.join(base, "ckpt"),
                        dedup_watermark="1 hour").awaitTermination()
    assert spark.read.parquet(os.path.join(base, "sink")).count() == 2


def _with_schedule(rows, hours=1):
    """The batch log a game loop would have written: a tick at every full hour after a
    player's first event up to its last one (ticks sort before events at the same time)."""
    out = list(rows)
    for p in {r[0] for r in rows}:
        ts = [r[1] for r in rows if r[0] == p]
        t = (min(ts) + dt.timedelta(hours=hours)).replace(minute=0, second=0, microsecond=0)
        while t <= max(ts):
            out.append((p, t, -1, "tick"))
            t += dt.timedelta(hours=hours)
    return out


def test_pet_stream_spreads_a_hot_player_and_goes_on_from_whole_states(spark, monkeypatch):
    from quarry import session

    monkeypatch.setattr(sj, "WHOLE_EVERY", 2)
    scratch = list(session._scratch)
    acts = ["tick", "feed", "tick", "train", "tick", "tick"]
    rows = [("hot" if i % 5 else [None, "a", "b"][i // 5 % 3], T0 + dt.timedelta(minutes=i), i, acts[i * i % 6]) for i in range(400)]
    base = tempfile.mkdtemp(prefix="pet-hot-")
    src, sink = os.path.join(base, "src"), os.path.join(base, "sink")
    for i in range(5):
        spark.createDataFrame(rows[i * 80:(i + 1) * 80], EV).coalesce(1).write.mode("append").parquet(src)
    # a player of the first batch alone, and events without a time or a number
    spark.createDataFrame([("once", None, 1, "feed"), ("once", T0, None, "tick")], EV).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(EV).option("maxFilesPerTrigger", 1).parquet(src)
    sj.start_pet_replay(stream, sink, os.path.join(base, "ckpt")).awaitTermination()
    assert session._scratch == scratch  # every micro-batch removed its intermediates
    got = {r.player: tuple(r) for r in sj.read_pet_states(spark, sink, with_late=True).collect()}
    want = {r.player: tuple(r) + (0,) for r in pet_replay(spark.createDataFrame(rows, EV)).collect()}
    assert got == want | {"once": ("once", 24, 24, False, None, 2)}
    whole = spark.read.parquet(sink).filter("whole = 1").groupBy("batch_id").count().collect()
    assert {r.batch_id for r in whole} == {0, 2, 4}


def test_batch_game_loop_equals_loop_ticks_in_the_log(spark):
    acts = ["feed", "train", "tick", "feed", "train"]
    rows = [(f"p{p}", T0 + dt.timedelta(minutes=37 * i + 11 * p), i, acts[(i + p) % 5]) for p in range(5) for i in range(60)]
    rows += [("idle", T0, 0, "feed"), ("idle", T0 + dt.timedelta(hours=30), 1, "feed")]
    df = spark.createDataFrame(rows, EV)
    got = sorted(tuple(r) for r in pet_replay(df, tick_period="1 hour", num_partitions=5).collect())
    want = sorted(tuple(r) for r in pet_replay(spark.createDataFrame(_with_schedule(rows), EV)).collect())
    assert got == want


def test_batch_game_loop_until_matches_a_step_by_step_fold(spark):
    # after the last event the loop keeps ticking up to `until`: compare with a plain fold
    rows = [("a", T0, 0, "feed"), ("b", T0 + dt.timedelta(minutes=30), 0, "train"), ("b", T0 + dt.timedelta(hours=5), 1, "feed"),
            ("c", T0, 0, "tick")]
    until = T0 + dt.timedelta(hours=40, minutes=10)
    got = {r.player: (r.food, r.mood, r.is_dead, r.death_date)
           for r in pet_replay(spark.createDataFrame(rows, EV), tick_period="1 hour", until=until).collect()}
    for p in "abc":
        ev = sorted([(t, s, a) for q, t, s, a in rows if q == p] +
                    [(t, -1, "tick") for t in (T0 + dt.timedelta(hours=h) for h in range(1, 41))
                     if min(r[1] for r in rows if r[0] == p) < t <= until])
        f, m, dead, death = 24, 24, False, None
        for t, _s, a in ev:
            if dead:
                continue
            f, m = (min(24, f + 8), min(24, m)) if a == "feed" else (min(24, f), min(24, m + 12)) if a == "train" \
                else (min(24, f - 1), min(24, m - 1))
            if a == "tick" and (f < 1 or m < 1):
                dead, death = True, t
        assert got[p] == (f, m, dead, death), p


def test_append_log_assigns_identity_ids_across_batches(spark):
    schema = "location string, reading long, reading_date timestamp_ntz"
    base = tempfile.mkdtemp(prefix="log-ids-")
    src, sink, ckpt = (os.path.join(base, x) for x in ("src", "sink", "ckpt"))
    rows = [(f"A{i % 7}", i, T0 + dt.timedelta(seconds=i // 10)) for i in range(300)]
    _write_parts(spark, rows, schema, src, 3)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    sj.start_append_log(stream, sink, ckpt).awaitTermination()
    got = sorted(tuple(r) for r in sj.read_log(spark, sink).collect())
    assert [r[0] for r in got] == list(range(1, 301))           # consecutive over all batches
    assert sorted(r[1:] for r in got) == sorted(rows)             # every reading once
    # within a batch ids follow (reading_date, location, reading)
    by_batch = spark.read.parquet(sink).groupBy("batch_id").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).collect()
    assert sorted((r.lo, r.hi) for r in by_batch) == [(1, 100), (101, 200), (201, 300)]


def test_auth_audit_follows_grants_revokes_and_overwrites(spark):
    base = tempfile.mkdtemp(prefix="audit-")
    src, sink, ckpt, acl = (os.path.join(base, n) for n in ("src", "sink", "ckpt", "acl"))

    def audited(names):
        spark.createDataFrame([(n,) for n in names], "username string").write.mode("append").parquet(src)
        req = spark.readStream.schema("username string").parquet(src)
        sj.start_auth_audit(req, acl, sink, ckpt).awaitTermination()
        return sorted(tuple(r) for r in sj.read_audit(spark, sink).collect())

    grant = lambda names, mode: spark.createDataFrame([(n,) for n in names], "username string").write.mode(mode).parquet(acl)
    grant(["alice"], "overwrite")
    seen = audited(["alice", "carol"])
    assert seen == [("alice", True), ("carol", False)]
    grant(["carol"], "append")
    seen = audited(["carol"])
    assert seen == [("alice", True), ("carol", False), ("carol", True)]
    grant(["bob"], "overwrite")
    assert audited(["alice", "bob"]) == [("alice", False), ("alice", True), ("bob", True), ("carol", False), ("carol", True)]


def test_streams_read_a_table_of_part_files_like_a_single_file(spark, tmp_path):
    import shutil
    from collections import Counter

    from conftest import SF_SMALL
    from quarry.plans.registry import QUERIES

    for f in os.listdir(SF_SMALL):
        if f in ("events.parquet", "customer.parquet", "documents.parquet"):
            spark.read.parquet(f"{SF_SMALL}/{f}").repartition(4).write.parquet(str(tmp_path / f))
        else:
            shutil.copy(f"{SF_SMALL}/{f}", tmp_path / f)
    for key in ("append_log", "append_log_ids", "auth_audit", "embed_incremental", "pet_replay_stream"):
        one, parts = (QUERIES[key](spark, d).collect() for d in (SF_SMALL, str(tmp_path)))
        assert one and Counter(map(str, parts)) == Counter(map(str, one)), key
