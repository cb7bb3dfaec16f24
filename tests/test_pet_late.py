"""Events in any order across micro-batches equal one replay in order."""

import datetime as dt
import random
from collections import Counter

from quarry.operators.lifecycle import pet_replay
from quarry.sources import manifest
from quarry.streaming.pet_late import EVENTS, apply_events, read_late_states, start_pet_replay_any_order

T0 = dt.datetime(2024, 1, 1)


def rows_of(df):
    return sorted((str(r["player"]), r["food"], r["mood"], r["is_dead"], str(r["death_date"])) for r in df.collect())


def log(seed, n):
    """Hot player, a NULL player, repeated times, deaths."""
    r = random.Random(seed)
    return [(r.choice(["hot"] * 6 + ["a", "b", "c", None]), T0 + dt.timedelta(minutes=r.randint(0, n)), i,
             r.choice(["tick", "tick", "tick", "tick", "feed", "train"])) for i in range(n)]


def test_any_order_equals_the_replay(spark, tmp_path):
    events = log(1, 400)
    random.Random(2).shuffle(events)
    path = str(tmp_path / "pets")
    for n in range(5):
        part = spark.createDataFrame(events[n * 80:(n + 1) * 80], EVENTS)
        assert apply_events(part, path, n, lateness="1000 days", fold_every=2)
        assert not apply_events(part, path, n, lateness="1000 days", fold_every=2)  # a retry
        want = pet_replay(spark.createDataFrame(events[:(n + 1) * 80], EVENTS))
        assert rows_of(read_late_states(spark, path)) == rows_of(want), n
    assert all(r["late_events"] == 0 for r in read_late_states(spark, path, with_counts=True).collect())


def test_late_means_older_than_the_watermark(spark, tmp_path):
    """Batches overlap by more than the lateness now and then; what is older than the watermark is counted, the rest applied."""
    r = random.Random(3)
    events = sorted(log(4, 360), key=lambda e: e[1] + dt.timedelta(minutes=r.choice([0, 0, 10, 25, 200])))
    path, applied, late, mark = str(tmp_path / "pets"), [], Counter(), None
    for n in range(6):
        part = events[n * 60:(n + 1) * 60]
        apply_events(spark.createDataFrame(part + [(("a"), None, 1, "feed"), ("a", T0, None, "feed")], EVENTS), path, n, lateness="30 minutes", fold_every=2)
        for e in part:
            if mark is not None and e[1] <= mark:
                late[str(e[0])] += 1
            else:
                applied.append(e)
        if n % 2:
            mark = max(e[1] for e in applied) - dt.timedelta(minutes=30)
        got = read_late_states(spark, path, with_counts=True).collect()
        assert {str(x["player"]): x["late_events"] for x in got if x["late_events"]} == dict(late)
        assert {x["player"]: x["unplaced_events"] for x in got if x["unplaced_events"]} == {"a": 2 * (n + 1)}
        assert rows_of(read_late_states(spark, path)) == rows_of(pet_replay(spark.createDataFrame(applied, EVENTS)))
    content = manifest.latest(spark, path)[1]
    assert sum(late.values()) and len(content["log"]) == 1 and len(content["states"]) == 1  # folded, nothing older is read


def test_stream_of_files_out_of_order(spark, tmp_path):
    events = log(5, 120)
    src = str(tmp_path / "src")
    for n in (2, 0, 1):
        spark.createDataFrame(events[n::3], EVENTS).coalesce(1).write.mode("append").parquet(src)
    s = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(src)
    start_pet_replay_any_order(s, str(tmp_path / "p"), str(tmp_path / "c"), lateness="10 days", fold_every=2).awaitTermination()
    assert rows_of(read_late_states(spark, str(tmp_path / "p"))) == rows_of(pet_replay(spark.createDataFrame(events, EVENTS)))


def test_empty(spark, tmp_path):
    path = str(tmp_path / "p")
    assert read_late_states(spark, path).collect() == []
    apply_events(spark.createDataFrame([], EVENTS), path, 0, fold_every=1)
    assert read_late_states(spark, path).collect() == []
