"""Pet replay of a stream whose events come in any order.

Three tables lie under one manifest (``sources.manifest``): a snapshot of every player at the watermark, the log of the
events after it, and the current states.  A micro-batch adds its events to the log and replays, from the snapshot and with
the skew-safe ``pet_replay``, only the players it touches.  Every ``fold_every`` batches the watermark moves to the
newest event time less the lateness: what lies before it is folded into the snapshot and leaves the log.  So the
current states equal a replay of all events in order, but for those that were older than the watermark when they came;
they are counted per player (``late_events``).
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarry.functions.scalar import interval_micros
from quarry.operators.lifecycle import MAX_LEVEL, pet_replay
from quarry.session import materialize, scratch_scope
from quarry.sources import manifest

EVENTS = "player string, ts timestamp_ntz, seq long, action string"
SNAPSHOT = "player string, food int, mood int, is_dead boolean, death_date timestamp_ntz"
STATES = f"{SNAPSHOT}, late_events long, unplaced_events long, batch long"


def _micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def _read(spark: SparkSession, path: str, folders: list[str], schema: str) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in folders])


def _write(df: DataFrame, path: str, name: str) -> str:
    folder = f"{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(f"{path}/{folder}")
    return folder


def _of(rows: DataFrame, players: DataFrame, how: str = "left_semi") -> DataFrame:
    """Join on the player; a NULL player is a player of its own."""
    p = players.withColumnRenamed("player", "_player")
    return rows.join(p, rows["player"].eqNullSafe(p["_player"]), how).drop("_player")


def _newest(states: DataFrame) -> DataFrame:
    fields = [f.name for f in states.schema if f.name not in ("player", "batch")]
    return states.groupBy("player").agg(*[F.max_by(c, "batch").alias(c) for c in fields])


def apply_events(events: DataFrame, path: str, batch: int, lateness: str = "1 day", fold_every: int = 20) -> bool:
    """One micro-batch of (player, ts, seq, action); False if it was applied before."""
    spark = events.sparkSession
    version, now = manifest.latest(spark, path)
    if now.get("batch", -1) >= batch:
        return False
    with scratch_scope(spark):
        mark = now.get("watermark")
        placed = F.col("ts").isNotNull() & F.col("seq").isNotNull()
        late = placed & (_micros(F.col("ts")) <= mark) if mark is not None else F.lit(False)
        rows = materialize(events.select("player", "ts", F.col("seq").cast("long").alias("seq"), "action")
                           .withColumn("_late", late).withColumn("_placed", placed), "pet-batch")
        kept = rows.where("_placed AND NOT _late").select("player", "ts", "seq", "action")
        log = now.get("log", []) + [_write(kept, path, f"log-{batch}")]
        touched = materialize(rows.groupBy("player").agg(F.count_if("_late").alias("_late"), F.count_if(~F.col("_placed")).alias("_unplaced")),
                              "pet-touched")
        snapshot = _read(spark, path, now.get("snapshot", []), SNAPSHOT)
        known = _read(spark, path, log, EVENTS)
        after = materialize(pet_replay(_of(known, touched.select("player")), _of(snapshot, touched.select("player"))), "pet-after")
        before = _newest(_read(spark, path, now.get("states", []), STATES)).select(
            "player", F.col("late_events").alias("_l"), F.col("unplaced_events").alias("_u"))
        full = _of(_of(touched, before, "left"), after, "left")
        zero = F.lit(0).cast("long")
        states = full.select(
            "player", F.coalesce("food", F.lit(MAX_LEVEL)).alias("food"), F.coalesce("mood", F.lit(MAX_LEVEL)).alias("mood"),
            F.coalesce("is_dead", F.lit(False)).alias("is_dead"), "death_date", (F.coalesce("_l", zero) + F.col("_late")).alias("late_events"),
            (F.coalesce("_u", zero) + F.col("_unplaced")).alias("unplaced_events"), F.lit(batch).cast("long").alias("batch"))
        newest = max((x for x in (now.get("newest"), kept.agg(F.max(_micros(F.col("ts")))).first()[0]) if x is not None), default=None)
        content = {"batch": batch, "watermark": mark, "newest": newest, "snapshot": now.get("snapshot", []), "log": log,
                   "states": now.get("states", []) + [_write(states, path, f"states-{batch}")]}
        if (batch + 1) % fold_every == 0 and newest is not None:
            content |= _fold(spark, path, content, newest - interval_micros(spark, lateness))
    if not manifest.commit(spark, path, version + 1, content):
        raise RuntimeError(f"another stream writes to {path}")
    return True


def _fold(spark: SparkSession, path: str, content: dict, mark: int) -> dict:
    """Move the watermark: events up to it go into the snapshot, states and log become one folder each."""
    if content["watermark"] is not None and mark <= content["watermark"]:
        mark = content["watermark"]
    log = _read(spark, path, content["log"], EVENTS)
    old = _micros(F.col("ts")) <= mark
    snapshot = pet_replay(log.where(old), _read(spark, path, content["snapshot"], SNAPSHOT)).select("player", "food", "mood", "is_dead", "death_date")
    states = _newest(_read(spark, path, content["states"], STATES)).withColumn("batch", F.lit(content["batch"]).cast("long"))
    names = [c.split()[0] for c in STATES.split(", ")]
    return {"watermark": mark, "snapshot": [_write(snapshot, path, "snapshot")], "log": [_write(log.where(~old), path, "log")],
            "states": [_write(states.select(*names), path, "states")]}


def read_late_states(spark: SparkSession, path: str, with_counts: bool = False) -> DataFrame:
    """Current state per player; ``late_events`` and ``unplaced_events`` (no time or number) on request."""
    out = _newest(_read(spark, path, manifest.latest(spark, path)[1].get("states", []), STATES))
    return out if with_counts else out.drop("late_events", "unplaced_events")


def start_pet_replay_any_order(events: DataFrame, path: str, checkpoint: str, lateness: str = "1 day", fold_every: int = 20,
                               available_now: bool = True, interval: str | None = None) -> StreamingQuery:
    """The stream form of ``apply_events``; a retried micro-batch counts once."""
    w = (events.select("player", "ts", "seq", "action").writeStream
         .foreachBatch(lambda batch, n: apply_events(batch, path, n, lateness, fold_every)).option("checkpointLocation", checkpoint))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval or "1 second")).start()
