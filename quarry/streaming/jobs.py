"""Streaming jobs.  Each ``start_*`` returns a running StreamingQuery; sinks are parquet
folders (append) or idempotent ``foreachBatch`` writes keyed by batch id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarry.operators.lifecycle import MAX_LEVEL, pet_replay


def _trigger(writer, available_now: bool, interval: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval or "1 second")


# ---- append log ---------------------------------------------------------------------------

def start_append_log(readings: DataFrame, sink: str, checkpoint: str, available_now: bool = True,
                     interval: str = "1 second", dedup_watermark: str | None = None) -> StreamingQuery:
    """Append a stream of readings (location, reading, reading_date[, id]) to a parquet log.

    With an ``id`` column, every micro-batch is committed atomically through the file
    sink's log, so readers see whole batches only (the original commits 100 rows per
    transaction).  Without one, ids are assigned like an identity column: each batch is
    numbered consecutively after the rows of all earlier batches, in (reading_date,
    location, reading) order, and written to its own folder ``batch_id=<n>`` in
    overwrite mode, so a retried batch gets the same ids and replaces its own files
    (read it back with ``read_log``).  With ``dedup_watermark`` (extension) repeated
    (location, reading_date) pairs within the watermark are dropped.
    """
    s = readings
    if dedup_watermark:
        cols = s.columns
        # watermarks need TIMESTAMP; readings carry wall-clock TIMESTAMP_NTZ
        s = (s.withColumn("_event_time", F.col("reading_date").cast("timestamp"))
             .withWatermark("_event_time", dedup_watermark)
             .dropDuplicatesWithinWatermark(["location", "reading_date"]).select(*cols))
    if "id" in s.columns:
        w = (s.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
             .outputMode("append"))
        return _trigger(w, available_now, interval).start()

    def write(batch: DataFrame, batch_id: int):
        from quarry.plans.scan import dense_ids
        from quarry.session import path_exists, scratch_scope

        spark = batch.sparkSession
        before = 0
        if batch_id > 0 and path_exists(spark, sink):
            # rows of the committed earlier batches (parquet footers; partition-pruned); a failed
            # read fails the batch, as ids would restart otherwise
            before = spark.read.parquet(sink).filter(F.col("batch_id") < batch_id).count()
        rows = batch.select("location", "reading", "reading_date")
        with scratch_scope(spark):
            numbered = dense_ids(rows, ["reading_date", "location", "reading"], start=before + 1, col="id")
            numbered.select("id", "location", "reading", "reading_date").write.mode("overwrite").parquet(
                f"{sink}/batch_id={batch_id}")

    w = s.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, interval).start()


def read_log(spark: SparkSession, sink: str) -> DataFrame:
    """The append log written with assigned ids: (id, location, reading, reading_date)."""
    return spark.read.parquet(sink).select("id", "location", "reading", "reading_date")


# ---- login audit -----------------------------------------------------------------------------

def _audited(requests: DataFrame, allowed: DataFrame) -> DataFrame:
    a = allowed.select("username").distinct().withColumn("_ok", F.lit(True))
    return (requests.select("username").join(a, "username", "left")
            .select("username", F.coalesce(F.col("_ok"), F.lit(False)).alias("allowed")))


def start_auth_audit(requests: DataFrame, allowed, sink: str, checkpoint: str,
                     available_now: bool = True, interval: str | None = None) -> StreamingQuery:
    """Audit each login request: (username, allowed).  Password hashes never reach the sink.

    ``allowed`` is the allow-list with a ``username`` column (e.g. ``role_members_nosuper``).
    As the path of a parquet folder, or as a callable ``spark -> DataFrame``, it is read again
    for every micro-batch: a grant, a revoke or an overwrite counts from the next batch.  These
    batches go to ``sink/batch_id=<n>`` (a retried one replaces its own files; read them with
    ``read_audit``).  As a DataFrame it is the list as it was when the DataFrame was built, for
    all batches, and the sink is a plain parquet folder.
    """
    if isinstance(allowed, DataFrame):
        w = _audited(requests, allowed).writeStream.format("parquet").option("path", sink)
    else:
        def write(batch: DataFrame, batch_id: int):
            spark = batch.sparkSession
            now = allowed(spark) if callable(allowed) else spark.read.parquet(allowed)
            _audited(batch, now).write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

        w = requests.select("username").writeStream.foreachBatch(write)
    return _trigger(w.option("checkpointLocation", checkpoint), available_now, interval).start()


def read_audit(spark: SparkSession, sink: str) -> DataFrame:
    """The audit written against a path or callable allow-list: (username, allowed)."""
    return spark.read.parquet(sink).select("username", "allowed")


# ---- incremental embeddings ------------------------------------------------------------------

def start_embed_incremental(chunks: DataFrame, sink: str, checkpoint: str, dim: int = 384,
                            available_now: bool = True, interval: str | None = None) -> StreamingQuery:
    """Keep embeddings in step with a chunk table (chunk_id, article_id, chunk, last_updated).

    New or changed chunk rows are embedded per micro-batch and written under
    ``sink/batch_id=<id>`` (overwritten on replay, so a retried batch is idempotent).
    ``read_embeddings`` keeps the newest row per chunk_id.
    """
    from quarry.operators.corpus import embed_chunks

    def write(batch: DataFrame, batch_id: int):
        e = embed_chunks(batch.select("chunk_id", "article_id", "chunk", "last_updated"), "chunk", dim)
        e.drop("chunk").write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    w = chunks.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, interval).start()


def read_embeddings(spark: SparkSession, sink: str) -> DataFrame:
    """Current embeddings: newest ``last_updated`` (then latest batch) per chunk_id.

    The newest version of a chunk is found on two numbers (hash aggregation); only its row
    then brings its vector along.  Equal versions of a chunk within a batch count once.
    """
    e = spark.read.parquet(sink).withColumn("_version", _event_key(F.col("last_updated"), F.col("batch_id")))
    newest = e.groupBy("chunk_id").agg(F.max("_version").alias("_newest")).withColumnRenamed("chunk_id", "_chunk")
    same = e["chunk_id"].eqNullSafe(newest["_chunk"]) & e["_version"].eqNullSafe(newest["_newest"])
    return (e.join(newest, same, "left_semi").dropDuplicates(["chunk_id"])
            .select("chunk_id", "article_id", "last_updated", "embedding"))


# ---- pet replay --------------------------------------------------------------------------------

PET_STATES = ("player string, food int, mood int, is_dead boolean, death_date timestamp_ntz, late_events long, "
              "last_key decimal(38,0)")
WHOLE_EVERY = 50  # every so many batches all states are written, so that no read goes back further


def _event_key(ts: Column, seq: Column) -> Column:
    """One number that follows (ts, seq); NULL if either is."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", epoch, ts).cast("decimal(18,0)")
    return (micros * F.lit(str(1 << 64)).cast("decimal(20,0)") + seq.cast("decimal(20,0)")).cast("decimal(38,0)")


def _states(spark: SparkSession, sink: str, before: int | None = None) -> DataFrame:
    """The state of every player after the batches below ``before`` (all batches if None)."""
    from quarry.session import path_exists

    if not path_exists(spark, sink):
        return spark.createDataFrame([], PET_STATES)
    s = spark.read.schema(f"{PET_STATES}, whole int, batch_id long").parquet(sink)
    if before is not None:
        s = s.filter(F.col("batch_id") < before)
    start = s.filter("whole = 1").agg(F.max("batch_id")).first()[0] or 0
    # one primitive max_by per field (a player has one row per batch id): hash aggregation,
    # where a struct value would sort every stored version
    fields = [f.name for f in s.schema][1:-2]
    return (s.filter(F.col("batch_id") >= start).groupBy("player")
            .agg(*[F.max_by(c, "batch_id").alias(c) for c in fields]))


def _same_player(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    b = b.withColumnRenamed("player", "_player")
    return a.join(b, a["player"].eqNullSafe(b["_player"]), how).drop("_player")


def start_pet_replay(events: DataFrame, sink: str, checkpoint: str, available_now: bool = True,
                     interval: str | None = None) -> StreamingQuery:
    """Replay of a stream of (player, ts, seq, action) events: one state per player.

    Every micro-batch is a batch replay (``operators.lifecycle.pet_replay``) that starts from the
    states of the batches before it, so a player with a third of the events is spread over many
    tasks, as there.  The states of the players it touched go to ``sink/whole=0/batch_id=<n>``;
    every ``WHOLE_EVERY``-th batch writes all states (``whole=1``).  A retried batch reads the
    same earlier states and replaces its own files.  ``read_pet_states`` takes the latest per player.

    Events of one batch are applied in (ts, seq) order.  An event that is not after what was
    applied for its player before this batch came too late, and one without a time or number has no
    place; both are skipped and counted (``late_events``), so the state always equals the replay
    of what was applied.  A NULL player is a player of its own.
    """
    ev = events.select("player", "ts", "seq", "action")

    def write(batch: DataFrame, batch_id: int):
        from quarry.session import scratch_scope

        with scratch_scope(batch.sparkSession):  # a long stream leaves no intermediates behind
            replay(batch, batch_id)

    def replay(batch: DataFrame, batch_id: int):
        from quarry.session import materialize

        spark = batch.sparkSession
        states = _states(spark, sink, batch_id)
        last = states.select("player", "last_key")
        keyed = _same_player(batch.withColumn("_key", _event_key(F.col("ts"), F.col("seq"))), last, "left")
        on_time = F.coalesce(F.col("_key") > F.col("last_key"), F.col("_key").isNotNull())
        marked = materialize(keyed.withColumn("_on_time", on_time).drop("last_key"), "pet-events")
        touched = marked.groupBy("player").agg(F.max(F.when(F.col("_on_time"), F.col("_key"))).alias("_key"),
                                               F.count_if(~F.col("_on_time")).alias("_late"))
        prior = materialize(_same_player(touched, states, "left"), "pet-prior")
        initial = prior.filter("food IS NOT NULL").select("player", "food", "mood", "is_dead", "death_date")
        after = pet_replay(marked.filter("_on_time").select("player", "ts", "seq", "action"), initial)
        counts = prior.select("player", (F.coalesce("late_events", F.lit(0)) + F.col("_late")).alias("late_events"),
                              F.coalesce("_key", "last_key").alias("last_key"))
        out = _same_player(counts, after, "left").select(
            "player", F.coalesce("food", F.lit(MAX_LEVEL)).alias("food"), F.coalesce("mood", F.lit(MAX_LEVEL)).alias("mood"),
            F.coalesce("is_dead", F.lit(False)).alias("is_dead"), "death_date", "late_events", "last_key")
        whole = int(batch_id % WHOLE_EVERY == 0)
        if whole:
            out = out.unionByName(_same_player(states, prior.select("player"), "left_anti"))
        out.write.mode("overwrite").parquet(f"{sink}/whole={whole}/batch_id={batch_id}")

    w = ev.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, interval).start()


def read_pet_states(spark: SparkSession, sink: str, with_late: bool = False) -> DataFrame:
    """Current state per player (latest batch); ``late_events`` on request."""
    out = _states(spark, sink).drop("last_key")
    return out if with_late else out.drop("late_events")
