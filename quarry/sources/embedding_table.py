"""Embeddings that follow inserts, updates and deletes of their chunks: base files, open deltas and tombstones.

A batch of changes becomes one delta: the newest change of each chunk, embedded, or a tombstone.  A manifest
(``sources.manifest``) names the base folder of every bucket and the open deltas; only what it names is read.  Reading
merges on the fly: of the versions of a chunk the newest counts (by ``last_updated``, then by batch), and a
tombstone hides what is older, also what arrives later.  Compaction merges the buckets that have open
deltas into new base folders and swaps the manifest; batches that commit meanwhile stay open.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarry.operators.corpus import EMBED_DIM, embed_chunks
from quarry.sources import manifest

BUCKETS = 64
ROWS = "chunk_id long, article_id long, last_updated timestamp_ntz, deleted boolean, version decimal(38), embedding array<float>"


def _version(last_updated: Column, number: int) -> Column:
    """One number that orders by time, then by the number of the batch; a missing time is the oldest."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.coalesce(F.timestamp_diff("MICROSECOND", epoch, last_updated), F.lit(-(1 << 62)))
    return (micros.cast("decimal(19,0)") * F.lit(1 << 32).cast("decimal(11,0)") + F.lit(number).cast("decimal(11,0)")).cast("decimal(38,0)")


def apply_changes(changes: DataFrame, path: str, batch: int, producer: str = "", dim: int = EMBED_DIM, encoder=None) -> bool:
    """One batch of changes(chunk_id, article_id, chunk, last_updated, deleted); False if it was applied before.

    Of several changes to a chunk the newest counts (of equally new ones a delete, then the smallest text).
    """
    spark = changes.sparkSession
    _, content = manifest.latest(spark, path)
    if content.get("applied", {}).get(producer, -1) >= batch:
        return False
    deleted = F.coalesce(F.col("deleted"), F.lit(False))
    rows = changes.select("chunk_id", "article_id", "chunk", "last_updated", deleted.alias("deleted")).where("chunk_id IS NOT NULL")
    newest = Window.partitionBy("chunk_id").orderBy(F.col("last_updated").desc_nulls_last(), F.col("deleted").desc(), F.hash("chunk"), "chunk")
    one = rows.withColumn("_no", F.row_number().over(newest)).where("_no = 1").drop("_no")
    gone = one.where("deleted").withColumn("embedding", F.lit(None).cast("array<float>"))
    live = embed_chunks(one.where("NOT deleted"), "chunk", dim, encoder=encoder)
    # batches of all producers are numbered in the order they are prepared; equal numbers differ by time or chunk
    number = content.get("batches", 0)
    kept = live.unionByName(gone).select("chunk_id", "article_id", "last_updated", "deleted",
                                         _version(F.col("last_updated"), number).alias("version"), "embedding",
                                         F.pmod(F.xxhash64("chunk_id"), F.lit(content.get("buckets", BUCKETS))).cast("int").alias("bucket"))
    folder = f"delta={batch}-{uuid.uuid4().hex[:12]}"
    kept.write.partitionBy("bucket").parquet(f"{path}/{folder}")

    def add(now: dict) -> dict | None:
        if now.get("applied", {}).get(producer, -1) >= batch:
            return None
        return {"buckets": now.get("buckets", BUCKETS), "base": now.get("base", {}), "deltas": now.get("deltas", []) + [folder],
                "batches": now.get("batches", 0) + 1, "applied": now.get("applied", {}) | {producer: batch}}

    return folder in manifest.update(spark, path, add)["deltas"]


def _read(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], f"{ROWS}, bucket int")
    return (spark.read.schema(f"{ROWS}, bucket int").option("basePath", path).parquet(*[f"{path}/{f}" for f in folders])
            .select(*[f.split()[0] for f in ROWS.split(", ")], "bucket"))


def _merged(spark: SparkSession, path: str, content: dict, buckets: list[int] | None = None) -> DataFrame:
    """The newest version of every chunk, tombstones included.

    Winners are found on ids and versions (a hash aggregate over the deltas); vectors are joined to them, and the
    base is only asked which of its chunks are older than a delta.
    """
    def in_buckets(df: DataFrame) -> DataFrame:
        return df if buckets is None else df.where(F.col("bucket").isin(buckets))

    deltas = in_buckets(_read(spark, path, content.get("deltas", [])))
    base = _read(spark, path, sorted(f"{folder}/bucket={b}" for b, folder in content.get("base", {}).items()
                                     if buckets is None or int(b) in buckets))
    newest = deltas.groupBy("chunk_id").agg(F.max("version").alias("version"))
    older = base.select("chunk_id", F.col("version").alias("_base"))
    wins = (newest.join(older, "chunk_id", "left").where(F.col("_base").isNull() | (F.col("_base") < F.col("version")))
            .select("chunk_id", "version"))
    fresh = deltas.join(wins, ["chunk_id", "version"], "left_semi").dropDuplicates(["chunk_id"])
    return base.join(wins.select("chunk_id"), "chunk_id", "left_anti").unionByName(fresh)


def read_embedding_table(spark: SparkSession, path: str) -> DataFrame:
    """chunk_id, article_id, last_updated, embedding of every chunk that is there now."""
    _, content = manifest.latest(spark, path)
    return _merged(spark, path, content).where("NOT deleted").select("chunk_id", "article_id", "last_updated", "embedding")


def compact(spark: SparkSession, path: str) -> bool:
    """Merge the open deltas into the base of their buckets; False if there were none or another compaction came first."""
    _, content = manifest.latest(spark, path)
    deltas = content.get("deltas", [])
    if not deltas:
        return False
    touched = sorted(r[0] for r in _read(spark, path, deltas).select("bucket").distinct().collect())  # at most one row a bucket
    folder = f"base={uuid.uuid4().hex[:12]}"
    if touched:
        (_merged(spark, path, content, touched).repartitionByRange("bucket", "chunk_id").sortWithinPartitions("bucket", "chunk_id")
         .write.partitionBy("bucket").parquet(f"{path}/{folder}"))
    done = [False]

    def swap(now: dict) -> dict | None:
        done[0] = now["base"] == content["base"] and now["deltas"][:len(deltas)] == deltas
        if not done[0]:
            return None
        return now | {"base": now["base"] | {str(b): folder for b in touched}, "deltas": now["deltas"][len(deltas):]}

    manifest.update(spark, path, swap)
    return done[0]


def start_embedding_table(changes: DataFrame, path: str, checkpoint: str, dim: int = EMBED_DIM, compact_every: int = 20,
                          available_now: bool = True, interval: str | None = None) -> StreamingQuery:
    """Keep the table in step with a stream of changes; a retried micro-batch counts once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        apply_changes(batch, path, batch_id, producer=checkpoint, dim=dim)
        if len(manifest.latest(spark, path)[1].get("deltas", [])) >= compact_every:
            compact(spark, path)

    w = changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval or "1 second")).start()
