"""Append-only logs (batch form); the streaming form is ``quarry.streaming.append_log``."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_log(batch: DataFrame, path: str, cluster_by: str = "location", order_by: str = "reading_date") -> None:
    """Append one batch atomically (a failed job leaves no partial files visible to readers
    of the committed output), clustered by ``cluster_by`` so equality lookups skip row groups."""
    (batch.repartitionByRange(cluster_by, order_by).sortWithinPartitions(cluster_by, order_by)
     .write.mode("append").parquet(path))


def scan_snapshot(spark, path: str, view: str | None = None) -> DataFrame:
    """Read a system-snapshot table written as parquet; optionally register a temp view."""
    df = spark.read.parquet(path)
    if view:
        df.createOrReplaceTempView(view)
    return df
