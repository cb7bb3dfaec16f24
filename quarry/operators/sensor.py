"""Append log of sensor readings with ordered lookup by location.

sensor_log(id, location, reading, reading_date).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def log_lookup(log: DataFrame, location: str) -> DataFrame:
    """All readings of one location, oldest first (ties by id).

    The equality filter reaches the parquet scan (row groups skipped by min/max when
    the log is written clustered by location, see ``sources.logs.write_log``); the
    sort is a range-partitioned global sort, so a location holding most rows is still
    spread over many tasks.
    """
    return (log.filter(F.col("location") == F.lit(location))
            .select("id", "location", "reading", "reading_date")
            .orderBy(F.col("reading_date").asc_nulls_last(), "id"))


def log_window(log: DataFrame, location: str | None = None, since=None, until=None) -> DataFrame:
    """Readings dated in [since, until), of one location or of all, oldest first (ties by location and id).

    Both conditions reach the parquet scan; a log written by ``sources.clustered_log`` skips row groups by either.
    """
    if location is not None:
        log = log.filter(F.col("location") == F.lit(location))
    if since is not None:
        log = log.filter(F.col("reading_date") >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        log = log.filter(F.col("reading_date") < F.lit(until).cast("timestamp_ntz"))
    return (log.select("id", "location", "reading", "reading_date")
            .orderBy(F.col("reading_date").asc_nulls_last(), "location", "id"))
