"""A sensor log clustered on two dimensions: place and time.

Both columns become ranks among split points of the batch, and the bits of the two ranks are interleaved (Z-order), so a
file or row group covers a small rectangle of (location, reading_date) and its min / max statistics rule it out for most
lookups of either kind.  Files carry Parquet Bloom filters on the location, where it has no dictionary
(a dictionary serves the reader likewise).  Split points only shape the files: every
row is written, and any reader of Parquet gets the log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 6  # 2^6 ranks a dimension
SAMPLE = 4096  # rows whose locations give the split points


def _rank(value: Column, points: list) -> Column:
    """How many split points are not above the value; a missing value ranks first."""
    if not points:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(F.array(*[F.lit(p) for p in points]), lambda p: p <= value)), F.lit(0))


def _interleave(x: Column, y: Column, bits: int) -> Column:
    code = F.lit(0)
    for i in range(bits):
        for at, axis in ((2 * i, x), (2 * i + 1, y)):
            code = code.bitwiseOR(F.shiftleft(F.shiftright(axis, i).bitwiseAND(F.lit(1)), at))
    return code


def _micros(date: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), date)


def split_points(batch: DataFrame, location: str = "location", date: str = "reading_date", bits: int = BITS) -> tuple[list, list]:
    """At most 2^bits - 1 distinct split points of each dimension, at equal shares of the rows.

    Dates come from a quantile sketch; locations from the SAMPLE rows whose hashes are smallest.  A location with
    many rows fills several shares, so it is a rank of its own and its rows are told apart by date.
    """
    share = [i / 2 ** bits for i in range(1, 2 ** bits)]
    dates = batch.agg(F.percentile_approx(_micros(F.col(date)), share, 10000)).first()[0] or []
    drawn = batch.select(location, F.xxhash64(location, date).alias("h")).where(F.col(location).isNotNull()).orderBy("h").limit(SAMPLE)
    found = sorted(r[0] for r in drawn.collect())  # SAMPLE rows at most
    places = [found[int(s * len(found))] for s in share] if found else []
    return sorted(set(places)), sorted(set(dates))


def write_log_clustered(batch: DataFrame, path: str, location: str = "location", date: str = "reading_date", bits: int = BITS,
                        files: int | None = None) -> None:
    """Append one batch to the log at ``path`` in Z-order of (location, date), in about ``files`` files.

    Files are ranges of (Z-order, location, date), so a hot location is spread over many.
    """
    places, dates = split_points(batch, location, date, bits)
    z = _interleave(_rank(F.col(location), places), _rank(_micros(F.col(date)), dates), bits)
    by = ["_z", location, date]
    rows = batch.withColumn("_z", z)
    rows = rows.repartitionByRange(files, *by) if files else rows.repartitionByRange(*by)
    (rows.sortWithinPartitions(*by).drop("_z").write.mode("append")
     .option(f"parquet.bloom.filter.enabled#{location}", "true").option("parquet.bloom.filter.adaptive.enabled", "true").parquet(path))


def row_group_bounds(spark: SparkSession, path: str, location: str = "location", date: str = "reading_date") -> DataFrame:
    """(file, row_group, rows, first_location, last_location, first_date, last_date) of every row group, read
    from the footers by tasks of a few files each."""
    import pandas as pd

    names = spark.read.format("binaryFile").load(path).select("path")  # the content column is not read

    def footers(batches):
        import pyarrow.parquet as pq
        from pyarrow import fs

        for frame in batches:
            out = []
            for name in frame["path"]:
                store, inner = fs.FileSystem.from_uri(name)
                with store.open_input_file(inner) as f:
                    meta = pq.ParquetFile(f).metadata
                    at = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
                    for g in range(meta.num_row_groups):
                        group = meta.row_group(g)
                        place, day = group.column(at[location]), group.column(at[date])
                        p, d = place.statistics, day.statistics
                        out.append((name, g, group.num_rows, p.min if p and p.has_min_max else None, p.max if p and p.has_min_max else None,
                                    d.min if d and d.has_min_max else None, d.max if d and d.has_min_max else None))
            yield pd.DataFrame(out, columns=["file", "row_group", "rows", "first_location", "last_location", "first_date", "last_date"])

    schema = ("file string, row_group int, rows long, first_location string, last_location string, "
              "first_date timestamp_ntz, last_date timestamp_ntz")
    return names.mapInPandas(footers, schema)


def groups_to_read(bounds: DataFrame, place: str | None = None, since=None, until=None) -> DataFrame:
    """How many of the row groups a lookup of a location and of dates in [since, until) has to read: (groups, to_read)."""
    hit = F.lit(True)
    if place is not None:
        hit = hit & F.lit(place).between(F.col("first_location"), F.col("last_location"))
    if since is not None:
        hit = hit & (F.col("last_date") >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        hit = hit & (F.col("first_date") < F.lit(until).cast("timestamp_ntz"))
    return bounds.agg(F.count("*").alias("groups"), F.count_if(hit).alias("to_read"))
