import datetime as dt
import os
import tempfile

from quarry.operators.sensor import log_lookup, log_window
from quarry.sources.clustered_log import groups_to_read, row_group_bounds, split_points, write_log_clustered

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id long, location string, reading long, reading_date timestamp_ntz"


def log(spark, n, place="concat('A', cast(pmod(xxhash64(id), 200) as string))"):
    return spark.range(n).selectExpr("id", f"{place} AS location", "id % 97 AS reading",
                                     "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, pmod(xxhash64(id, 7), 2592000)) AS reading_date")


def written(df, **options):
    path = tempfile.mkdtemp(prefix="clustered-") + "/log"
    write_log_clustered(df, path, **options)
    return path


def test_lookups_by_place_and_by_time_skip_nine_of_ten_row_groups(spark):
    rows = log(spark, 120_000)
    path = written(rows, files=400)
    back = spark.read.parquet(path)
    assert back.count() == 120_000 and back.exceptAll(rows).isEmpty()
    bounds = row_group_bounds(spark, path)
    for wanted in ({"place": "A17"}, {"since": "2024-01-10", "until": "2024-01-10 06:00:00"}):
        r = groups_to_read(bounds, **wanted).first()
        assert r["groups"] >= 300 and r["to_read"] <= r["groups"] / 10, (wanted, r)
    place = log_lookup(back, "A17")
    assert place.exceptAll(rows.where("location = 'A17'").select(place.columns)).isEmpty() and place.count() > 400
    week = log_window(back, since="2024-01-10", until="2024-01-11")
    assert week.count() == rows.where("reading_date >= '2024-01-10' AND reading_date < '2024-01-11'").count()
    plan = week._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(reading_date" in plan and "LessThan(reading_dat" in plan


def test_a_place_with_a_third_of_the_rows_is_spread(spark):
    rows = log(spark, 60_000, "CASE WHEN id % 3 = 0 THEN 'HOT' ELSE concat('A', cast(pmod(xxhash64(id), 200) as string)) END")
    path = written(rows, files=100)
    bounds = row_group_bounds(spark, path)
    assert bounds.agg({"rows": "max"}).first()[0] < 3 * 600
    r = groups_to_read(bounds, place="HOT", since="2024-01-10", until="2024-01-10 06:00:00").first()
    assert r["to_read"] <= r["groups"] / 10


def test_bloom_filters_are_written_where_places_have_no_dictionary(spark):
    rows = log(spark, 50_000, "sha2(cast(id as string), 256)")  # all different
    plain = tempfile.mkdtemp(prefix="plain-") + "/log"
    path = written(rows, files=1)
    spark.read.parquet(path).coalesce(1).write.parquet(plain)
    size = [os.path.getsize(spark.read.parquet(p).inputFiles()[0].removeprefix("file://")) for p in (path, plain)]
    assert size[0] > size[1] + 30_000  # a filter of 50,000 values
    assert log_lookup(spark.read.parquet(path), rows.first()["location"]).count() == 1


def test_missing_values_empty_batches_and_appends(spark):
    rows = spark.createDataFrame([(1, None, 1, T0), (2, "a", 1, None), (3, "a", 2, T0), (3, "a", 2, T0), (4, None, None, None)], SCHEMA)
    path = written(rows)
    write_log_clustered(rows, path)
    assert spark.read.parquet(path).count() == 10
    assert [r["id"] for r in log_window(spark.read.parquet(path), "a").collect()] == [3, 3, 3, 3, 2, 2]
    empty = written(rows.limit(0))
    assert log_window(spark.read.schema(SCHEMA).parquet(empty), since="2024-01-01").count() == 0
    assert split_points(rows.limit(0)) == ([], [])
