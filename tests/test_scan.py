from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.plans.scan import lag_columns, running_sum_and_peak


def _skewed(spark):
    # one key holds most rows; values go up and down
    rows = [("hot", i, (i * 37) % 11 - 5) for i in range(2000)] + [(f"k{j}", i, (i * j) % 7 - 3)
                                                                     for j in range(20) for i in range(15)]
    return spark.createDataFrame(rows, "k string, t long, v long")


def test_running_sum_and_peak_match_window(spark):
    df = _skewed(spark)
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumn("s", F.sum("v").over(w)).withColumn("p", F.max("s").over(w))
    got = running_sum_and_peak(df, ["k"], ["t"], ["v"], num_partitions=13)
    j = got.join(ref, ["k", "t"])
    assert j.count() == df.count()
    assert j.filter((F.col("_sum_v") != F.col("s")) | (F.col("_peak_v") != F.col("p"))).count() == 0


def test_lag_matches_window_and_spreads_hot_key(spark):
    df = _skewed(spark)
    ref = df.withColumn("prev", F.lag("v").over(Window.partitionBy("k").orderBy("t")))
    got = lag_columns(df, ["k"], ["t"], ["v"], num_partitions=13)
    j = got.join(ref, ["k", "t"])
    assert j.filter(~F.col("_prev_v").eqNullSafe(F.col("prev"))).count() == 0
    # the hot key is spread over several range partitions
    parts = df.repartitionByRange(13, "k", "t").filter("k = 'hot'").select(F.spark_partition_id()).distinct().count()
    assert parts > 3


def test_scans_across_many_arrow_batches(spark):
    # tiny Arrow batches: runs continue across batch boundaries inside a partition
    df = _skewed(spark)
    w = Window.partitionBy("k").orderBy("t")
    wr = w.rowsBetween(Window.unboundedPreceding, 0)
    ref = (df.withColumn("prev", F.lag("v").over(w)).withColumn("s", F.sum("v").over(wr))
           .withColumn("p", F.max("s").over(wr)))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        lagged = lag_columns(df, ["k"], ["t"], ["v"], num_partitions=5)
        summed = running_sum_and_peak(df, ["k"], ["t"], ["v"], num_partitions=5)
        j = lagged.join(summed, ["k", "t", "v"]).join(ref, ["k", "t", "v"])
        assert j.count() == df.count()
        bad = j.filter(~F.col("_prev_v").eqNullSafe(F.col("prev")) | (F.col("_sum_v") != F.col("s"))
                       | (F.col("_peak_v") != F.col("p")))
        assert bad.count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_scan_plan_has_one_full_shuffle(spark):
    # the rows are range-partitioned once; no hash exchange on (partition, key) follows
    df = _skewed(spark)
    got = running_sum_and_peak(df, ["k"], ["t"], ["v"], num_partitions=6)
    got.write.format("noop").mode("overwrite").save()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_scan_pid" not in "".join(l for l in plan.splitlines() if "Exchange hashpartitioning" in l), plan
