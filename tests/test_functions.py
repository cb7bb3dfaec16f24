from pyspark.sql import functions as F

from quarry.functions import lsn_diff, lsn_to_bytes, round_ratio, round_to_second, whole_seconds_between


def test_lsn_goldens(spark):
    df = spark.createDataFrame([("16/B374D848", "0/0"), (None, "0/0"), ("0/10", "0/20"), ("FFFFFFFF/FFFFFFFF", "FFFFFFFF/0")],
                               "a string, b string")
    got = [r[0] for r in df.select(lsn_diff(F.col("a"), F.col("b"))).collect()]
    assert got == [97500059720, None, -16, 4294967295]
    assert df.select(lsn_to_bytes("a")).first()[0] == 97500059720


def test_round_ratio_half_up_exact(spark):
    df = spark.createDataFrame([(2, 3), (1, 8), (1, 32), (5, 0), (267500, 100000)], "n long, d long")
    got = [r[0] for r in df.select(round_ratio(F.col("n") * 100, F.col("d"))).collect()]
    assert got == [66.67, 12.5, 3.13, None, 267.5]


def test_seconds_rounding(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00.500000", "2024-01-01 00:00:00"),
                                ("2024-01-01 00:00:00.499999", "2024-01-01 00:00:00"),
                                ("2024-01-01 00:00:00", "2024-01-01 00:00:01.5")], "a string, b string")
    df = df.select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    assert [r[0] for r in df.select(whole_seconds_between("a", "b")).collect()] == [1, 0, -2]
    got = [str(r[0]) for r in df.select(round_to_second("a")).collect()]
    assert got == ["2024-01-01 00:00:01", "2024-01-01 00:00:00", "2024-01-01 00:00:00"]


def test_round_to_second_is_wall_clock(spark):
    from quarry.functions.scalar import round_to_second

    df = spark.sql("""SELECT * FROM VALUES (timestamp_ntz'2024-03-10 02:30:00.4'), (timestamp_ntz'2024-12-31 23:59:59.5'),
                      (timestamp_ntz'2024-01-01 10:00:00.499999') AS t(g)""")
    got = [r[0] for r in df.select(round_to_second("g").cast("string")).collect()]
    assert got == ["2024-03-10 02:30:00", "2025-01-01 00:00:00", "2024-01-01 10:00:00"]
    assert dict(df.select(round_to_second("g").alias("r")).dtypes)["r"] == "timestamp_ntz"


def test_xid_age_wraps_and_special_ids(spark):
    from pyspark.sql import functions as F

    from quarry.functions.scalar import xid_age

    rows = [(1000, 400), (5, 4294967290), (2, 400), (0, 400), (None, 400), (4294967000, 100)]
    df = spark.createDataFrame(rows, "xid long, cur long")
    got = [r[0] for r in df.select(xid_age(F.col("xid"), F.col("cur"))).collect()]
    # behind the current id -> negative; across the wrap -> small positive; special ids -> int32 max
    assert got == [-600, -11, 2147483647, 2147483647, None, 396]


def test_needs_vacuum_from_relfrozenxid(spark):
    from quarry.operators.forensics import needs_vacuum

    cls = spark.createDataFrame([(1, "old", "r", None, 100), (2, "young", "r", None, 900), (3, "frozen", "m", None, 2)],
                                "oid long, relname string, relkind string, reltoastrelid long, relfrozenxid long")
    got = [(r.table_name, r.age) for r in needs_vacuum(cls, max_age=1000, current_xid=1100).collect()]
    assert got == [("old", 1000), ("frozen", 2147483647)]


def test_integer_arithmetic_beyond_doubles(spark):
    from quarry.functions.scalar import floor_div

    df = spark.createDataFrame([(9007199254740993, 90071992547409931), (-7, 0), (None, None)], "x long, n long")
    assert [r[0] for r in df.select(floor_div("x", 1)).collect()] == [9007199254740993, -7, None]
    assert [r[0] for r in df.select(floor_div("x", 2)).collect()] == [4503599627370496, -4, None]
    got = [r[0] for r in df.select(round_ratio(F.col("n"), F.lit(100), 0)).collect()]
    assert got == [900719925474099.0, 0.0, None]
