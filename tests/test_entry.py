import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from quarry.plans.registry import QUERIES  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["object_name", "mb_used", "object_mb", "object_pct", "buffer_pct"]
    assert df.count() > 0


def test_every_registered_key_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql()) and set(QUERIES) <= set(queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_nested_loop_or_cartesian_join(spark, key):
    df = queries()[key](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan, plan


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_oracle_sf0001(spark, duck, key):
    sdf = queries()[key](spark, SF)
    res = duck.execute(oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert rows_of(sdf.columns, [tuple(r) for r in sdf.collect()]) == rows_of(dcols, res.fetchall())
