import datetime as dt
import tempfile

from quarry.operators.sensor import log_lookup
from quarry.sources.logs import write_log


def test_lookup_pushes_filter_and_orders(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, f"A{i % 5}", i, t0 + dt.timedelta(seconds=(37 * i) % 101)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, location string, reading long, reading_date timestamp_ntz")
    path = tempfile.mkdtemp(prefix="sensor-") + "/log"
    write_log(df, path)
    out = log_lookup(spark.read.parquet(path), "A3")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(location), EqualTo(location,A3)]" in plan
    got = [(r.reading_date, r.id) for r in out.collect()]
    assert len(got) == 100 and got == sorted(got)
