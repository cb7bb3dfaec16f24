"""Skew-safe ordered scans per key (previous row, running sums).

A plain ``Window.partitionBy(key).orderBy(t)`` sends every row of a key to one task,
so a key holding a third of the data becomes a third of the job in one task.  Here
the rows are range-partitioned on ``(key, order)`` instead (one shuffle), so a hot
key is spread over many consecutive partitions, and sorted within each partition.

Each task then scans its partition in order (``mapInArrow``: numpy over Arrow
batches, columns passed through untouched) and computes the values within each run
of equal keys.  A window over (partition, key) would need a second full shuffle,
because Spark cannot know that the range-partitioned rows are already clustered.
The task also appends up to two summary rows: the end state of its first and of its
last key run.  Only those runs can continue across a partition boundary (keys are
contiguous in the range order), so the carry into each partition comes from a table
of at most two rows per partition, and the carry table, at most one row per
partition, is broadcast.

The scanned rows are written once as parquet to the shared checkpoint folder: the
range bounds come from sampling and would differ if the plan ran twice, and both
the summaries (a pushed-down filter reading a few columns) and the rows read the
same files.  This also cuts lineage.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterator, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, DoubleType, IntegerType, IntegralType, LongType, StructField,
                               StructType)

_PID = "_scan_pid"
_KIND = "_scan_kind"    # 0 = row, 1 = summary of a key run at a partition boundary
_START = "_scan_start"  # first row of its key run within the partition
_POS = "_scan_pos"      # row position within the partition (0, 1, ...)
# ``_PID << _POS_BITS | _POS`` is one long that follows the (key, order) sort across partitions
_POS_BITS = 40


def _num_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _run_starts(batch, keys: Sequence[str], prev_key):
    """Boolean numpy mask: row starts a new run of equal keys (NULL equals NULL)."""
    import numpy as np
    import pyarrow.compute as pc

    n = batch.num_rows
    start = np.zeros(n, dtype=bool)
    for k in keys:
        a = batch.column(k)
        if n > 1:
            cur, prev = a.slice(1), a.slice(0, n - 1)
            differ = pc.or_(pc.fill_null(pc.not_equal(cur, prev), False), pc.xor(pc.is_null(cur), pc.is_null(prev)))
            start[1:] |= differ.to_numpy(zero_copy_only=False)
    first = tuple(batch.column(k)[0].as_py() for k in keys)
    start[0] = prev_key is None or first != prev_key
    return start


def _scan_partitions(keys: Sequence[str], sums: Sequence[str], lags: Sequence[str], sum_types: dict):
    """mapInArrow body: per-run running sums / peaks / previous values, plus boundary summaries."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd
        import pyarrow as pa
        import pyarrow.compute as pc

        prev_key = None                  # key of the run left open by the previous batch
        run_no = -1                      # index of that run in this partition (-1: none yet)
        st_sum = {c: 0 for c in sums}    # its running sums, peaks and last values
        st_peak = {c: None for c in sums}
        st_last = {c: None for c in lags}
        first_run = None                 # end state of the partition's first run, once it ended
        arrow_schema, pid = None, None
        seen = 0                         # rows of this partition before the current batch

        def state():
            return {"key": prev_key, "sum": dict(st_sum), "peak": dict(st_peak), "last": dict(st_last)}

        for b in batches:
            n = b.num_rows
            if n == 0:
                continue
            pid = b.column(_PID)[0].as_py()
            start = _run_starts(b, keys, prev_key)
            gid = np.cumsum(start)       # 0 = rows continuing the open run, g = the g-th run started here
            if start[0] and run_no == 0:
                first_run = state()      # the first run ended with the previous batch
            ridx = run_no + gid          # run index within the partition
            zero = np.flatnonzero(ridx == 0)
            ends_first = int(zero[-1]) if len(zero) and ridx[-1] >= 1 else None
            cols = {}
            for c in sums:
                v = pc.fill_null(b.column(c), 0).to_numpy(zero_copy_only=False).astype(sum_types[c])
                # per-run sums added in row order (as a window sum does); the open run continues
                local = pd.Series(v).groupby(gid).cumsum().to_numpy()
                if not start[0]:
                    local[gid == 0] += st_sum[c]
                peak = pd.Series(local).groupby(gid).cummax().to_numpy()
                if not start[0] and st_peak[c] is not None:
                    cont = gid == 0
                    peak[cont] = np.maximum(peak[cont], st_peak[c])
                cols[f"_ls_{c}"] = pa.array(local)
                cols[f"_lp_{c}"] = pa.array(peak)
            for c in lags:
                a = b.column(c)
                head = pa.array([None if start[0] else st_last[c]], type=a.type)
                shifted = pa.concat_arrays([head, a.slice(0, n - 1)]) if n > 1 else head
                cols[f"_ll_{c}"] = pc.if_else(pa.array(start), pa.nulls(n, type=a.type), shifted)
            if ends_first is not None:
                i = ends_first
                first_run = {"key": tuple(b.column(k)[i].as_py() for k in keys),
                             "sum": {c: cols[f"_ls_{c}"][i].as_py() for c in sums},
                             "peak": {c: cols[f"_lp_{c}"][i].as_py() for c in sums},
                             "last": {c: b.column(c)[i].as_py() for c in lags}}
            run_no = int(ridx[-1])
            prev_key = tuple(b.column(k)[n - 1].as_py() for k in keys)
            for c in sums:
                st_sum[c] = cols[f"_ls_{c}"][n - 1].as_py()
                st_peak[c] = cols[f"_lp_{c}"][n - 1].as_py()
            for c in lags:
                st_last[c] = b.column(c)[n - 1].as_py()
            cols[_KIND] = pa.array(np.zeros(n, dtype=np.int8))
            cols[_START] = pa.array(start)
            cols[_POS] = pa.array(np.arange(seen, seen + n, dtype=np.int64))
            seen += n
            names = list(b.schema.names) + [k for k in cols]
            out = pa.RecordBatch.from_arrays([b.column(x) for x in b.schema.names] + list(cols.values()), names=names)
            arrow_schema = arrow_schema or out.schema
            yield out
        if arrow_schema is None:
            return
        # boundary summaries: the first run (if it ended) and the run still open at the end
        summaries = ([first_run] if first_run is not None else []) + [state()]
        values = {f.name: [] for f in arrow_schema}
        for sm in summaries:
            for name in values:
                v = None
                if name in keys:
                    v = sm["key"][list(keys).index(name)]
                elif name == _PID:
                    v = pid
                elif name == _KIND:
                    v = 1
                elif name.startswith("_ls_") and name[4:] in sums:
                    v = sm["sum"][name[4:]]
                elif name.startswith("_lp_") and name[4:] in sums:
                    v = sm["peak"][name[4:]]
                elif name in lags:
                    v = sm["last"][name]
                values[name].append(v)
        yield pa.RecordBatch.from_arrays([pa.array(values[f.name], type=f.type) for f in arrow_schema],
                                         schema=arrow_schema)

    return run


def _scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Sequence[str], lags: Sequence[str],
          n: int | None) -> tuple[DataFrame, DataFrame]:
    """Range-partition, scan each partition in order; return (rows, boundary summaries)."""
    from quarry.session import materialize

    parts = _num_partitions(df, n)
    sum_types = {}
    for c in sums:
        sum_types[c] = "int64" if isinstance(df.schema[c].dataType, IntegralType) else "float64"
    extra = [StructField(_PID, IntegerType())]
    for c in sums:
        t = LongType() if sum_types[c] == "int64" else DoubleType()
        extra += [StructField(f"_ls_{c}", t), StructField(f"_lp_{c}", t)]
    extra += [StructField(f"_ll_{c}", df.schema[c].dataType) for c in lags]
    extra += [StructField(_KIND, ByteType()), StructField(_START, BooleanType()), StructField(_POS, LongType())]
    out_schema = StructType([StructField(f.name, f.dataType, True) for f in df.schema.fields] + extra)
    ordered = (df.repartitionByRange(parts, *[F.col(c) for c in [*keys, *order]])
               .sortWithinPartitions(*[F.col(c) for c in [*keys, *order]])
               .withColumn(_PID, F.spark_partition_id()))
    scanned = ordered.mapInArrow(_scan_partitions(keys, sums, lags, sum_types), out_schema)
    written = materialize(scanned, "ordered-scan")
    return written.filter(F.col(_KIND) == 0), written.filter(F.col(_KIND) == 1)


def _join_carry(local: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = carry.select(*[F.col(c).alias(f"_c_{c}") for c in [_PID, *keys]],
                           *[c for c in carry.columns if c not in (_PID, *keys)])
    cond = reduce(lambda a, b: a & b,
                  [local[_PID] == renamed[f"_c_{_PID}"]]
                  + [local[k].eqNullSafe(renamed[f"_c_{k}"]) for k in keys])
    # at most one carry row per partition -> bounded broadcast
    joined = local.join(F.broadcast(renamed), cond, "left")
    return joined.drop(*[f"_c_{c}" for c in [_PID, *keys]])


def lag_columns(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
                num_partitions: int | None = None) -> DataFrame:
    """Add ``_prev_<c>``: the value of ``c`` in the previous row of the same key by ``order``.

    ``order`` should identify a row within its key (add a tiebreak column otherwise).
    """
    rows, summ = _scan(df, keys, order, [], cols, num_partitions)
    wk = Window.partitionBy(*keys).orderBy(_PID)
    carry = (summ.select(_PID, *keys, F.lag(F.struct(*[F.col(c) for c in cols])).over(wk).alias("_carry"),
                         F.row_number().over(wk).alias("_segno"))
             .filter(F.col("_segno") > 1).drop("_segno"))
    out = _join_carry(rows, carry, keys)
    prev = [F.when(F.col(_START), F.col(f"_carry.{c}")).otherwise(F.col(f"_ll_{c}")).alias(f"_prev_{c}")
            for c in cols]
    return out.select(*df.columns, *prev)


def running_sum_and_peak(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
                         num_partitions: int | None = None, with_order: bool = False) -> DataFrame:
    """For each ``c`` add ``_sum_<c>`` (inclusive running sum per key) and ``_peak_<c>``
    (running maximum of that running sum).  NULL values count as 0.  With ``with_order``
    also ``_order``: one long increasing along (key, order), so later aggregates can pick
    first / last rows with primitive ``min_by`` / ``max_by`` (hash aggregation, no sort).

    Per boundary run the summary is (total, peak of the local running sum); the carry
    into a run is the sum of the earlier totals of its key and the best earlier peak
    (``in_{s'} + P_{s'}``), both computed on the small summary table.
    """
    rows, summ = _scan(df, keys, order, cols, [], num_partitions)
    wk = Window.partitionBy(*keys).orderBy(_PID)
    before = wk.rowsBetween(Window.unboundedPreceding, -1)
    seg = summ.select(_PID, *keys, *[F.col(f"_ls_{c}").alias(f"_S_{c}") for c in cols],
                      *[F.col(f"_lp_{c}").alias(f"_P_{c}") for c in cols])
    seg = seg.select("*", F.row_number().over(wk).alias("_segno"),
                     *[F.sum(f"_S_{c}").over(before).alias(f"_in_{c}") for c in cols])
    seg = seg.select("*", *[F.max(F.coalesce(F.col(f"_in_{c}"), F.lit(0)) + F.col(f"_P_{c}")).over(before)
                            .alias(f"_cpeak_{c}") for c in cols])
    carry = seg.filter(F.col("_segno") > 1).select(
        _PID, *keys, *[F.col(f"_in_{c}") for c in cols], *[F.col(f"_cpeak_{c}") for c in cols])
    out = _join_carry(rows, carry, keys)
    sums = [(F.col(f"_ls_{c}") + F.coalesce(F.col(f"_in_{c}"), F.lit(0))).alias(f"_sum_{c}") for c in cols]
    peaks = [F.greatest(F.col(f"_cpeak_{c}"), F.col(f"_lp_{c}") + F.coalesce(F.col(f"_in_{c}"), F.lit(0)))
             .alias(f"_peak_{c}") for c in cols]
    extra = [(F.col(_PID).cast("long") * F.lit(1 << _POS_BITS) + F.col(_POS)).alias("_order")] if with_order else []
    return out.select(*df.columns, *sums, *peaks, *extra)


def dense_ids(df: DataFrame, order: Sequence[str], start: int = 1, col: str = "id",
              num_partitions: int | None = None) -> DataFrame:
    """Consecutive ids in ``order`` without a single-partition window.

    Range-partition on ``order``; ``monotonically_increasing_id`` then holds the
    partition index (high bits) and the row's position in it (low 33 bits).  Per
    partition counts (one row per partition) give the offsets.
    """
    from quarry.session import materialize

    parts = _num_partitions(df, num_partitions)
    # pinned: the sampled range bounds and the row positions must not change between branches;
    # the per-partition counts then read one column of the written rows
    r = materialize(df.repartitionByRange(parts, *[F.col(c) for c in order]).sortWithinPartitions(*order)
                    .withColumn("_mid", F.monotonically_increasing_id()), "dense-ids")
    r = r.withColumn("_part", F.shiftright("_mid", 33)).withColumn("_pos", F.col("_mid").bitwiseAND((1 << 33) - 1))
    counts = r.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1))).alias("_off"))
    out = r.join(F.broadcast(offsets), "_part")
    return out.select(*df.columns, (F.coalesce(F.col("_off"), F.lit(0)) + F.col("_pos") + F.lit(start)).alias(col))
