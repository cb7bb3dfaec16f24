"""Operational forensics over system snapshots: buffers, I/O, locks, age, replication, layout.

Each function takes snapshot tables (DataFrames with the columns listed in the
docstring) and returns a DataFrame; ``now`` / ``current_lsn`` are parameters so
results are reproducible.  Interval results are returned as seconds.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import (
    lsn_diff,
    micros_between,
    round_ratio,
    round_to_second,
    whole_seconds_between,
    xid_age,
)
from quarry.session import materialize

# Schemas hidden from the buffer and layout reports.
BUFFER_HIDDEN_SCHEMAS = ("pg_catalog", "information_schema", "pg_toast")
LAYOUT_HIDDEN_SCHEMAS = ("pg_catalog", "information_schema")
VACUUM_KINDS = ("r", "m", "p")
LAYOUT_KINDS = ("r", "p")
VACUUM_ALERT_RATIO = 0.9
BLOCK_BYTES = 8192


def _spread(df: DataFrame):
    """Final sort tiebreak: a hash of the whole row.  The range partitioner of a global
    sort keeps equal keys together; rows tied on the sort key (unordered in the
    original) are spread over tasks by it instead of landing in one."""
    return F.xxhash64(*[F.col(c) for c in df.columns])


def _now(now):
    if now is None:
        return F.localtimestamp()
    return F.lit(now).cast("timestamp_ntz") if isinstance(now, str) else now


def sessions(activity: DataFrame) -> DataFrame:
    """Every row and column of the session snapshot (``SELECT *``)."""
    return activity.select("*")


def object_name(nspname, relname):
    """Name as a catalog cast prints it: bare in ``public``, schema-qualified elsewhere."""
    return F.when(nspname == "public", relname).otherwise(F.concat_ws(".", nspname, relname))


def buffer_usage(buffercache: DataFrame, pg_class: DataFrame, namespace: DataFrame) -> DataFrame:
    """Share of shared buffers held by each relation.

    Inputs: buffercache(relfilenode), class(oid, relname, relnamespace, relfilenode, relpages),
    namespace(oid, nspname).  Output: object_name, mb_used, object_mb, object_pct, buffer_pct.

    Buffers are counted per relfilenode before the join (one row per file instead of one
    per buffer crosses the shuffle); the join then fans out over duplicate relfilenodes as
    the original does.  The percentage denominator is the total over surviving objects,
    a scalar subquery instead of a single-partition window; it reuses the shuffle of the
    per-file counts, so the buffers are scanned once.
    """
    per_file = buffercache.groupBy("relfilenode").agg(F.count(F.lit(1)).alias("n_buffers"))
    ns = (namespace.filter(~F.col("nspname").isin(*BUFFER_HIDDEN_SCHEMAS))
          .select(F.col("oid").alias("ns_oid"), "nspname"))
    cls = (pg_class.filter(F.col("relpages") > 0)
           .select("oid", "relname", "relnamespace", "relfilenode", "relpages")
           .join(ns, F.col("relnamespace") == F.col("ns_oid")))
    per_object = (per_file.join(cls, "relfilenode")
                  .groupBy("oid", "relpages", "nspname", "relname")
                  .agg(F.sum("n_buffers").alias("n")))
    total = per_object.select(F.sum("n")).scalar()
    return per_object.withColumn("_total", total).select(
        object_name(F.col("nspname"), F.col("relname")).alias("object_name"),
        round_ratio(F.col("n") * 8, F.lit(1024)).alias("mb_used"),
        round_ratio(F.col("relpages") * 8, F.lit(1024)).alias("object_mb"),
        round_ratio(F.col("n") * 100, F.col("relpages")).alias("object_pct"),
        round_ratio(F.col("n") * 100, F.col("_total")).alias("buffer_pct"),
    )


def table_write_activity(user_tables: DataFrame) -> DataFrame:
    """Insert/update/delete sums per (schemaname, relname).

    ``total_writes`` sums the row-wise ``ins + upd + del``, so a row with any NULL
    counter is left out of it while the three single sums keep it.
    """
    return (user_tables.groupBy("schemaname", F.col("relname").alias("table_name"))
            .agg(F.sum("n_tup_ins").alias("inserts"), F.sum("n_tup_upd").alias("updates"),
                 F.sum("n_tup_del").alias("deletes"),
                 F.sum(F.col("n_tup_ins") + F.col("n_tup_upd") + F.col("n_tup_del")).alias("total_writes")))


def table_read_activity(table_reads: DataFrame, pg_class: DataFrame) -> DataFrame:
    """Scan counters joined to the relation's row estimate (inner join relid = oid)."""
    c = pg_class.select(F.col("oid"), F.col("reltuples").alias("row_count"))
    return (table_reads.join(c, table_reads.relid == c.oid)
            .select("schemaname", F.col("relname").alias("table_name"), "seq_scan", "idx_scan",
                    "idx_tup_fetch", "row_count"))


def needs_vacuum(pg_class: DataFrame, max_age: int, ratio: float = VACUUM_ALERT_RATIO,
                 order: bool = True, current_xid: int | None = None) -> DataFrame:
    """Relations (kinds r, m, p) whose freeze age, or their toast table's, exceeds ``max_age*ratio``.

    ``frozen_age`` carries ``age(relfrozenxid)``; with ``current_xid`` it is computed from a
    ``relfrozenxid`` column instead (``xid_age``).  ``greatest`` ignores a missing toast
    row; NULL on both sides drops the relation.  Sorted by table_name descending.
    """
    if current_xid is not None:
        pg_class = pg_class.withColumn("frozen_age", xid_age(F.col("relfrozenxid"), F.lit(current_xid)))
    c = pg_class.filter(F.col("relkind").isin(*VACUUM_KINDS)).select("relname", "reltoastrelid", "frozen_age")
    t = pg_class.select(F.col("oid").alias("toast_oid"), F.col("frozen_age").alias("toast_age"))
    age = F.greatest(F.col("frozen_age"), F.col("toast_age"))
    out = (c.join(t, c.reltoastrelid == t.toast_oid, "left")
           .select(F.col("relname").alias("table_name"), age.alias("age"))
           .filter(F.col("age") > F.lit(float(max_age) * ratio)))
    return out.orderBy(F.col("table_name").desc_nulls_first(), F.col("age").desc(), _spread(out)) if order else out


def prepared_age(prepared: DataFrame, now=None, order: bool = True) -> DataFrame:
    """Prepared transactions with their age in whole seconds, oldest first."""
    out = prepared.select("database", "prepared",
                          whole_seconds_between(_now(now), F.col("prepared")).alias("age"))
    return out.orderBy(F.col("age").desc_nulls_first(), "database", _spread(out)) if order else out


def replication_slot_lag(slots: DataFrame, current_lsn: str) -> DataFrame:
    """Bytes each slot's restart / confirmed-flush position trails the current WAL position."""
    cur = F.lit(current_lsn)
    return slots.select("slot_name", "active",
                        lsn_diff(cur, F.col("restart_lsn")).alias("restart_lag"),
                        lsn_diff(cur, F.col("confirmed_flush_lsn")).alias("flush_lag"))


def replication_lag(replication: DataFrame, current_lsn: str) -> DataFrame:
    """Bytes each replica's sent / write / flush / replay position trails the current one."""
    cur = F.lit(current_lsn)
    return replication.select(
        "application_name", "client_addr",
        *[lsn_diff(cur, F.col(f"{k}_lsn")).alias(f"{k}_lag") for k in ("sent", "write", "flush", "replay")])


def _stamped(snapshot: DataFrame, now, cols: Sequence[str]) -> DataFrame:
    """Project a statistics snapshot, stamping it with ``now`` unless it carries check_dt."""
    if "check_dt" in snapshot.columns and now is None:
        return snapshot.select("check_dt", *cols)
    return snapshot.select(_now(now).alias("check_dt"), *cols)


def temp_file_usage(db_stats: DataFrame, now=None) -> DataFrame:
    return _stamped(db_stats, now, ["datname", "temp_files", "temp_bytes"])


def bgwriter_stats(bgwriter: DataFrame, now=None) -> DataFrame:
    return _stamped(bgwriter, now, ["checkpoints_timed", "checkpoints_req",
                                    "checkpoint_write_time", "checkpoint_sync_time"])


def transaction_stats(db_stats: DataFrame, now=None) -> DataFrame:
    return _stamped(db_stats, now, ["datname", F.col("xact_commit").alias("commit"),
                                    F.col("xact_rollback").alias("rollback")])


def wal_activity(wal: DataFrame) -> DataFrame:
    """Absolute WAL bytes written at each snapshot: (check_dt, lsn) -> (check_dt, total_bytes)."""
    return wal.select("check_dt", lsn_diff(F.col("lsn"), F.lit("0/0")).alias("total_bytes"))


def column_layout(pg_class: DataFrame, attribute: DataFrame, pg_type: DataFrame,
                  namespace: DataFrame, order: bool = True) -> DataFrame:
    """Columns of user tables with type alignment and length, widest types first.

    Ties in type length are unordered in the original; here they are broken by
    table and column name, which also lets the range-partitioned sort spread a
    type length that covers most columns over many tasks.
    """
    ns = namespace.filter(~F.col("nspname").isin(*LAYOUT_HIDDEN_SCHEMAS)).select(F.col("oid").alias("ns_oid"))
    ty = pg_type.select(F.col("oid").alias("type_oid"), "typname", "typalign", "typlen")
    c = (pg_class.filter(F.col("relkind").isin(*LAYOUT_KINDS)).select("oid", "relname", "relnamespace")
         .join(ns, F.col("relnamespace") == F.col("ns_oid")))
    a = attribute.filter(F.col("attnum") >= 0).select("attrelid", "attname", "atttypid")
    out = (c.join(a, a.attrelid == c.oid).join(ty, F.col("atttypid") == F.col("type_oid"))
           .select(F.col("relname").alias("table_name"), F.col("attname").alias("column_name"),
                   F.col("typname").alias("column_type"), F.col("typalign").alias("alignment"),
                   F.col("typlen").alias("type_length")))
    if order:
        out = out.orderBy(F.col("type_length").desc_nulls_first(), "table_name", "column_name", _spread(out))
    return out


def snapshot_delta(snapshots: DataFrame, keys: Sequence[str], counters: Sequence[str],
                   time_col: str = "check_dt", tiebreak: Iterable[str] = ()) -> DataFrame:
    """Change of each cumulative counter since the previous snapshot of the same key.

    The first snapshot of a key has NULL deltas; a counter reset shows as a negative
    delta.  Implemented as a skew-safe ordered scan (``quarry.plans.scan.lag_columns``)
    so one key holding most snapshots does not land in a single task.
    """
    from quarry.plans.scan import lag_columns

    order = [time_col, *tiebreak]
    lagged = lag_columns(snapshots, keys, order, counters)
    return lagged.select(*snapshots.columns,
                         *[(F.col(c) - F.col(f"_prev_{c}")).alias(f"{c}_delta") for c in counters])


# ---- sessions, locks and blocking ---------------------------------------------------

def _locks_by_session(locks: DataFrame, pg_class: DataFrame) -> DataFrame:
    """(pid, mode, locktype) -> ordered, comma-separated names of locked ordinary tables.

    Lock rows are counted per (pid, mode, locktype, relation) before the class join,
    combined map-side, so a session or a relation with a third of all locks shuffles one row
    per pair, not one per lock.  Each count becomes its repeated name (duplicates are kept in
    the list), and the pieces are joined in name order.  The counts are partitioned by pid
    once, which the list aggregate and the session join both reuse.  The list itself names
    every lock, as in the original: one session's locks of one kind must fit in a string.
    """
    rel = pg_class.filter(F.col("relkind") == "r").select(F.col("oid").alias("rel_oid"), "relname")
    per_relation = locks.groupBy("pid", "mode", "locktype", "relation").agg(F.count(F.lit(1)).alias("_locks"))
    per_name = (per_relation.join(rel, F.col("relation") == F.col("rel_oid"))
                .groupBy("pid", "mode", "locktype", "relname").agg(F.sum("_locks").alias("_n")))
    piece = F.when(F.col("relname").isNotNull(),
                   F.array_join(F.array_repeat(F.col("relname"), F.col("_n").cast("int")), ", "))
    return (per_name.select("pid", "mode", "locktype", "relname", piece.alias("_piece"))
            .repartition("pid")
            .groupBy("pid", "mode", "locktype")
            .agg(F.expr("listagg(_piece, ', ') WITHIN GROUP (ORDER BY relname)").alias("tables")))


def _activity_locks(activity: DataFrame, locks: DataFrame, pg_class: DataFrame, now, keep=()) -> DataFrame:
    s = _locks_by_session(locks, pg_class)
    a = activity.select("pid", "wait_event", "state", "usename", "query_start", "client_addr", "query", *keep)
    return a.join(s, "pid", "left").select(
        "pid", "mode", "locktype", "wait_event", "state", "usename",
        round_to_second(F.col("query_start")).alias("query_start"), "client_addr",
        (micros_between(_now(now), F.col("query_start")) / F.lit(1000000.0)).alias("time_used"),
        "query", "tables", *keep)


def activity_locks(activity: DataFrame, locks: DataFrame, pg_class: DataFrame, now=None) -> DataFrame:
    """One row per session and held lock kind, with the tables it locks (NULLs if none).

    The locks are aggregated before the join; ``time_used`` is in seconds.
    """
    return _activity_locks(activity, locks, pg_class, now)


def blocking_activity(activity: DataFrame, locks: DataFrame, pg_class: DataFrame, now=None) -> DataFrame:
    """Which session blocks which: blocker rows x blocked rows, lock mode and tables of the blocker.

    ``activity.blocking_pids`` holds the blockers of each session.  The membership test
    ``blocker.pid = ANY(blocked.blocking_pids)`` becomes an explode of the distinct
    blocker pids and an equi-join (a nested-loop join otherwise).
    """
    al = _activity_locks(activity, locks, pg_class, now, keep=("blocking_pids",))
    # both sides read the same (session, lock kind) rows: write them once
    al = materialize(al.select("pid", "query", "usename", "client_addr", "mode", "tables", "blocking_pids"),
                     "activity-locks")
    blocked = al.select(F.explode(F.array_distinct("blocking_pids")).alias("blocker_pid"),
                        F.col("pid").alias("blocked_pid"), F.col("query").alias("blocked_query"),
                        F.col("usename").alias("blocked_user"), F.col("client_addr").alias("blocked_client"))
    blocker = al.select(F.col("pid").alias("blocker_pid"), F.col("query").alias("blocker_query"),
                        F.col("usename").alias("blocker_user"), F.col("client_addr").alias("blocker_client"),
                        F.col("mode").alias("lock_mode"), F.col("tables").alias("affected_tables"))
    return blocker.join(blocked, "blocker_pid").select(
        "blocker_pid", "blocker_query", "blocker_user", "blocker_client", "blocked_pid", "blocked_query",
        "blocked_user", "blocked_client", "lock_mode", "affected_tables")
