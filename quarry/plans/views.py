"""SQL access: the forensic and lifecycle operators as session temp views.

``register_views(spark, snapshots, ...)`` takes the snapshot tables by name (the inputs
listed in ``quarry.operators``) and registers one temporary view per operator whose
inputs are all present, so ``spark.sql("SELECT * FROM blocking_activity WHERE ...")``
works, and views can be composed in SQL like the original's views on views.  Each view is the
operator's DataFrame plan (no data is computed or cached by registering it).
``register_functions`` adds the parameterised lookups as temporary SQL table functions.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.operators import access as ax
from quarry.operators import forensics as fx
from quarry.operators import lifecycle as lc


def _views(s: dict[str, DataFrame], now, current_lsn, max_age) -> dict[str, tuple[tuple[str, ...], Callable]]:
    """view name -> (required snapshot names, builder)."""
    return {
        "sessions": (("activity",), lambda: fx.sessions(s["activity"])),
        "buffer_usage": (("buffercache", "class", "namespace"),
                         lambda: fx.buffer_usage(s["buffercache"], s["class"], s["namespace"])),
        "table_write_activity": (("user_tables",), lambda: fx.table_write_activity(s["user_tables"])),
        "table_read_activity": (("user_tables", "class"), lambda: fx.table_read_activity(s["user_tables"], s["class"])),
        "needs_vacuum": (("class",), lambda: fx.needs_vacuum(s["class"], max_age, order=False)),
        "prepared_age": (("prepared",), lambda: fx.prepared_age(s["prepared"], now=now, order=False)),
        "replication_slot_lag": (("slots",), lambda: fx.replication_slot_lag(s["slots"], current_lsn)),
        "replication_lag": (("replication",), lambda: fx.replication_lag(s["replication"], current_lsn)),
        "temp_file_usage": (("db_stats",), lambda: fx.temp_file_usage(s["db_stats"])),
        "transaction_stats": (("db_stats",), lambda: fx.transaction_stats(s["db_stats"])),
        "bgwriter_stats": (("bgwriter",), lambda: fx.bgwriter_stats(s["bgwriter"])),
        "wal_activity": (("wal",), lambda: fx.wal_activity(s["wal"])),
        "column_layout": (("class", "attribute", "type", "namespace"),
                          lambda: fx.column_layout(s["class"], s["attribute"], s["type"], s["namespace"], order=False)),
        "activity_locks": (("activity", "locks", "class"),
                           lambda: fx.activity_locks(s["activity"], s["locks"], s["class"], now=now)),
        "recursive_groups": (("authid", "auth_members"), lambda: ax.recursive_groups(s["authid"], s["auth_members"])),
        "recursive_table_privileges": (("authid", "auth_members", "table_privileges"), lambda: ax.recursive_table_privileges(
            ax.recursive_groups(s["authid"], s["auth_members"], expand=False), s["table_privileges"])),
        "pet_status": (("pets",), lambda: lc.pet_status(s["pets"], now=now)),
    }


# views that run jobs while being built (frontier loop, pinned intermediates): only on request
_EAGER = {"recursive_groups", "recursive_table_privileges", "blocking_activity"}


def register_views(spark: SparkSession, snapshots: dict[str, DataFrame], now=None, current_lsn: str | None = None,
                   max_age: int | None = None, include_eager: bool = False) -> list[str]:
    """Register a temp view per operator whose snapshot inputs are given; return the view names.

    Parameters the original reads from the server (``now()``, the current WAL position,
    the freeze age setting) are passed here; views needing a missing one are skipped.
    """
    views = _views(snapshots, now, current_lsn, max_age)
    if include_eager:
        views["blocking_activity"] = (("activity", "locks", "class"), lambda: fx.blocking_activity(
            snapshots["activity"], snapshots["locks"], snapshots["class"], now=now))
    needs_param = {"replication_slot_lag": current_lsn, "replication_lag": current_lsn, "needs_vacuum": max_age}
    made = []
    for name, (inputs, build) in views.items():
        if name in _EAGER and not include_eager:
            continue
        if any(i not in snapshots for i in inputs) or (name in needs_param and needs_param[name] is None):
            continue
        build().createOrReplaceTempView(name)
        made.append(name)
    return made


def register_functions(spark: SparkSession, snapshots: dict[str, DataFrame], now=None) -> list[str]:
    """Register the parameterised lookups as temporary SQL table functions; return their names.

    Each function filters a view built by the operators, so the logic lives once, in the
    DataFrame code:

    * ``login_lookup(user)`` -> (username, password) of a login role (needs ``authid``)
    * ``role_members(role, user)`` / ``role_members_nosuper(role, user)`` -> (username, password)
      of a direct member of ``role`` (needs ``authid``, ``auth_members``)
    * ``pet_status_of(owner)`` -> the owner's pet status (needs ``pets``)

    The credential functions return the hash column because, like the originals, they are
    meant for the connection proxy; the audit stream never stores it.
    """
    from pyspark.sql import functions as F

    made = []
    if "authid" in snapshots:
        ax.login_lookup(snapshots["authid"], with_password=True).createOrReplaceTempView("quarry_login_roles")
        spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION login_lookup(u STRING)
                     RETURNS TABLE (username STRING, password STRING)
                     RETURN SELECT username, password FROM quarry_login_roles WHERE username = u""")
        made.append("login_lookup")
    if "authid" in snapshots and "auth_members" in snapshots:
        a, m = snapshots["authid"], snapshots["auth_members"]
        groups = a.select(F.col("oid").alias("g_oid"), F.col("rolname").alias("role"))
        users = a.select(F.col("oid").alias("u_oid"), F.col("rolname").alias("username"),
                         F.col("rolpassword").alias("password"), "rolsuper")
        (m.join(groups, F.col("roleid") == F.col("g_oid")).join(users, F.col("member") == F.col("u_oid"))
         .select("role", "username", "password", "rolsuper").createOrReplaceTempView("quarry_role_members"))
        for name, cond in (("role_members", ""), ("role_members_nosuper", " AND NOT rolsuper")):
            spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(r STRING, u STRING)
                          RETURNS TABLE (username STRING, password STRING)
                          RETURN SELECT username, password FROM quarry_role_members
                                  WHERE role = r AND username = u{cond}""")
            made.append(name)
    if "pets" in snapshots:
        lc.pet_status(snapshots["pets"], now=now).createOrReplaceTempView("quarry_pet_status")
        spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION pet_status_of(o STRING)
                     RETURNS TABLE (pet_name STRING, appetite STRING, spirits STRING, health STRING, age BIGINT)
                     RETURN SELECT pet_name, appetite, spirits, health, age FROM quarry_pet_status WHERE player = o""")
        made.append("pet_status_of")
    return made
