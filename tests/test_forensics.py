
from quarry.operators import forensics as fx


def _class(spark, rows):
    return spark.createDataFrame(rows, "oid long, relname string, relfilenode long, relnamespace int, relkind string, "
                                       "relpages int, reltuples double, reltoastrelid long, frozen_age long")


def test_buffer_share_golden(spark):
    ns = spark.createDataFrame([(0, "public"), (1, "pg_catalog")], "oid int, nspname string")
    cls = _class(spark, [(1, "A", 11, 0, "r", 4, 0.0, None, None), (2, "B", 12, 0, "r", 1, 0.0, None, None),
                         (3, "C", 13, 1, "r", 9, 0.0, None, None)])
    buf = spark.createDataFrame([(i, f) for i, f in enumerate([11, 11, 12, 13, 13, 13, 13, 13])], "bufferid long, relfilenode long")
    got = {r.object_name: r for r in fx.buffer_usage(buf, cls, ns).collect()}
    assert set(got) == {"A", "B"}
    assert (got["A"].object_pct, got["A"].buffer_pct, got["A"].mb_used) == (50.0, 66.67, 0.02)
    assert (got["B"].object_pct, got["B"].buffer_pct, got["B"].mb_used) == (100.0, 33.33, 0.01)


def test_write_activity_null_rule(spark):
    t = spark.createDataFrame([("s", "t", 1, 1, 1), ("s", "t", 2, 2, None)],
                              "schemaname string, relname string, n_tup_ins long, n_tup_upd long, n_tup_del long")
    r = fx.table_write_activity(t).first()
    assert (r.inserts, r.updates, r.deletes, r.total_writes) == (3, 3, 1, 3)


def test_needs_vacuum_greatest_and_order(spark):
    cls = _class(spark, [(1, "a", 1, 0, "r", 1, 0.0, 9, 10), (9, "a_toast", 9, 4, "t", 1, 0.0, None, 500),
                         (2, "b", 2, 0, "r", 1, 0.0, None, 200), (3, "c", 3, 0, "i", 1, 0.0, None, 999),
                         (4, "d", 4, 0, "p", 1, 0.0, None, None), (5, "e", 5, 0, "m", 1, 0.0, None, 90)])
    got = [(r.table_name, r.age) for r in fx.needs_vacuum(cls, max_age=100).collect()]
    assert got == [("b", 200), ("a", 500)]


def _activity(spark, rows):
    return spark.createDataFrame(rows, "pid long, wait_event string, state string, usename string, query_start timestamp_ntz, "
                                       "client_addr string, query string, blocking_pids array<long>")


def test_locks_text_and_blocking_dedup(spark):
    import datetime as dt

    t0 = dt.datetime(2024, 1, 1, 0, 0, 0, 600000)
    act = _activity(spark, [(1, None, "active", "u1", t0, "h", "q1", []), (2, None, "active", "u2", t0, "h", "q2", [1, 1]),
                            (3, None, "idle", "u3", t0, "h", "q3", [])])
    cls = _class(spark, [(10, "b", 10, 0, "r", 1, 0.0, None, None), (11, "a", 11, 0, "r", 1, 0.0, None, None),
                         (12, "ix", 12, 0, "i", 1, 0.0, None, None)])
    locks = spark.createDataFrame([(1, "X", "relation", 10), (1, "X", "relation", 11), (1, "X", "relation", 11),
                                   (1, "S", "relation", 10), (2, "S", "relation", 12)],
                                  "pid long, mode string, locktype string, relation long")
    al = fx.activity_locks(act, locks, cls, now="2024-01-01 00:00:10")
    rows = {(r.pid, r.mode): r for r in al.collect()}
    assert rows[(1, "X")].tables == "a, a, b"
    assert rows[(3, None)].tables is None and rows[(2, None)].mode is None
    assert str(rows[(1, "X")].query_start) == "2024-01-01 00:00:01"
    assert abs(rows[(1, "X")].time_used - 9.4) < 1e-9
    blk = fx.blocking_activity(act, locks, cls, now="2024-01-01 00:00:10").collect()
    assert sorted((r.blocker_pid, r.blocked_pid, r.lock_mode) for r in blk) == [(1, 2, "S"), (1, 2, "X")]


def test_blocking_plan_has_no_nested_loop(spark):
    import datetime as dt

    act = _activity(spark, [(1, None, "a", "u", dt.datetime(2024, 1, 1), "h", "q", [2])])
    cls = _class(spark, [(10, "b", 10, 0, "r", 1, 0.0, None, None)])
    locks = spark.createDataFrame([(1, "X", "relation", 10)], "pid long, mode string, locktype string, relation long")
    plan = fx.blocking_activity(act, locks, cls)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_snapshot_delta_with_hot_key(spark):
    rows = [("hot", i, i * 10) for i in range(300)] + [("cold", i, i) for i in range(5)] + [("hot", 300, 0)]
    df = spark.createDataFrame(rows, "datname string, t long, c long")
    got = {(r.datname, r.t): r.c_delta for r in fx.snapshot_delta(df, ["datname"], ["c"], "t").collect()}
    assert got[("hot", 0)] is None and got[("cold", 0)] is None
    assert all(got[("hot", i)] == 10 for i in range(1, 300))
    assert got[("hot", 300)] == -2990  # counter reset shows as a negative delta
    assert all(got[("cold", i)] == 1 for i in range(1, 5))


def test_column_layout_sorted_and_filtered(spark):
    cls = _class(spark, [(1, "t1", 1, 0, "r", 1, 0.0, None, None), (2, "t2", 2, 1, "r", 1, 0.0, None, None),
                         (3, "ix", 3, 0, "i", 1, 0.0, None, None)])
    ns = spark.createDataFrame([(0, "public"), (1, "pg_catalog")], "oid int, nspname string")
    ty = spark.createDataFrame([(1, "int8", "d", 8), (3, "text", "i", -1), (4, "bool", "c", 1)],
                               "oid int, typname string, typalign string, typlen int")
    att = spark.createDataFrame([(1, "a", 1, 3), (1, "b", 2, 1), (1, "c", 3, 4), (1, "ctid", -1, 1), (2, "z", 1, 1),
                                 (3, "k", 1, 1)], "attrelid long, attname string, attnum int, atttypid int")
    got = [(r.column_name, r.type_length) for r in fx.column_layout(cls, att, ty, ns).collect()]
    assert got == [("b", 8), ("c", 1), ("a", -1)]


def test_operators_as_sql_views(spark):
    from quarry.plans.views import register_views
    from quarry.sources.testdata import CURRENT_LSN, MAX_FREEZE_AGE, NOW, TestTables

    t = TestTables(spark, "/root/testdata/sf0.001")
    snaps = {"activity": t.in_activity, "locks": t.in_locks, "class": t.in_class, "namespace": t.in_namespace,
             "buffercache": t.in_buffercache, "slots": t.in_slots, "pets": t.in_pet, "authid": t.in_authid,
             "auth_members": t.in_auth_members, "table_privileges": t.in_table_privileges}
    made = register_views(spark, snaps, now=NOW, current_lsn=CURRENT_LSN, max_age=MAX_FREEZE_AGE, include_eager=True)
    assert {"buffer_usage", "activity_locks", "blocking_activity", "recursive_table_privileges", "pet_status",
            "replication_slot_lag", "needs_vacuum"} <= set(made)
    assert "replication_lag" not in made  # its snapshot was not given
    # views compose in SQL like the original's views on views
    n = spark.sql("SELECT count(*) FROM blocking_activity b JOIN sessions s ON s.pid = b.blocked_pid").first()[0]
    assert n == fx.blocking_activity(t.in_activity, t.in_locks, t.in_class, now=NOW).count()
    assert spark.sql("SELECT count(*) FROM buffer_usage").first()[0] == fx.buffer_usage(
        t.in_buffercache, t.in_class, t.in_namespace).count()


def test_lookups_as_sql_table_functions(spark):
    from quarry.operators import access as ax
    from quarry.plans.views import register_functions
    from quarry.sources.testdata import NOW, PROXY_ROLE, TestTables

    t = TestTables(spark, "/root/testdata/sf0.001")
    made = register_functions(spark, {"authid": t.in_authid, "auth_members": t.in_auth_members, "pets": t.in_pet}, now=NOW)
    assert made == ["login_lookup", "role_members", "role_members_nosuper", "pet_status_of"]
    members = [r.username for r in ax.role_members(t.in_authid, t.in_auth_members, PROXY_ROLE).collect()]
    supers = {r.rolname for r in t.in_authid.filter("rolsuper").collect()}
    user = next(u for u in members if u in supers)  # a superuser in the allow-list role
    assert len(spark.sql(f"SELECT * FROM role_members('{PROXY_ROLE}', '{user}')").collect()) == 1
    assert spark.sql(f"SELECT * FROM role_members_nosuper('{PROXY_ROLE}', '{user}')").collect() == []
    assert spark.sql("SELECT * FROM login_lookup('nobody')").collect() == []   # unknown user -> no rows
    owner = t.in_pet.first().player
    assert spark.sql(f"SELECT count(*) FROM pet_status_of('{owner}')").first()[0] == 1
