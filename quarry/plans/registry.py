"""Registered queries: one per operator key, each with its DuckDB oracle SQL.

``QUERIES[key](spark, sf_dir)`` returns a DataFrame over the whole test tables of
``sf_dir``; ``ORACLE[key]`` is the equivalent SQL over the same parquet tables
(every registered key has one).
Computed columns carry the same names on both sides.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.plans.oracle_inputs import with_inputs as W
from quarry.sources.testdata import (
    CURRENT_LSN,
    MAX_FREEZE_AGE,
    NOW,
    PROXY_ROLE,
    SENSOR,
    TestTables,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[key] = lambda spark, sf_dir: fn(TestTables(spark, sf_dir))
        if oracle is not None:
            ORACLE[key] = oracle
        return fn
    return deco


# half-up rounding of a non-negative ratio: integer quotient, one more where the remainder is half or above
def _rr(num: str, den: str, scale: int = 2) -> str:
    p = 10 ** scale
    n, d = f"CAST({num} AS HUGEINT) * {p}", f"CAST({den} AS HUGEINT)"
    return f"CASE WHEN {d} > 0 THEN CAST({n} // ({d}) + ({n} % ({d}) * 2 >= {d})::INT AS DOUBLE) / {float(p)} END"


def _lsn(expr: str) -> str:
    return (f"(CAST(('0x' || split_part({expr}, '/', 1)) AS UBIGINT)::HUGEINT * 4294967296 "
            f"+ CAST(('0x' || split_part({expr}, '/', 2)) AS UBIGINT)::HUGEINT)")


def _lsn_diff(a: str, b: str) -> str:
    return f"CAST({_lsn(a)} - {_lsn(b)} AS BIGINT)"


def _micros(later: str, earlier: str) -> str:
    return f"date_diff('microsecond', {earlier}, {later})"


def _whole_seconds(later: str, earlier: str) -> str:
    m = _micros(later, earlier)
    return f"CAST(sign({m}) * floor((abs({m}) + 500000) / 1000000) AS BIGINT)"


NOW_SQL = f"TIMESTAMP '{NOW}'"

# ---------------------------------------------------------------- forensics
from quarry.operators import forensics as fx  # noqa: E402


@query("buffer_usage", W(f"""
SELECT CASE WHEN nspname = 'public' THEN relname ELSE nspname || '.' || relname END AS object_name,
       {_rr('n * 8', '1024')} AS mb_used, {_rr('relpages * 8', '1024')} AS object_mb,
       {_rr('n * 100', 'relpages')} AS object_pct, {_rr('n * 100', 'sum(n) OVER ()')} AS buffer_pct
  FROM (SELECT c.oid, c.relpages, n.nspname, c.relname, count(*) AS n
          FROM in_buffercache b JOIN in_class c USING (relfilenode) JOIN in_namespace n ON c.relnamespace = n.oid
         WHERE n.nspname NOT IN ('pg_catalog', 'information_schema', 'pg_toast') AND c.relpages > 0
         GROUP BY c.oid, c.relpages, n.nspname, c.relname) g""", "in_buffercache", "in_class", "in_namespace"))
def q_buffer_usage(t: TestTables):
    return fx.buffer_usage(t.in_buffercache, t.in_class, t.in_namespace)


@query("table_write_activity", W("""
SELECT schemaname, relname AS table_name, CAST(sum(n_tup_ins) AS BIGINT) AS inserts, CAST(sum(n_tup_upd) AS BIGINT) AS updates,
       CAST(sum(n_tup_del) AS BIGINT) AS deletes, CAST(sum(n_tup_ins + n_tup_upd + n_tup_del) AS BIGINT) AS total_writes
  FROM in_user_tables GROUP BY schemaname, relname""", "in_user_tables"))
def q_table_write_activity(t):
    return fx.table_write_activity(t.in_user_tables)


@query("table_read_activity", W("""
SELECT s.schemaname, s.relname AS table_name, s.seq_scan, s.idx_scan, s.idx_tup_fetch, c.reltuples AS row_count
  FROM in_table_reads s JOIN in_class c ON c.oid = s.relid""", "in_table_reads", "in_class"))
def q_table_read_activity(t):
    return fx.table_read_activity(t.in_table_reads, t.in_class)


# fixed values: the relation kinds of each report, and the schemas left out of the layout
@query("needs_vacuum", W(f"""
SELECT first(relname) AS table_name, max(frozen_age) AS age
  FROM (SELECT oid, relname, relkind, frozen_age FROM in_class
        UNION ALL
        SELECT owner.oid, owner.relname, owner.relkind, side.frozen_age
          FROM in_class side JOIN in_class owner ON owner.reltoastrelid = side.oid) candidate
 WHERE relkind IN ('r', 'm', 'p')
 GROUP BY oid HAVING max(frozen_age) * 10 > {MAX_FREEZE_AGE} * 9""", "in_class"))
def q_needs_vacuum(t):
    return fx.needs_vacuum(t.in_class, MAX_FREEZE_AGE)


@query("prepared_age", W(f"""
SELECT database, prepared, {_whole_seconds(NOW_SQL, 'prepared')} AS age FROM in_prepared ORDER BY age DESC NULLS FIRST""",
                         "in_prepared"))
def q_prepared_age(t):
    return fx.prepared_age(t.in_prepared, now=NOW)


@query("replication_slot_lag", W(f"""
SELECT slot_name, active, {_lsn_diff(repr(CURRENT_LSN), 'restart_lsn')} AS restart_lag,
       {_lsn_diff(repr(CURRENT_LSN), 'confirmed_flush_lsn')} AS flush_lag FROM in_slots""", "in_slots"))
def q_replication_slot_lag(t):
    return fx.replication_slot_lag(t.in_slots, CURRENT_LSN)


@query("replication_lag", W(f"""
SELECT application_name, client_addr,
       {_lsn_diff(repr(CURRENT_LSN), 'sent_lsn')} AS sent_lag, {_lsn_diff(repr(CURRENT_LSN), 'write_lsn')} AS write_lag,
       {_lsn_diff(repr(CURRENT_LSN), 'flush_lsn')} AS flush_lag, {_lsn_diff(repr(CURRENT_LSN), 'replay_lsn')} AS replay_lag
  FROM in_replication""", "in_replication"))
def q_replication_lag(t):
    return fx.replication_lag(t.in_replication, CURRENT_LSN)


@query("temp_file_usage", W("SELECT check_dt, datname, temp_files, temp_bytes FROM in_db_stats", "in_db_stats"))
def q_temp_file_usage(t):
    return fx.temp_file_usage(t.in_db_stats)


@query("bgwriter_stats", W("""SELECT check_dt, checkpoints_timed, checkpoints_req, checkpoint_write_time, checkpoint_sync_time
  FROM in_bgwriter""", "in_bgwriter"))
def q_bgwriter_stats(t):
    return fx.bgwriter_stats(t.in_bgwriter)


@query("transaction_stats", W("SELECT check_dt, datname, xact_commit AS commit, xact_rollback AS rollback FROM in_db_stats",
                              "in_db_stats"))
def q_transaction_stats(t):
    return fx.transaction_stats(t.in_db_stats)


@query("wal_activity", W(f"SELECT check_dt, {_lsn_diff('lsn', repr('0/0'))} AS total_bytes FROM in_wal", "in_wal"))
def q_wal_activity(t):
    return fx.wal_activity(t.in_wal)


_DELTA_COLS = ["temp_files", "temp_bytes", "xact_commit", "xact_rollback"]


@query("snapshot_delta", W("SELECT *, " + ", ".join(
    f"{c} - lag({c}) OVER (PARTITION BY datname ORDER BY check_dt, xact_commit) AS {c}_delta" for c in _DELTA_COLS)
    + " FROM in_db_stats", "in_db_stats"))
def q_snapshot_delta(t):
    return fx.snapshot_delta(t.in_db_stats, ["datname"], _DELTA_COLS, "check_dt", tiebreak=["xact_commit"])


@query("column_layout", W("""
WITH shown AS (
  SELECT oid, relname FROM in_class
   WHERE relkind IN ('r', 'p')
     AND relnamespace IN (SELECT oid FROM in_namespace WHERE nspname NOT IN ('pg_catalog', 'information_schema'))),
kinds AS (SELECT oid AS atttypid, typname, typalign, typlen FROM in_type)
SELECT (SELECT relname FROM shown WHERE shown.oid = col.attrelid) AS table_name, col.attname AS column_name,
       kinds.typname AS column_type, kinds.typalign AS alignment, kinds.typlen AS type_length
  FROM (SELECT * FROM in_attribute WHERE attnum >= 0) col JOIN kinds USING (atttypid)
 WHERE col.attrelid IN (SELECT oid FROM shown)""", "in_class", "in_attribute", "in_type", "in_namespace"))
def q_column_layout(t):
    return fx.column_layout(t.in_class, t.in_attribute, t.in_type, t.in_namespace)


@query("sessions", W("SELECT * FROM in_activity", "in_activity"))
def q_sessions(t):
    return fx.sessions(t.in_activity)


# names of the ordinary tables each session has locked, per kind of lock, as a sorted list
_HELD_SQL = """held AS (
  SELECT pid, mode, locktype, array_to_string(list_sort(list(ordinary.relname)), ', ') AS tables
    FROM in_locks JOIN (SELECT oid AS relation, relname FROM in_class WHERE relkind = 'r') ordinary USING (relation)
   GROUP BY ALL)"""


@query("activity_locks", W(f"""WITH {_HELD_SQL}
SELECT pid, mode, locktype, wait_event, state, usename, time_bucket(INTERVAL 1 SECOND, query_start + INTERVAL 500 MILLISECOND) AS query_start,
       client_addr, {_micros(NOW_SQL, 'query_start')} / 1000000.0 AS time_used, query, tables
  FROM in_activity LEFT JOIN held USING (pid)""",
                           "in_activity", "in_locks", "in_class"))
def q_activity_locks(t):
    return fx.activity_locks(t.in_activity, t.in_locks, t.in_class, now=NOW)


# a waiting session counts once for every kind of lock it holds (once without any), a blocker likewise
@query("blocking_activity", W(f"""WITH {_HELD_SQL},
waiting AS (
  SELECT pid AS blocked_pid, query AS blocked_query, usename AS blocked_user, client_addr AS blocked_client,
         unnest(list_distinct(blocking_pids)) AS blocker_pid,
         greatest(1, (SELECT count(*) FROM held WHERE held.pid = in_activity.pid)) AS times
    FROM in_activity),
holding AS (
  SELECT pid AS blocker_pid, query AS blocker_query, usename AS blocker_user, client_addr AS blocker_client,
         mode AS lock_mode, tables AS affected_tables
    FROM in_activity LEFT JOIN held USING (pid))
SELECT * EXCLUDE (times, k) FROM (SELECT *, unnest(range(times)) AS k FROM waiting) JOIN holding USING (blocker_pid)""",
                              "in_activity", "in_locks", "in_class"))
def q_blocking_activity(t):
    return fx.blocking_activity(t.in_activity, t.in_locks, t.in_class, now=NOW)


# ---------------------------------------------------------------- access
from quarry.operators import access as ax  # noqa: E402

# every membership path as its two end points (oids), grown at the member's end; names come last
_PATHS_SQL = """WITH RECURSIVE walk(low, high) AS (
  SELECT member, roleid FROM in_auth_members
  UNION ALL
  SELECT below.member, walk.high FROM walk, in_auth_members below WHERE below.roleid = walk.low),
named AS (SELECT oid, rolname FROM in_authid),
closure AS (
  SELECT lower_role.rolname AS user_name, upper_role.rolname AS group_name
    FROM walk JOIN named lower_role ON lower_role.oid = low JOIN named upper_role ON upper_role.oid = high)"""


@query("recursive_groups", W(_PATHS_SQL + "\nFROM closure", "in_authid", "in_auth_members"))
def q_recursive_groups(t):
    return ax.recursive_groups(t.in_authid, t.in_auth_members)


# a pair reaches what its group was granted and, unless both are one role, what the user was granted
@query("recursive_table_privileges", W(_PATHS_SQL + """,
reach AS (SELECT user_name, group_name AS grantee FROM closure
          UNION ALL SELECT user_name, user_name FROM closure WHERE group_name <> user_name)
SELECT user_name, table_schema, table_name, privilege_type FROM in_table_privileges JOIN reach USING (grantee)""",
                                       "in_authid", "in_auth_members", "in_table_privileges"))
def q_recursive_table_privileges(t):
    return ax.recursive_table_privileges(ax.recursive_groups(t.in_authid, t.in_auth_members, expand=False), t.in_table_privileges)


# memberships over the parts: runs of ten keys, each a member of the next two; in every third run the last is a member of the first
_RUNS_SQL = """edges AS (
  SELECT 'role_' || a.p_partkey AS u, 'role_' || b.p_partkey AS v, a.p_partkey // 10 AS run
    FROM part a JOIN part b ON b.p_partkey // 10 = a.p_partkey // 10 AND b.p_partkey - a.p_partkey IN (1, 2)
  UNION ALL SELECT 'role_' || p_partkey, 'role_' || (p_partkey - 9), p_partkey // 10 FROM part WHERE p_partkey % 10 = 9 AND p_partkey // 10 % 3 = 0 AND p_partkey > 9)"""


def _run_edges(t: TestTables) -> DataFrame:
    k = F.col("p_partkey")
    run = F.floor(k / 10)
    forward = t.base("part").select(k, F.explode(F.array(k + 1, k + 2)).alias("to")).where((F.floor(F.col("to") / 10) == run))
    forward = forward.join(t.base("part").select(k.alias("to")), "to").select("p_partkey", "to")
    back = t.base("part").where((k % 10 == 9) & (run % 3 == 0) & (k > 9)).select(k, (k - 9).alias("to"))
    return forward.unionByName(back).select(F.concat(F.lit("role_"), k).alias("member_name"), F.concat(F.lit("role_"), F.col("to")).alias("group_name"))


@query("role_cycles", f"""WITH RECURSIVE {_RUNS_SQL},
reach AS (SELECT u, v FROM edges UNION SELECT r.u, e.v FROM reach r JOIN edges e ON e.u = r.v)
SELECT a.u AS role, min(a.v) AS cycle, count(*) AS size FROM reach a JOIN reach b ON a.u = b.v AND a.v = b.u GROUP BY a.u""")
def q_role_cycles(t):
    from quarry.operators.closure import membership_cycles

    return membership_cycles(_run_edges(t))


@query("role_closure", f"""WITH RECURSIVE {_RUNS_SQL},
walks AS (SELECT u, v FROM edges WHERE run % 3 <> 0 OR run = 0 UNION ALL SELECT w.u, e.v FROM walks w JOIN edges e ON e.u = w.v)
SELECT u AS user_name, v AS group_name, count(*) AS paths FROM walks GROUP BY u, v""")
def q_role_closure(t):
    from quarry.operators.closure import membership_closure

    return membership_closure(_run_edges(t))


_MEMBERS_SQL = """SELECT u.rolname AS username FROM in_authid g JOIN in_auth_members m ON m.roleid = g.oid
  JOIN in_authid u ON u.oid = m.member WHERE g.rolname = '%s'""" % PROXY_ROLE


@query("role_members", W(_MEMBERS_SQL, "in_authid", "in_auth_members"))
def q_role_members(t):
    return ax.role_members(t.in_authid, t.in_auth_members, PROXY_ROLE)


@query("role_members_nosuper", W(_MEMBERS_SQL + " AND NOT u.rolsuper", "in_authid", "in_auth_members"))
def q_role_members_nosuper(t):
    return ax.role_members_nosuper(t.in_authid, t.in_auth_members, PROXY_ROLE)


@query("login_lookup", W("""SELECT a.rolname AS username, a.rolpassword AS password FROM in_authid a
  WHERE a.rolcanlogin AND a.rolname IN (SELECT DISTINCT usename FROM in_activity)
     OR a.rolcanlogin AND a.rolname IN (SELECT c_name FROM customer)""", "in_authid", "in_activity"))
def q_login_lookup(t):
    # requests: every session user name and every customer name; only login roles answer
    req = (t.in_activity.select(F.col("usename").alias("username"))
           .unionByName(t.base("customer").select(F.col("c_name").alias("username"))))
    return ax.login_lookup(t.in_authid, requests=req, with_password=True)


# ---------------------------------------------------------------- lifecycle
from quarry.operators import lifecycle as lc  # noqa: E402

_BANDS_SQL = f"""player, pet_name,
       CASE WHEN food = 0 THEN 'NONE!' WHEN food < 8 THEN 'STARVING' WHEN food < 16 THEN 'HUNGRY' ELSE 'FULL' END AS appetite,
       CASE WHEN mood = 0 THEN 'NONE!' WHEN mood < 8 THEN 'DEPRESSED' WHEN mood < 16 THEN 'BORED' ELSE 'HAPPY' END AS spirits,
       CASE WHEN is_dead THEN 'DEAD (you monster!)' WHEN food < 5 OR mood < 5 THEN 'SICK'
            WHEN food < 13 OR mood < 13 THEN 'OK' ELSE 'GREAT' END AS health,
       {_whole_seconds(f"coalesce(death_date, {NOW_SQL})", 'birth_date')} AS age"""


@query("pet_status", W(f"SELECT {_BANDS_SQL} FROM in_pet", "in_pet"))
def q_pet_status(t):
    return lc.pet_status(t.in_pet, now=NOW)


@query("owner_filter", W("SELECT * FROM in_pet WHERE player = 'Customer#000000007'", "in_pet"))
def q_owner_filter(t):
    return lc.owner_filter(t.in_pet, "Customer#000000007")


@query("pet_tick", W(f"""
SELECT player, pet_name, m AS mood, f AS food, is_dead OR (NOT is_dead AND (m < 1 OR f < 1)) AS is_dead, birth_date,
       CASE WHEN NOT is_dead AND (m < 1 OR f < 1) THEN {NOW_SQL} ELSE death_date END AS death_date
  FROM (SELECT *, CASE WHEN is_dead THEN mood ELSE least(24, mood - 1) END AS m,
               CASE WHEN is_dead THEN food ELSE least(24, food - 1) END AS f FROM in_pet)""", "in_pet"))
def q_pet_tick(t):
    return lc.pet_tick(t.in_pet, now=NOW)


def _update_sql(df: int, dm: int) -> str:
    return f"""
SELECT player, pet_name, CASE WHEN is_dead THEN mood ELSE least(24, mood + {dm}) END AS mood,
       CASE WHEN is_dead THEN food ELSE least(24, food + {df}) END AS food, is_dead, birth_date, death_date,
       NOT is_dead AS accepted, CASE WHEN is_dead THEN 'Your ONLY pet is dead forever. Murderer!' END AS reason
  FROM in_pet"""


@query("pet_feed", W(_update_sql(8, 0), "in_pet"))
def q_pet_feed(t):
    return lc.pet_feed(t.in_pet)


@query("pet_train", W(_update_sql(0, 12), "in_pet"))
def q_pet_train(t):
    return lc.pet_train(t.in_pet)


# candidates: one per session user of the event log (new players) and one per
# customer (players that already own a pet), ordered by the event sequence
def _candidates(t: TestTables) -> DataFrame:
    ev = t.in_pet_events
    return (ev.select("player", F.concat(F.lit("pet_"), F.col("seq")).alias("pet_name"), F.col("seq").alias("ord"))
            .unionByName(t.in_pet.select("player", F.concat(F.lit("new_"), F.col("pet_name")).alias("pet_name"),
                                         F.lit(-1).cast("bigint").alias("ord"))))


_CANDIDATES_SQL = """cand AS (
  SELECT player, 'pet_' || seq AS pet_name, seq AS ord FROM in_pet_events
  UNION ALL SELECT player, 'new_' || pet_name, CAST(-1 AS BIGINT) FROM in_pet),
ranked AS (SELECT c.*, p.is_dead AS ex_dead, (c.ord, c.pet_name) = min((c.ord, c.pet_name)) OVER (PARTITION BY c.player) AS is_first
  FROM cand c LEFT JOIN in_pet p USING (player)),
checked AS (SELECT player, pet_name,
  CASE WHEN ex_dead THEN 'Your ONLY pet is dead forever. Murderer!' WHEN ex_dead IS NOT NULL THEN 'You can only ever have one pet!'
       WHEN NOT is_first THEN 'You can only ever have one pet!' END AS reason FROM ranked)"""


@query("pet_validate_insert", W(f"""WITH {_CANDIDATES_SQL}
SELECT player, pet_name, CASE WHEN reason IS NULL THEN 24 END AS mood, CASE WHEN reason IS NULL THEN 24 END AS food,
       CASE WHEN reason IS NULL THEN false END AS is_dead, CASE WHEN reason IS NULL THEN {NOW_SQL} END AS birth_date,
       CAST(NULL AS TIMESTAMP) AS death_date, reason IS NULL AS accepted, reason FROM checked""", "in_pet_events", "in_pet"))
def q_pet_validate_insert(t):
    return lc.pet_validate_insert(_candidates(t), t.in_pet, now=NOW, order_col="ord")


@query("pet_create", W(f"""WITH {_CANDIDATES_SQL}
SELECT player, pet_name, mood, food, is_dead, birth_date, death_date FROM in_pet
UNION ALL SELECT player, pet_name, 24, 24, false, {NOW_SQL}, CAST(NULL AS TIMESTAMP) FROM checked WHERE reason IS NULL""",
                        "in_pet_events", "in_pet"))
def q_pet_create(t):
    return lc.pet_create(_candidates(t), t.in_pet, now=NOW, order_col="ord")


# updates: every pet gets +3 food and +20 mood; every 13th customer's pet is handed to someone else
def _updates(t: TestTables) -> DataFrame:
    k = F.regexp_extract("pet_name", r"(\d+)$", 1).cast("bigint")
    return t.in_pet.select("player", F.when(k % 13 == 0, F.concat(F.lit("buyer_"), k)).alias("new_player"),
                           (F.col("mood") + 20).alias("mood"), (F.col("food") + 3).alias("food"))


@query("pet_validate_update", W("""
SELECT player, pet_name, CASE WHEN reason IS NULL THEN least(24, mood + 20) ELSE mood END AS mood,
       CASE WHEN reason IS NULL THEN least(24, food + 3) ELSE food END AS food, is_dead, birth_date, death_date,
       reason IS NULL AS accepted, reason
  FROM (SELECT *, CASE WHEN is_dead THEN 'Your ONLY pet is dead forever. Murderer!'
                       WHEN CAST(regexp_extract(pet_name, '(\\d+)$', 1) AS BIGINT) % 13 = 0 THEN 'You must commit to your pet. No selling!'
                  END AS reason FROM in_pet)""", "in_pet"))
def q_pet_validate_update(t):
    return lc.pet_validate_update(t.in_pet, _updates(t))


# two producers offer pets (events of even number first), then every pet that was there is updated
@query("pet_write_path", f"""
SELECT player, pet_name, mood, food, is_dead, birth_date, death_date FROM ({ORACLE["pet_validate_update"]}) kept
UNION ALL
SELECT player, min_by(pet_name, (seq % 2, seq)), 24, 24, false, {NOW_SQL}, CAST(NULL AS TIMESTAMP)
  FROM ({W("SELECT player, 'pet_' || seq AS pet_name, seq FROM in_pet_events WHERE player NOT IN (SELECT player FROM in_pet)", "in_pet_events", "in_pet")}) offered
 GROUP BY player""")
def q_pet_write_path(t):
    from quarry.session import scratch_path
    from quarry.sources import pet_table as pt

    path = scratch_path(t.spark, "pet-table")
    pt.start_pet_table(t.in_pet, path)
    offers = _candidates(t)
    pt.submit_inserts(offers.where("ord % 2 = 0"), path, 0, "even", now=NOW, order_col="ord")
    pt.submit_inserts(offers.where("ord % 2 <> 0"), path, 0, "odd", now=NOW, order_col="ord")
    pt.submit_updates(_updates(t), path, 0, "updates")
    return pt.read_pets(t.spark, path)


# the fold of an ordered log, one row per event: ev(player, ts, seq, action, rn) -> final state per player
_FOLD_SQL = """st AS (
  SELECT player, CAST(0 AS BIGINT) AS rn, 24 AS food, 24 AS mood, false AS is_dead, CAST(NULL AS TIMESTAMP) AS death_date
    FROM (SELECT DISTINCT player FROM ev)
  UNION ALL
  SELECT st.player, ev.rn,
         CASE WHEN st.is_dead THEN st.food WHEN ev.action = 'feed' THEN least(24, st.food + 8)
              WHEN ev.action = 'tick' THEN least(24, st.food - 1) ELSE least(24, st.food) END,
         CASE WHEN st.is_dead THEN st.mood WHEN ev.action = 'train' THEN least(24, st.mood + 12)
              WHEN ev.action = 'tick' THEN least(24, st.mood - 1) ELSE least(24, st.mood) END,
         st.is_dead OR (ev.action = 'tick' AND (least(24, st.food - 1) < 1 OR least(24, st.mood - 1) < 1)),
         CASE WHEN st.is_dead THEN st.death_date
              WHEN ev.action = 'tick' AND (least(24, st.food - 1) < 1 OR least(24, st.mood - 1) < 1) THEN ev.ts END
    FROM st JOIN ev ON ev.player = st.player AND ev.rn = st.rn + 1)
SELECT player, food, mood, is_dead, death_date FROM st QUALIFY rn = max(rn) OVER (PARTITION BY player)"""


@query("pet_replay", W("""WITH RECURSIVE ev AS (
  SELECT player, ts, seq, action, row_number() OVER (PARTITION BY player ORDER BY ts, seq) AS rn FROM in_pet_events),
""" + _FOLD_SQL, "in_pet_events"))
def q_pet_replay(t):
    return lc.pet_replay(t.in_pet_events)


# the game loop over the same log: a tick every day after a player's first event, up to NOW
_LOOP_PERIOD_US = 86400 * 1000000
_LOOP_SQL = f"""WITH RECURSIVE ev0 AS (SELECT player, ts, seq, action FROM in_pet_events),
gaps AS (
  SELECT player, epoch_us(lag(ts) OVER (PARTITION BY player ORDER BY ts, seq)) AS lo, epoch_us(ts) AS hi FROM ev0
  UNION ALL
  SELECT player, epoch_us(max(ts)), epoch_us({NOW_SQL}) FROM ev0 GROUP BY player),
loop_ticks AS (
  SELECT player, make_timestamp(k * {_LOOP_PERIOD_US}) AS ts, CAST({lc.LOOP_TICK_SEQ} AS BIGINT) AS seq, 'tick' AS action
    FROM (SELECT player, unnest(generate_series(lo // {_LOOP_PERIOD_US} + 1,
                 least(hi // {_LOOP_PERIOD_US}, lo // {_LOOP_PERIOD_US} + {lc.TICKS_THAT_MATTER}))) AS k
            FROM gaps WHERE lo IS NOT NULL)),
ev AS (SELECT player, ts, seq, action, row_number() OVER (PARTITION BY player ORDER BY ts, seq) AS rn
         FROM (SELECT * FROM ev0 UNION ALL SELECT * FROM loop_ticks)),"""


@query("pet_game_loop", W(_LOOP_SQL + "\n" + _FOLD_SQL, "in_pet_events"))
def q_pet_game_loop(t):
    return lc.pet_replay(t.in_pet_events, tick_period="1 day", until=NOW)


# ---------------------------------------------------------------- retrieval
from quarry.operators import retrieval as rv  # noqa: E402
from quarry.sources.testdata import QUESTION_VEC_ID  # noqa: E402


def _question_vector(t: TestTables):
    # one vector (a bounded scalar) fetched for the query literal
    row = t.in_embeddings.filter(F.col("embedding_id") == QUESTION_VEC_ID).select("embedding").first()
    return list(row[0])


def _r6(df: DataFrame, col: str = "distance") -> DataFrame:
    return df.withColumn(col, F.round(F.col(col), 6))


_QDIST_RAW = (f"list_distance(CAST(e.embedding AS DOUBLE[]), CAST((SELECT embedding FROM in_embeddings "
              f"WHERE embedding_id = {QUESTION_VEC_ID}) AS DOUBLE[]))")
_QDIST = f"round({_QDIST_RAW}, 6)"
_TOPK_SQL = f"""matches AS (SELECT embedding_id, article_id, {_QDIST} AS distance FROM in_embeddings e
  ORDER BY distance NULLS LAST, embedding_id LIMIT 10),
scored AS (SELECT *, count(*) OVER (PARTITION BY article_id) AS score FROM matches),
winners AS (SELECT * FROM scored ORDER BY score DESC, distance NULLS LAST, embedding_id LIMIT 3),
ranked AS (SELECT *, CAST(row_number() OVER (ORDER BY score DESC, distance NULLS LAST, embedding_id) AS INTEGER) AS ref_no FROM winners),
ctx AS (SELECT r.ref_no, a.title, e.chunk FROM in_embeddings e JOIN ranked r USING (embedding_id, article_id)
  JOIN in_articles a USING (article_id)),
refs AS (SELECT string_agg('Reference ' || ref_no || ' from ' || title || chr(10) || chr(10) || chunk || chr(10) || chr(10), ''
  ORDER BY ref_no) AS refs FROM ctx)"""


@query("vector_topk", W(f"WITH {_TOPK_SQL} SELECT embedding_id, article_id, distance FROM matches", "in_embeddings", "in_articles"))
def q_vector_topk(t):
    return _r6(rv.vector_topk(t.in_embeddings, _question_vector(t)))


@query("article_score", W(f"WITH {_TOPK_SQL} SELECT embedding_id, article_id, distance, score FROM scored",
                          "in_embeddings", "in_articles"))
def q_article_score(t):
    return rv.article_score(_r6(rv.vector_topk(t.in_embeddings, _question_vector(t))))


@query("rerank_top3", W(f"WITH {_TOPK_SQL} SELECT embedding_id, article_id, distance, score FROM winners",
                        "in_embeddings", "in_articles"))
def q_rerank_top3(t):
    return rv.rerank_top3(_r6(rv.vector_topk(t.in_embeddings, _question_vector(t))))


def _context(t):
    top = rv.rerank_top3(_r6(rv.vector_topk(t.in_embeddings, _question_vector(t))))
    return rv.fetch_context(top, t.in_embeddings, t.in_articles)


@query("fetch_context", W(f"WITH {_TOPK_SQL} SELECT ref_no, title, chunk FROM ctx", "in_embeddings", "in_articles"))
def q_fetch_context(t):
    return _context(t)


@query("build_references", W(f"WITH {_TOPK_SQL} SELECT refs FROM refs", "in_embeddings", "in_articles"))
def q_build_references(t):
    return rv.build_references(_context(t))


_HEAD, _REST = rv.PROMPT_TEMPLATE.split("{refs}")
_MID, _TAIL = _REST.split("{q}")


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_PROMPT_SQL = (f"SELECT refs, {_sql_str(_HEAD)} || refs || {_sql_str(_MID)} || "
               f"(SELECT chunk FROM in_embeddings WHERE embedding_id = {QUESTION_VEC_ID}) || {_sql_str(_TAIL)} AS prompt FROM refs")


@query("build_prompt", W(f"WITH {_TOPK_SQL} {_PROMPT_SQL}", "in_embeddings", "in_articles"))
def q_build_prompt(t):
    question = t.in_embeddings.filter(F.col("embedding_id") == QUESTION_VEC_ID).select("chunk").first()[0]
    return rv.build_prompt(rv.build_references(_context(t)), question)


@query("retrieve", W(f"WITH {_TOPK_SQL.replace(_QDIST, _QDIST_RAW)} {_PROMPT_SQL}", "in_embeddings", "in_articles"))
def q_retrieve(t):
    question = t.in_embeddings.filter(F.col("embedding_id") == QUESTION_VEC_ID).select("chunk").first()[0]
    return rv.retrieve(t.in_embeddings, t.in_articles, _question_vector(t), question)


# every chunk vector is a question: its 10 nearest chunk vectors (whole table, exact)
@query("vector_topk_batch", W("""
SELECT * FROM (
  SELECT q.embedding_id AS qid, e.embedding_id, e.article_id,
         round(list_distance(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 6) AS distance,
         CAST(row_number() OVER (PARTITION BY q.embedding_id ORDER BY list_distance(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), e.embedding_id) AS INTEGER) AS rank
    FROM in_embeddings q, in_embeddings e) WHERE rank <= 10""", "in_embeddings"))
def q_vector_topk_batch(t):
    qs = t.in_embeddings.select(F.col("embedding_id").alias("qid"), F.col("embedding").alias("qvec"))
    return _r6(rv.vector_topk_batch(t.in_embeddings, qs))


from quarry.plans.oracle_vectors import buckets_sql  # noqa: E402
from quarry.sources.testdata import EMBEDDING_WIDTH  # noqa: E402

# the index of the test vectors: BucketedRandomProjectionLSH defaults of index_vectors
_LSH = dict(seed=7, num_tables=4, dim=EMBEDDING_WIDTH, bucket_length=2.0)
_LSH_SQL = buckets_sql("in_embeddings", "embedding_id", "embedding", **_LSH)


# every chunk vector is a question (its chunk text is the question): references and prompt for each
@query("retrieve_batch", W(f"""WITH d AS (
  SELECT q.embedding_id AS qid, e.embedding_id, e.article_id,
         list_distance(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) AS distance
    FROM in_embeddings q, in_embeddings e),
top AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY qid ORDER BY distance NULLS LAST, embedding_id) <= 10),
scored AS (SELECT *, count(*) OVER (PARTITION BY qid, article_id) AS score FROM top),
win AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, distance NULLS LAST, embedding_id) AS ref_no
          FROM scored QUALIFY ref_no <= 3),
ctx AS (SELECT w.qid, w.ref_no, a.title, e.chunk FROM win w JOIN in_embeddings e USING (embedding_id, article_id)
          JOIN in_articles a USING (article_id)),
refs AS (SELECT qid, string_agg('Reference ' || ref_no || ' from ' || title || chr(10) || chr(10) || chunk || chr(10) || chr(10), ''
          ORDER BY ref_no) AS refs FROM ctx GROUP BY qid)
SELECT r.qid, r.refs, {_sql_str(_HEAD)} || r.refs || {_sql_str(_MID)} || q.chunk || {_sql_str(_TAIL)} AS prompt
  FROM refs r JOIN in_embeddings q ON q.embedding_id = r.qid""", "in_embeddings", "in_articles"))
def q_retrieve_batch(t):
    qs = t.in_embeddings.select(F.col("embedding_id").alias("qid"), F.col("embedding").alias("qvec"),
                                F.col("chunk").alias("question"))
    return rv.retrieve_batch(t.in_embeddings, t.in_articles, qs)


@query("vector_topk_lsh", W(f"""WITH {_LSH_SQL},
probe AS (SELECT lb."table", lb.bucket FROM lsh_buckets lb WHERE lb.embedding_id = {QUESTION_VEC_ID}),
cand AS (SELECT DISTINCT lb.embedding_id FROM lsh_buckets lb JOIN probe USING ("table", bucket))
SELECT embedding_id, article_id, round(d, 6) AS distance FROM (
  SELECT e.embedding_id, e.article_id, {_QDIST_RAW} AS d
    FROM in_embeddings e JOIN cand USING (embedding_id)
   ORDER BY d NULLS LAST, e.embedding_id LIMIT 10)""", "in_embeddings"))
def q_vector_topk_lsh(t):
    return _r6(rv.vector_topk_lsh(t.in_embeddings, _question_vector(t)))


# the vectors whose id is divisible by 50 ask: their 10 nearest, found over a proximity graph.  The SQL gives the exact
# answer; the search is approximate, and finds all of it at the sizes where the SQL is compared (recall in the README)
@query("vector_topk_graph", W("""
SELECT * FROM (
  SELECT q.embedding_id AS qid, e.embedding_id, e.article_id,
         round(list_distance(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 6) AS distance,
         CAST(row_number() OVER (PARTITION BY q.embedding_id ORDER BY list_distance(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), e.embedding_id) AS INTEGER) AS rank
    FROM in_embeddings q, in_embeddings e WHERE q.embedding_id % 50 = 0) WHERE rank <= 10""", "in_embeddings"))
def q_vector_topk_graph(t):
    from quarry.operators.graph_index import vector_topk_graph

    qs = t.in_embeddings.where("embedding_id % 50 = 0").select(F.col("embedding_id").alias("qid"), F.col("embedding").alias("qvec"))
    return _r6(vector_topk_graph(t.in_embeddings.select("embedding_id", "article_id", "embedding"), qs)).drop("compared")


@query("index_vectors", W(f'WITH {_LSH_SQL} SELECT embedding_id, "table", bucket FROM lsh_buckets', "in_embeddings"))
def q_index_vectors(t):
    model, v = rv.index_vectors(t.in_embeddings)
    return rv.lsh_buckets(model, v)


@query("chat_field", "SELECT event_id, props, json_extract_string(props, '$.k') AS k FROM events")
def q_chat_field(t):
    return rv.chat_field(t.base("events").select("event_id", "props"), "props", "k")


# ---------------------------------------------------------------- corpus
from quarry.operators import corpus as cp  # noqa: E402

_FM_SQL = r"""fm AS (
  SELECT path, regexp_split_to_array(regexp_replace(text, '\r\n?', chr(10), 'g'), '(?m)^[^\S\n]*---[^\S\n]*(?:\n|$)') AS pieces FROM in_markdown),
parsed AS (
  SELECT path, array_to_string(list_filter(pieces, lambda x, i: i % 2 = 1), '') AS content,
         array_to_string(list_filter(pieces, lambda x, i: i % 2 = 0), '') AS header FROM fm),
kv AS (
  SELECT path, content, map_from_entries(list_transform(
           list_filter(string_split(header, chr(10)), lambda l: trim(l) <> '' AND trim(regexp_extract(l, '^([^:]*):', 1)) <> ''),
           lambda l: {'k': trim(regexp_extract(l, '^([^:]*):', 1)),
                 'v': regexp_replace(trim(regexp_extract(l, '^[^:]*:(.*)$', 1)), '^"(.*)"$|^''(.*)''$', '\1\2')})) AS headers
    FROM parsed)"""


@query("parse_front_matter", W(f"""WITH {_FM_SQL}
SELECT path, headers['author'] AS author, headers['title'] AS title, headers['date'] AS date, content FROM kv""", "in_markdown"))
def q_parse_front_matter(t):
    p = cp.parse_front_matter(t.in_markdown)
    h = F.col("headers")
    return p.select("path", h["author"].alias("author"), h["title"].alias("title"), h["date"].alias("date"), "content")


_ARTICLES_SQL = """SELECT path, headers['author'] AS author, headers['title'] AS title, content,
       CAST(timezone('UTC', CAST(headers['date'] AS TIMESTAMPTZ)) AS DATE) AS publish_date FROM kv"""


# documents under a nested header, read back by typed paths
@query("parse_front_matter_yaml", """
SELECT doc_id, source AS author, [lang, 'x: y'] AS langs, CAST(doc_id % 100 AS INTEGER) AS rank, n_chars AS chars, doc_id % 2 = 0 AS draft,
       DATE '2024-03-29' AS published, 'first line' || chr(10) || '  second of ' || source || chr(10) AS note,
       'n' || doc_id AS second_tag, sha256('Text' || chr(10) || '> ' || translate(coalesce(text, ''), chr(13) || chr(10), '  ')) AS content_sha256
  FROM documents""")
def q_parse_front_matter_yaml(t):
    from quarry.operators.front_matter import header_get, parse_front_matter_yaml

    body = F.concat(F.lit("> "), F.translate(F.coalesce("text", F.lit("")), "\r\n", "  "))  # one line, so no fence in it
    lines = ["author: &who", "  name: {source}", "  langs: [{lang}, 'x: y']", "tags:", "- {lang}", "- label: n{doc_id}", "  rank: {rank}",
             "stats: {chars: {n_chars}, draft: {draft}} # counted", "published: 2024-03-29", "note: |", "  first line", "    second of {source}", "editor: *who"]
    header = F.lit("\n".join(lines))
    values = {"source": F.col("source"), "lang": F.col("lang"), "doc_id": F.col("doc_id").cast("string"), "n_chars": F.col("n_chars").cast("string"),
              "rank": (F.col("doc_id") % 100).cast("string"), "draft": F.when(F.col("doc_id") % 2 == 0, "yes").otherwise("no")}
    for name, value in values.items():
        header = F.replace(header, F.lit("{" + name + "}"), value)
    text = F.concat(F.lit("---\n"), header, F.lit("\n---\nText\n"), body)
    parsed = parse_front_matter_yaml(t.base("documents").select("doc_id", text.alias("text")))
    meta = F.col("meta")
    return parsed.select("doc_id", header_get(meta, "$.editor.name", "string").alias("author"), header_get(meta, "$.author.langs", "array<string>").alias("langs"),
                         header_get(meta, "$.tags[1].rank", "int").alias("rank"), header_get(meta, "$.stats.chars", "bigint").alias("chars"),
                         header_get(meta, "$.stats.draft", "boolean").alias("draft"), header_get(meta, "$.published", "date").alias("published"),
                         header_get(meta, "$.note", "string").alias("note"), header_get(meta, "$.tags[1].label", "string").alias("second_tag"),
                         F.sha2(F.col("content").cast("binary"), 256).alias("content_sha256"))


@query("articles", W(f"WITH {_FM_SQL} {_ARTICLES_SQL}", "in_markdown"))
def q_articles(t):
    ok, _bad = cp.articles(cp.parse_front_matter(t.in_markdown))
    return ok


@query("assign_ids", W(f"WITH {_FM_SQL}, arts AS ({_ARTICLES_SQL}) SELECT row_number() OVER (ORDER BY path) AS article_id, path, title FROM arts",
                       "in_markdown"))
def q_assign_ids(t):
    ok, _bad = cp.articles(cp.parse_front_matter(t.in_markdown))
    return cp.assign_ids(ok.select("path", "title"), ["path"], col="article_id").select("article_id", "path", "title")


from quarry.plans.oracle_chunks import chunk_sql, embed_sql  # noqa: E402

_CHUNKS_SQL = W("WITH " + chunk_sql("in_articles", "article_id", "content")
                + "\nSELECT article_id, chunk_no, chunk FROM chunks", "in_articles")


@query("chunk_text", _CHUNKS_SQL)
def q_chunk_text(t):
    return cp.chunk_text(t.in_articles, "article_id", "content")


@query("embed_chunks", W("WITH " + chunk_sql("in_articles", "article_id", "content") + ",\n"
                          + embed_sql("chunks", ["article_id", "chunk_no"], "chunk", cp.EMBED_DIM)
                          + "\nSELECT c.article_id, c.chunk_no, c.chunk, e.embedding FROM chunks c "
                          "JOIN embedded e USING (article_id, chunk_no)", "in_articles"))
def q_embed_chunks(t):
    return cp.embed_chunks(cp.chunk_text(t.in_articles, "article_id", "content"), "chunk")


@query("write_articles", W(f"WITH {_FM_SQL}, arts AS ({_ARTICLES_SQL}) SELECT row_number() OVER (ORDER BY path) AS article_id, path, author, title, content, publish_date FROM arts",
                           "in_markdown"))
def q_write_articles(t):
    from quarry.session import scratch_path
    from quarry.sources.corpus import write_articles

    ok, _bad = cp.articles(cp.parse_front_matter(t.in_markdown))
    out = scratch_path(t.spark, "articles")
    write_articles(cp.assign_ids(ok, ["path"], col="article_id"), out)
    return t.spark.read.parquet(out).select("article_id", "path", "author", "title", "content", "publish_date")


# imported twice: the second import appends the same articles under ids that go on
@query("append_articles", W(f"""WITH {_FM_SQL}, arts AS ({_ARTICLES_SQL}),
twice AS (SELECT n, path, title, publish_date FROM arts, (VALUES (1), (2)) AS imports(n))
SELECT row_number() OVER (ORDER BY n, path) AS article_id, path, title, publish_date FROM twice""", "in_markdown"))
def q_append_articles(t):
    from quarry.session import scratch_path
    from quarry.sources.corpus import append_articles

    ok, _bad = cp.articles(cp.parse_front_matter(t.in_markdown))
    out = scratch_path(t.spark, "append-articles")
    for _ in range(2):
        append_articles(ok, out)
    return t.spark.read.parquet(out).select("article_id", "path", "title", "publish_date")


@query("write_chunks", _CHUNKS_SQL)
def q_write_chunks(t):
    from quarry.session import scratch_path
    from quarry.sources.corpus import write_chunks

    out = scratch_path(t.spark, "chunks")
    write_chunks(cp.chunk_text(t.in_articles, "article_id", "content"), out)
    return t.spark.read.parquet(out)


# ---------------------------------------------------------------- sensor log
from quarry.operators import sensor as sn  # noqa: E402


@query("log_lookup", W(f"SELECT id, location, reading, reading_date FROM in_sensor_log WHERE location = '{SENSOR}' ORDER BY reading_date, id",
                       "in_sensor_log"))
def q_log_lookup(t):
    return sn.log_lookup(t.in_sensor_log, SENSOR)


# a week of every location, from a log in Z-order of location and time
@query("log_window", W("SELECT id, location, reading, reading_date FROM in_sensor_log "
                       "WHERE reading_date >= TIMESTAMP '2024-01-08' AND reading_date < TIMESTAMP '2024-01-15'", "in_sensor_log"))
def q_log_window(t):
    from quarry.session import scratch_path
    from quarry.sources.clustered_log import write_log_clustered

    path = scratch_path(t.spark, "clustered-log")
    write_log_clustered(t.in_sensor_log, path)
    return sn.log_window(t.spark.read.parquet(path), since="2024-01-08", until="2024-01-15")


# ---------------------------------------------------------------- streaming
from quarry.streaming import jobs as sj  # noqa: E402


def _streamed(t: TestTables, name: str) -> TestTables:
    return TestTables(t.spark, t.sf_dir, overrides={name: t.stream(name)})


def _run(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


@query("append_log", ORACLE_SENSOR := W("SELECT id, location, reading, reading_date FROM in_sensor_log", "in_sensor_log"))
def q_append_log(t):
    from quarry.session import scratch_path

    readings = _streamed(t, "events").in_sensor_log
    sink, ckpt = scratch_path(t.spark, "sensor-log"), scratch_path(t.spark, "sensor-log-ckpt")
    _run(sj.start_append_log(readings, sink, ckpt))
    return t.spark.read.parquet(sink).select("id", "location", "reading", "reading_date")


# identity-style ids: the whole log arrives without ids
@query("append_log_ids", W("""SELECT row_number() OVER (ORDER BY reading_date, location, reading) AS id, location, reading, reading_date
  FROM in_sensor_log""", "in_sensor_log"))
def q_append_log_ids(t):
    from quarry.session import scratch_path

    readings = _streamed(t, "events").in_sensor_log.drop("id")
    sink, ckpt = scratch_path(t.spark, "sensor-log"), scratch_path(t.spark, "sensor-log-ckpt")
    _run(sj.start_append_log(readings, sink, ckpt))
    return sj.read_log(t.spark, sink)


# the same log written as units: ids come from the manifest, a batch counts once
@query("append_log_units", ORACLE["append_log_ids"])
def q_append_log_units(t):
    from quarry.session import scratch_path
    from quarry.sources.unit_log import append_unit, read_units

    sink, ckpt = scratch_path(t.spark, "unit-log"), scratch_path(t.spark, "unit-log-ckpt")

    def write(batch, batch_id):
        append_unit(batch, sink, ["reading_date", "location", "reading"], producer="sensors", batch=batch_id)

    readings = _streamed(t, "events").in_sensor_log.select("location", "reading", "reading_date")
    _run(readings.writeStream.foreachBatch(write).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    return read_units(t.spark, sink, readings.schema)


@query("auth_audit", W(f"""SELECT c_name AS username, c_name IN ({_MEMBERS_SQL} AND NOT u.rolsuper) AS allowed FROM customer""",
                       "in_authid", "in_auth_members"))
def q_auth_audit(t):
    from quarry.session import scratch_path

    requests = t.stream("customer").select(F.col("c_name").alias("username"))

    def allowed(_spark):
        return ax.role_members_nosuper(t.in_authid, t.in_auth_members, PROXY_ROLE)

    sink, ckpt = scratch_path(t.spark, "auth-audit"), scratch_path(t.spark, "auth-audit-ckpt")
    _run(sj.start_auth_audit(requests, allowed, sink, ckpt))
    return sj.read_audit(t.spark, sink)


@query("embed_incremental", W("WITH " + embed_sql("in_chunks", ["chunk_id"], "chunk", cp.EMBED_DIM)
                               + "\nSELECT c.chunk_id, c.article_id, c.last_updated, e.embedding FROM in_chunks c "
                               "JOIN embedded e USING (chunk_id)", "in_chunks"))
def q_embed_incremental(t):
    from quarry.session import scratch_path

    chunks = _streamed(t, "documents").in_chunks
    sink, ckpt = scratch_path(t.spark, "embeddings"), scratch_path(t.spark, "embeddings-ckpt")
    _run(sj.start_embed_incremental(chunks, sink, ckpt))
    return sj.read_embeddings(t.spark, sink)


# the whole corpus inserted, every 5th chunk revised, every 7th deleted; compaction; every 35th back under a new text
@query("embed_table", W("WITH edited AS (SELECT chunk_id, article_id, CASE WHEN chunk_id % 35 = 0 THEN 'back ' || coalesce(chunk, '') "
                         "WHEN chunk_id % 5 = 0 THEN coalesce(chunk, '') || ' revised' ELSE chunk END AS chunk, "
                         "CASE WHEN chunk_id % 35 = 0 THEN last_updated + INTERVAL 3 DAY WHEN chunk_id % 5 = 0 THEN last_updated + INTERVAL 1 DAY "
                         "ELSE last_updated END AS last_updated FROM in_chunks WHERE chunk_id % 7 <> 0 OR chunk_id % 35 = 0), "
                         + embed_sql("edited", ["chunk_id"], "chunk", cp.EMBED_DIM)
                         + "\nSELECT c.chunk_id, c.article_id, c.last_updated, e.embedding FROM edited c "
                         "JOIN embedded e USING (chunk_id)", "in_chunks"))
def q_embed_table(t):
    from quarry.session import scratch_path
    from quarry.sources import embedding_table as et

    path = scratch_path(t.spark, "embedding-table")
    chunk, at = F.coalesce("chunk", F.lit("")), F.col("last_updated")
    here, gone = F.lit(False), F.lit(True)

    def changes(rows, text, days, deleted):
        return rows.select("chunk_id", "article_id", text.alias("chunk"), (at + F.expr(f"INTERVAL {days} DAY")).alias("last_updated"),
                           deleted.alias("deleted"))

    c = t.in_chunks
    et.apply_changes(changes(c, F.col("chunk"), 0, here), path, 0)
    et.apply_changes(changes(c.where("chunk_id % 5 = 0"), F.concat(chunk, F.lit(" revised")), 1, here), path, 1)
    et.apply_changes(changes(c.where("chunk_id % 7 = 0"), F.col("chunk"), 2, gone), path, 2)
    et.compact(t.spark, path)
    et.apply_changes(changes(c.where("chunk_id % 35 = 0"), F.concat(F.lit("back "), chunk), 3, here), path, 3)
    return et.read_embedding_table(t.spark, path)


@query("pet_replay_stream", ORACLE["pet_replay"])
def q_pet_replay_stream(t):
    from quarry.session import scratch_path

    events = _streamed(t, "events").in_pet_events
    sink, ckpt = scratch_path(t.spark, "pets"), scratch_path(t.spark, "pets-ckpt")
    _run(sj.start_pet_replay(events, sink, ckpt))
    return sj.read_pet_states(t.spark, sink)


# the log arrives in three parts that overlap in time; the last one brings events from before all others
@query("pet_replay_any_order", ORACLE["pet_replay"])
def q_pet_replay_any_order(t):
    from quarry.session import scratch_path
    from quarry.streaming.pet_late import apply_events, read_late_states

    path = scratch_path(t.spark, "pets-any-order")
    e = t.in_pet_events
    for n in range(3):
        apply_events(e.where(F.pmod(F.xxhash64("seq"), F.lit(3)) == n), path, n, lateness="36500 days", fold_every=2)
    return read_late_states(t.spark, path)


# ---------------------------------------------------------------- sources
@query("scan_snapshot", W("SELECT * FROM in_class", "in_class"))
def q_scan_snapshot(t):
    from quarry.session import scratch_path
    from quarry.sources.logs import scan_snapshot

    path = scratch_path(t.spark, "pg_class")
    t.in_class.write.parquet(path)
    return scan_snapshot(t.spark, path)


@query("scan_corpus", W("SELECT path, text FROM in_markdown", "in_markdown"))
def q_scan_corpus(t):
    """Export every mapped document as its own Markdown file, then scan the folder."""
    from quarry.session import scratch_path
    from quarry.sources.corpus import export_markdown, scan_corpus

    root = scratch_path(t.spark, "corpus")
    export_markdown(t.in_markdown, root)
    return scan_corpus(t.spark, root, recursive=True, logical_names=True)


# the same corpus as one ``*.md`` file a document, read by the data source
@query("scan_markdown", W("SELECT path, text FROM in_markdown", "in_markdown"))
def q_scan_markdown(t):
    from quarry.session import scratch_path, ship_package
    from quarry.sources.markdown import export_markdown_files, scan_markdown

    ship_package(t.spark)
    folder = scratch_path(t.spark, "markdown")
    export_markdown_files(t.in_markdown, folder)
    return scan_markdown(t.spark, folder).select("path", "text")
