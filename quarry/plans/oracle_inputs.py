"""DuckDB SQL for the operator inputs derived from the test tables.

Mirror of ``quarry.sources.testdata``: each entry is the body of a CTE over the
base tables the driver registers.  ``with_inputs`` prefixes a query with the CTEs
it needs, in dependency order.
"""

from __future__ import annotations

INPUTS: dict[str, str] = {
    "in_namespace": "SELECT * FROM (VALUES (0,'public'),(1,'pg_catalog'),(2,'sales'),(3,'information_schema'),(4,'pg_toast')) AS t(oid, nspname)",
    "in_type": "SELECT * FROM (VALUES (1,'int8','d',8),(2,'int4','i',4),(3,'text','i',-1),(4,'bool','c',1),(5,'timestamptz','d',8)) AS t(oid, typname, typalign, typlen)",
    "in_class": """SELECT p_partkey AS oid, concat('rel_', p_partkey) AS relname, p_partkey AS relfilenode,
       CAST(p_partkey % 5 AS INT) AS relnamespace,
       CASE CAST(p_partkey % 7 AS INT) WHEN 0 THEN 'p' WHEN 1 THEN 'm' WHEN 2 THEN 'i' ELSE 'r' END AS relkind,
       p_size - 1 AS relpages, p_retailprice AS reltuples,
       CASE WHEN p_partkey % 3 = 0 THEN p_partkey + 1 END AS reltoastrelid,
       CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(p_size AS BIGINT) * 5000000 END AS frozen_age
  FROM part""",
    "in_attribute": """SELECT p_partkey AS attrelid, concat('col_', n) AS attname, n AS attnum,
       CAST((p_partkey + n + 5) % 5 AS INT) + 1 AS atttypid
  FROM (SELECT p_partkey, unnest([-1, 1, 2, 3, 4]) AS n FROM part)""",
    "in_buffercache": "SELECT l_orderkey * 10 + l_linenumber AS bufferid, l_partkey AS relfilenode FROM lineitem",
    "in_user_tables": """SELECT l_suppkey AS relid, l_returnflag AS schemaname, concat('t', l_suppkey) AS relname,
       CAST(l_quantity AS BIGINT) AS n_tup_ins, CAST(l_linenumber AS BIGINT) AS n_tup_upd,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS BIGINT) % 3 END AS n_tup_del
  FROM lineitem""",
    "in_table_reads": """SELECT p_partkey AS relid, p_brand AS schemaname, concat('rel_', p_partkey) AS relname, CAST(p_size AS BIGINT) AS seq_scan,
       CASE WHEN p_size % 5 = 0 THEN NULL ELSE CAST(p_size AS BIGINT) * 2 END AS idx_scan,
       CASE WHEN p_size % 5 = 0 THEN NULL ELSE CAST(p_size AS BIGINT) * 20 END AS idx_tup_fetch
  FROM part""",
    "in_segment": "SELECT seg, -(CAST(('0x' || substr(md5(seg), 1, 15)) AS BIGINT) + 1) AS oid FROM (SELECT DISTINCT c_mktsegment AS seg FROM customer) AS s",
    "in_authid": """SELECT 1000000 + c_custkey AS oid, c_name AS rolname, concat('h', c_custkey) AS rolpassword, c_custkey % 17 = 0 AS rolsuper, c_custkey % 5 <> 0 AS rolcanlogin FROM customer
UNION ALL SELECT CAST(100 + n_nationkey AS BIGINT), n_name, CAST(NULL AS VARCHAR), false, false FROM nation
UNION ALL SELECT CAST(10 + r_regionkey AS BIGINT), r_name, CAST(NULL AS VARCHAR), false, false FROM region
UNION ALL SELECT oid, concat('seg_', seg), CAST(NULL AS VARCHAR), false, false FROM in_segment""",
    "in_auth_members": """SELECT CAST(100 + c_nationkey AS BIGINT) AS roleid, 1000000 + c_custkey AS member FROM customer
UNION ALL SELECT CAST(10 + n_regionkey AS BIGINT), CAST(100 + n_nationkey AS BIGINT) FROM nation
UNION ALL SELECT s.oid, 1000000 + c_custkey FROM customer JOIN in_segment AS s ON s.seg = c_mktsegment
UNION ALL SELECT CAST(10 AS BIGINT), oid FROM in_segment""",
    "in_table_privileges": """SELECT c_name AS grantee, 'public' AS table_schema, concat('t_', c_custkey) AS table_name, 'SELECT' AS privilege_type FROM customer
UNION ALL SELECT n_name, 'public', concat('t_n', n_nationkey), 'INSERT' FROM nation
UNION ALL SELECT r_name, 'sales', concat('t_r', r_regionkey), 'UPDATE' FROM region""",
    "in_activity": """SELECT o_orderkey AS pid, o_orderpriority AS wait_event, o_orderstatus AS state, concat('u', o_custkey) AS usename,
       o_orderdate AS query_start, concat('10.0.0.', o_orderkey % 250) AS client_addr, concat('q', o_orderkey) AS query,
       CASE WHEN o_orderkey % 10 = 0 THEN [o_orderkey + 1, o_orderkey + 1, o_orderkey + 2] ELSE CAST([] AS BIGINT[]) END AS blocking_pids
  FROM orders""",
    "in_locks": "SELECT l_orderkey AS pid, l_returnflag AS mode, l_linestatus AS locktype, l_partkey AS relation FROM lineitem",
    "in_prepared": "SELECT o_orderstatus AS database, o_orderdate AS prepared FROM orders",
    "in_slots": """SELECT concat('slot_', o_orderkey) AS slot_name, o_orderkey % 2 = 0 AS active,
       concat(hex(o_custkey % 32), '/', hex(o_orderkey * 4096)) AS restart_lsn,
       CASE WHEN o_orderkey % 3 <> 0 THEN concat(hex(o_custkey % 32), '/', hex(o_orderkey * 4096 + 100)) END AS confirmed_flush_lsn
  FROM orders""",
    "in_replication": """SELECT s_name AS application_name, concat('10.1.0.', s_suppkey % 250) AS client_addr,
       concat('20/', hex(4096 * s_suppkey + 400)) AS sent_lsn, concat('20/', hex(4096 * s_suppkey + 300)) AS write_lsn,
       concat('20/', hex(4096 * s_suppkey + 200)) AS flush_lsn,
       CASE WHEN s_suppkey % 4 <> 0 THEN concat('20/', hex(4096 * s_suppkey + 100)) END AS replay_lsn
  FROM supplier""",
    "in_wal": "SELECT ts AS check_dt, concat(hex(user_id), '/', hex(event_id * 4096)) AS lsn FROM events",
    "in_db_stats": "SELECT ts AS check_dt, event_type AS datname, event_id * 3 AS temp_files, event_id * 1000 AS temp_bytes, event_id AS xact_commit, CAST(user_id AS BIGINT) AS xact_rollback FROM events",
    "in_bgwriter": "SELECT ts AS check_dt, event_id AS checkpoints_timed, user_id AS checkpoints_req, value AS checkpoint_write_time, value / 2 AS checkpoint_sync_time FROM events",
    "in_pet": """SELECT c_name AS player, concat('pet_', c_custkey) AS pet_name, CAST(c_custkey % 31 AS INT) AS mood, CAST((c_custkey * 7) % 27 AS INT) AS food,
       (c_custkey % 31 = 0 OR (c_custkey * 7) % 27 = 0) AS is_dead, CAST('2023-01-01 00:00:00' AS TIMESTAMP) AS birth_date,
       CASE WHEN c_custkey % 31 = 0 OR (c_custkey * 7) % 27 = 0 THEN CAST('2023-06-01 12:30:15' AS TIMESTAMP) END AS death_date
  FROM customer""",
    "in_pet_events": """SELECT concat('u', user_id) AS player, ts, event_id AS seq,
       CASE event_type WHEN 'purchase' THEN 'feed' WHEN 'click' THEN 'train' ELSE 'tick' END AS action FROM events""",
    "in_sensor_log": "SELECT event_id AS id, concat('A', user_id) AS location, CAST(floor(value) AS BIGINT) AS reading, ts AS reading_date FROM events",
    "in_articles": "SELECT doc_id AS article_id, source AS author, concat('Title ', doc_id, ' (', lang, ')') AS title, text AS content, CAST('2024-03-29' AS DATE) AS publish_date FROM documents",
    "in_embeddings": "SELECT vec_id AS embedding_id, CAST(label AS BIGINT) AS article_id, concat('chunk ', vec_id) AS chunk, embedding FROM embeddings",
    "in_chunks": "SELECT doc_id AS chunk_id, doc_id AS article_id, text AS chunk, CAST('2024-03-29 00:00:00' AS TIMESTAMP) AS last_updated FROM documents",
    "in_markdown": """SELECT concat('corpus/', doc_id, '.md') AS path,
       concat('---', chr(10), 'author: ', source, chr(10), 'date: 2024-03-29 16:00:49+00:00', chr(10), 'title: Title ', doc_id, chr(10), '---', chr(10), text) AS text
  FROM documents""",
}

DEPENDS = {"in_authid": ["in_segment"], "in_auth_members": ["in_segment"]}


def with_inputs(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs for ``names`` (dependencies first)."""
    order: list[str] = []

    def add(n):
        for d in DEPENDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS (\n{INPUTS[n]}\n)" for n in order)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[len('WITH RECURSIVE '):]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
