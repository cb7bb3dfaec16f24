"""Input tables for the operators, derived from the driver's parquet test tables.

The test data holds no system catalogs, so every operator input (a snapshot of a
catalog or statistics view, the pet table, the sensor log, the article corpus) is
derived from the TPC-H-like tables with plain column expressions.  The same
derivations exist as DuckDB SQL in ``quarry.plans.oracle_inputs`` so both engines see the
same rows.  Every input reads a whole base table; nothing is filtered down.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import is_folder

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# The small catalogs the mapped snapshots point into.
NAMESPACES = [(0, "public"), (1, "pg_catalog"), (2, "sales"), (3, "information_schema"), (4, "pg_toast")]
TYPES = [(1, "int8", "d", 8), (2, "int4", "i", 4), (3, "text", "i", -1), (4, "bool", "c", 1), (5, "timestamptz", "d", 8)]
ATTRIBUTE_NUMBERS = [-1, 1, 2, 3, 4]

# Parameters used with these inputs.
NOW = "2024-02-01 00:00:00"
CURRENT_LSN = "20/FFFFFFFF"
MAX_FREEZE_AGE = 200000000
PROXY_ROLE = "seg_BUILDING"
SENSOR = "A20"
QUESTION_VEC_ID = 0
# Width of the vectors in the test embeddings table (the LSH oracle rebuilds projections for it).
EMBEDDING_WIDTH = 64


def ntz(s: str):
    return F.lit(s).cast("timestamp_ntz")


class TestTables:
    """Lazily loads base tables of one scale-factor folder and derives operator inputs."""

    def __init__(self, spark: SparkSession, sf_dir: str, overrides: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        # base tables can be replaced, e.g. by a streaming DataFrame over the same files
        self._cache: dict[str, DataFrame] = dict(overrides or {})

    def stream(self, name: str, max_files: int | None = None) -> DataFrame:
        """A base table as a file stream (same schema, files picked up as they appear).

        The table is one file, or a folder of part files.  Part files are in no order of time, so those
        that are there make one micro-batch, unless ``max_files`` cuts it.
        """
        reader = self.spark.readStream.schema(self.base(name).schema)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        path = f"{self.sf_dir}/{name}.parquet"
        if is_folder(self.spark, path):
            return reader.parquet(path)
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(self.sf_dir)

    def base(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]

    # ---- catalogs -----------------------------------------------------------
    @cached_property
    def in_namespace(self) -> DataFrame:
        return self.spark.createDataFrame(NAMESPACES, "oid int, nspname string")

    @cached_property
    def in_type(self) -> DataFrame:
        return self.spark.createDataFrame(TYPES, "oid int, typname string, typalign string, typlen int")

    @cached_property
    def in_class(self) -> DataFrame:
        p = self.base("part")
        k = F.col("p_partkey")
        return p.select(
            k.alias("oid"),
            F.concat(F.lit("rel_"), k).alias("relname"),
            k.alias("relfilenode"),
            (k % 5).cast("int").alias("relnamespace"),
            F.when((k % 7) == 0, "p").when((k % 7) == 1, "m").when((k % 7) == 2, "i").otherwise("r").alias("relkind"),
            (F.col("p_size") - 1).alias("relpages"),
            F.col("p_retailprice").alias("reltuples"),
            F.when((k % 3) == 0, k + 1).alias("reltoastrelid"),
            F.when((k % 11) == 0, F.lit(None)).otherwise(F.col("p_size").cast("bigint") * 5000000).alias("frozen_age"),
        )

    @cached_property
    def in_attribute(self) -> DataFrame:
        p = self.base("part").select("p_partkey", F.explode(F.array(*[F.lit(n) for n in ATTRIBUTE_NUMBERS])).alias("n"))
        return p.select(
            F.col("p_partkey").alias("attrelid"),
            F.concat(F.lit("col_"), F.col("n")).alias("attname"),
            F.col("n").alias("attnum"),
            (((F.col("p_partkey") + F.col("n") + 5) % 5).cast("int") + 1).alias("atttypid"),
        )

    # ---- statistics snapshots ----------------------------------------------
    @cached_property
    def in_buffercache(self) -> DataFrame:
        l = self.base("lineitem")
        return l.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("bufferid"),
                        F.col("l_partkey").alias("relfilenode"))

    @cached_property
    def in_user_tables(self) -> DataFrame:
        l = self.base("lineitem")
        q = F.col("l_quantity").cast("bigint")
        return l.select(
            F.col("l_suppkey").alias("relid"),
            F.col("l_returnflag").alias("schemaname"),
            F.concat(F.lit("t"), F.col("l_suppkey")).alias("relname"),
            q.alias("n_tup_ins"),
            F.col("l_linenumber").cast("bigint").alias("n_tup_upd"),
            F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(q % 3).alias("n_tup_del"),
        )

    @cached_property
    def in_table_reads(self) -> DataFrame:
        p = self.base("part")
        s = F.col("p_size").cast("bigint")
        return p.select(
            F.col("p_partkey").alias("relid"),
            F.col("p_brand").alias("schemaname"),
            F.concat(F.lit("rel_"), F.col("p_partkey")).alias("relname"),
            s.alias("seq_scan"),
            F.when((F.col("p_size") % 5) == 0, F.lit(None)).otherwise(s * 2).alias("idx_scan"),
            F.when((F.col("p_size") % 5) == 0, F.lit(None)).otherwise(s * 20).alias("idx_tup_fetch"),
        )

    # ---- roles ---------------------------------------------------------------
    @cached_property
    def in_segment(self) -> DataFrame:
        # Role oids of the market segments: a 60-bit hash of the name, negated so they never
        # meet the positive oids of the other roles (no global numbering window needed).
        segs = self.base("customer").select(F.col("c_mktsegment").alias("seg")).distinct()
        h = F.conv(F.substring(F.md5(F.col("seg")), 1, 15), 16, 10).cast("bigint")
        return segs.select("seg", (-(h + 1)).alias("oid"))

    @cached_property
    def in_authid(self) -> DataFrame:
        c, n, r = self.base("customer"), self.base("nation"), self.base("region")
        k = F.col("c_custkey")
        null_pw = F.lit(None).cast("string")
        return (
            c.select((F.lit(1000000) + k).alias("oid"), F.col("c_name").alias("rolname"),
                     F.concat(F.lit("h"), k).alias("rolpassword"), ((k % 17) == 0).alias("rolsuper"),
                     ((k % 5) != 0).alias("rolcanlogin"))
            .unionByName(n.select((F.lit(100) + F.col("n_nationkey")).cast("bigint").alias("oid"),
                                  F.col("n_name").alias("rolname"), null_pw.alias("rolpassword"),
                                  F.lit(False).alias("rolsuper"), F.lit(False).alias("rolcanlogin")))
            .unionByName(r.select((F.lit(10) + F.col("r_regionkey")).cast("bigint").alias("oid"),
                                  F.col("r_name").alias("rolname"), null_pw.alias("rolpassword"),
                                  F.lit(False).alias("rolsuper"), F.lit(False).alias("rolcanlogin")))
            .unionByName(self.in_segment.select("oid", F.concat(F.lit("seg_"), F.col("seg")).alias("rolname"),
                                                null_pw.alias("rolpassword"), F.lit(False).alias("rolsuper"),
                                                F.lit(False).alias("rolcanlogin")))
        )

    @cached_property
    def in_auth_members(self) -> DataFrame:
        c, n = self.base("customer"), self.base("nation")
        seg = self.in_segment
        return (
            c.select((F.lit(100) + F.col("c_nationkey")).cast("bigint").alias("roleid"),
                     (F.lit(1000000) + F.col("c_custkey")).alias("member"))
            .unionByName(n.select((F.lit(10) + F.col("n_regionkey")).cast("bigint").alias("roleid"),
                                  (F.lit(100) + F.col("n_nationkey")).cast("bigint").alias("member")))
            .unionByName(c.join(seg, seg.seg == c.c_mktsegment)
                         .select(F.col("oid").alias("roleid"), (F.lit(1000000) + F.col("c_custkey")).alias("member")))
            .unionByName(seg.select(F.lit(10).cast("bigint").alias("roleid"), F.col("oid").alias("member")))
        )

    @cached_property
    def in_table_privileges(self) -> DataFrame:
        c, n, r = self.base("customer"), self.base("nation"), self.base("region")
        return (
            c.select(F.col("c_name").alias("grantee"), F.lit("public").alias("table_schema"),
                     F.concat(F.lit("t_"), F.col("c_custkey")).alias("table_name"), F.lit("SELECT").alias("privilege_type"))
            .unionByName(n.select(F.col("n_name").alias("grantee"), F.lit("public").alias("table_schema"),
                                  F.concat(F.lit("t_n"), F.col("n_nationkey")).alias("table_name"),
                                  F.lit("INSERT").alias("privilege_type")))
            .unionByName(r.select(F.col("r_name").alias("grantee"), F.lit("sales").alias("table_schema"),
                                  F.concat(F.lit("t_r"), F.col("r_regionkey")).alias("table_name"),
                                  F.lit("UPDATE").alias("privilege_type")))
        )

    # ---- sessions and locks --------------------------------------------------
    @cached_property
    def in_activity(self) -> DataFrame:
        o = self.base("orders")
        pid = F.col("o_orderkey")
        return o.select(
            pid.alias("pid"),
            F.col("o_orderpriority").alias("wait_event"),
            F.col("o_orderstatus").alias("state"),
            F.concat(F.lit("u"), F.col("o_custkey")).alias("usename"),
            F.col("o_orderdate").alias("query_start"),
            F.concat(F.lit("10.0.0."), pid % 250).alias("client_addr"),
            F.concat(F.lit("q"), pid).alias("query"),
            F.when((pid % 10) == 0, F.array(pid + 1, pid + 1, pid + 2))
             .otherwise(F.array().cast("array<bigint>")).alias("blocking_pids"),
        )

    @cached_property
    def in_locks(self) -> DataFrame:
        return self.base("lineitem").select(
            F.col("l_orderkey").alias("pid"), F.col("l_returnflag").alias("mode"),
            F.col("l_linestatus").alias("locktype"), F.col("l_partkey").alias("relation"))

    @cached_property
    def in_prepared(self) -> DataFrame:
        return self.base("orders").select(F.col("o_orderstatus").alias("database"), F.col("o_orderdate").alias("prepared"))

    # ---- replication / WAL -----------------------------------------------------
    @cached_property
    def in_slots(self) -> DataFrame:
        o = self.base("orders")
        k, c = F.col("o_orderkey"), F.col("o_custkey")
        return o.select(
            F.concat(F.lit("slot_"), k).alias("slot_name"),
            ((k % 2) == 0).alias("active"),
            F.concat(F.hex(c % 32), F.lit("/"), F.hex(k * 4096)).alias("restart_lsn"),
            F.when((k % 3) != 0, F.concat(F.hex(c % 32), F.lit("/"), F.hex(k * 4096 + 100))).alias("confirmed_flush_lsn"),
        )

    @cached_property
    def in_replication(self) -> DataFrame:
        s = self.base("supplier")
        k = F.col("s_suppkey")

        def lsn(off):
            return F.concat(F.lit("20/"), F.hex(k * 4096 + off))

        return s.select(
            F.col("s_name").alias("application_name"),
            F.concat(F.lit("10.1.0."), k % 250).alias("client_addr"),
            lsn(400).alias("sent_lsn"), lsn(300).alias("write_lsn"), lsn(200).alias("flush_lsn"),
            F.when((k % 4) != 0, lsn(100)).alias("replay_lsn"),
        )

    @cached_property
    def in_wal(self) -> DataFrame:
        e = self.base("events")
        return e.select(F.col("ts").alias("check_dt"),
                        F.concat(F.hex(F.col("user_id")), F.lit("/"), F.hex(F.col("event_id") * 4096)).alias("lsn"))

    @cached_property
    def in_db_stats(self) -> DataFrame:
        e = self.base("events")
        return e.select(
            F.col("ts").alias("check_dt"), F.col("event_type").alias("datname"),
            (F.col("event_id") * 3).alias("temp_files"), (F.col("event_id") * 1000).alias("temp_bytes"),
            F.col("event_id").alias("xact_commit"), F.col("user_id").cast("bigint").alias("xact_rollback"),
        )

    @cached_property
    def in_bgwriter(self) -> DataFrame:
        e = self.base("events")
        return e.select(
            F.col("ts").alias("check_dt"), F.col("event_id").alias("checkpoints_timed"),
            F.col("user_id").alias("checkpoints_req"), F.col("value").alias("checkpoint_write_time"),
            (F.col("value") / 2).alias("checkpoint_sync_time"),
        )

    # ---- lifecycle ---------------------------------------------------------------
    @cached_property
    def in_pet(self) -> DataFrame:
        c = self.base("customer")
        k = F.col("c_custkey")
        dead = ((k % 31) == 0) | (((k * 7) % 27) == 0)
        return c.select(
            F.col("c_name").alias("player"),
            F.concat(F.lit("pet_"), k).alias("pet_name"),
            (k % 31).cast("int").alias("mood"),
            ((k * 7) % 27).cast("int").alias("food"),
            dead.alias("is_dead"),
            ntz("2023-01-01 00:00:00").alias("birth_date"),
            F.when(dead, ntz("2023-06-01 12:30:15")).alias("death_date"),
        )

    @cached_property
    def in_pet_events(self) -> DataFrame:
        e = self.base("events")
        et = F.col("event_type")
        return e.select(
            F.concat(F.lit("u"), F.col("user_id")).alias("player"), F.col("ts"), F.col("event_id").alias("seq"),
            F.when(et == "purchase", "feed").when(et == "click", "train").otherwise("tick").alias("action"),
        )

    @cached_property
    def in_sensor_log(self) -> DataFrame:
        e = self.base("events")
        return e.select(
            F.col("event_id").alias("id"), F.concat(F.lit("A"), F.col("user_id")).alias("location"),
            F.floor(F.col("value")).cast("bigint").alias("reading"), F.col("ts").alias("reading_date"),
        )

    # ---- corpus ------------------------------------------------------------------
    @cached_property
    def in_articles(self) -> DataFrame:
        d = self.base("documents")
        return d.select(
            F.col("doc_id").alias("article_id"), F.col("source").alias("author"),
            F.concat(F.lit("Title "), F.col("doc_id"), F.lit(" ("), F.col("lang"), F.lit(")")).alias("title"),
            F.col("text").alias("content"), F.lit("2024-03-29").cast("date").alias("publish_date"),
        )

    @cached_property
    def in_embeddings(self) -> DataFrame:
        e = self.base("embeddings")
        return e.select(
            F.col("vec_id").alias("embedding_id"), F.col("label").cast("bigint").alias("article_id"),
            F.concat(F.lit("chunk "), F.col("vec_id")).alias("chunk"), F.col("embedding"),
        )

    @cached_property
    def in_chunks(self) -> DataFrame:
        d = self.base("documents")
        return d.select(
            F.col("doc_id").alias("chunk_id"), F.col("doc_id").alias("article_id"), F.col("text").alias("chunk"),
            ntz("2024-03-29 00:00:00").alias("last_updated"),
        )

    @cached_property
    def in_markdown(self) -> DataFrame:
        d = self.base("documents")
        nl = F.lit("\n")
        return d.select(
            F.concat(F.lit("corpus/"), F.col("doc_id"), F.lit(".md")).alias("path"),
            F.concat(F.lit("---"), nl, F.lit("author: "), F.col("source"), nl,
                     F.lit("date: 2024-03-29 16:00:49+00:00"), nl, F.lit("title: Title "), F.col("doc_id"), nl,
                     F.lit("---"), nl, F.col("text")).alias("text"),
        )
