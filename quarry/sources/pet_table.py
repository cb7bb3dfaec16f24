"""Write path of the pet table: inserts and updates checked against the newest version, committed optimistically.

The table lies in buckets by player; a manifest (``sources.manifest``) names the files of every bucket.  A batch reads
only the buckets of its players, decides each row, writes new files beside the old ones and commits the next version.
Where another writer came first, the batch is decided anew if that writer changed one of its buckets, and otherwise
committed on top as it is.  So of two writers that give one player a pet, one finds the other's pet and is refused.

A batch is known by (producer, number): one that was applied already changes nothing, and the decisions of a producer's
last batch are kept, so a retry gets the same answer.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.lifecycle import MSG_DEAD, MSG_NO_SELLING, STATE_COLUMNS, pet_validate_insert, pet_validate_update
from quarry.session import forget, materialize
from quarry.sources import manifest

BUCKETS = 64
MAX_FILES = 16  # folders of a bucket before an insert rewrites it
STATE = "player string, pet_name string, mood int, food int, is_dead boolean, birth_date timestamp_ntz, death_date timestamp_ntz"
MSG_NO_PLAYER = "A pet needs a player and a name."


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("player"), F.lit(buckets)).cast("int")


def _read(spark: SparkSession, path: str, files: dict[str, list[str]], buckets: list[int] | None = None) -> DataFrame:
    """Rows of the named buckets (all, where none are named), with their bucket."""
    wanted = files if buckets is None else {str(b): files[str(b)] for b in buckets if str(b) in files}
    folders = sorted(f"{path}/{folder}/bucket={b}" for b, held in wanted.items() for folder in held)
    schema = f"{STATE}, bucket int"
    return spark.read.schema(schema).option("basePath", path).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _write(rows: DataFrame, path: str, buckets: int) -> str:
    """A new folder of state rows by bucket; the rows of a bucket come from one task or, where AQE splits it, a few."""
    folder = f"part={uuid.uuid4().hex[:12]}"
    (rows.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in STATE.split(", ")], _bucket(buckets).alias("bucket"))
     .repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/{folder}"))
    return folder


def _buckets_in(spark: SparkSession, path: str, folder: str) -> list[int]:
    """The buckets that a folder has files for (at most one row a bucket reaches the driver)."""
    held = spark.read.schema(f"{STATE}, bucket int").option("basePath", path).parquet(f"{path}/{folder}")
    return sorted(r[0] for r in held.select("bucket").distinct().collect())


def start_pet_table(pets: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """A new table with the given state rows, one per player; raises where the path holds a table."""
    folder = _write(pets.select(*STATE_COLUMNS), path, buckets)
    files = {str(b): [folder] for b in _buckets_in(pets.sparkSession, path, folder)}
    if not manifest.commit(pets.sparkSession, path, 0, {"buckets": buckets, "files": files, "applied": {}}):
        raise FileExistsError(f"{path} holds a pet table already")


def read_pets(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed state table."""
    _, now = manifest.latest(spark, path)
    return _read(spark, path, now.get("files", {})).select(*STATE_COLUMNS)


def read_decisions(spark: SparkSession, path: str, producer: str) -> DataFrame:
    """Every row of the producer's last batch with ``accepted`` and ``reason``."""
    _, now = manifest.latest(spark, path)
    return spark.read.parquet(f"{path}/{now['applied'][producer]['decisions']}")


# (rows of the batch, pets of its buckets) -> (a decision per row, new state rows, whether these replace the buckets)
Decide = Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame, bool]]


def _submit(rows: DataFrame, path: str, batch: int, producer: str, decide: Decide) -> bool:
    spark = rows.sparkSession
    version, now = manifest.latest(spark, path)
    if version < 0:
        raise FileNotFoundError(f"{path} holds no pet table; see start_pet_table")
    if now["applied"].get(producer, {"batch": -1})["batch"] >= batch:
        return False
    # numbered once, so that equal rows can be told apart in every attempt
    asked = materialize(rows.withColumn("_no", F.monotonically_increasing_id()), "pet-batch")
    touched = [r[0] for r in asked.where("player IS NOT NULL").select(_bucket(now["buckets"]).alias("b")).distinct().collect()]
    seen = plan = None
    while True:
        here = {str(b): now["files"].get(str(b), []) for b in touched}
        if here != seen:  # first attempt, or another writer changed one of these buckets: decide anew
            seen = here
            plan = _decided(spark, path, now, asked, touched, decide)
        folder, replaces, held, decisions = plan
        files = dict(now["files"])
        for b in map(str, held):
            files[b] = [folder] if b in replaces else files.get(b, []) + [folder]
        content = now | {"files": files, "applied": now["applied"] | {producer: {"batch": batch, "decisions": decisions}}}
        if manifest.commit(spark, path, version + 1, content):
            forget(asked)
            return True
        version, now = manifest.latest(spark, path)
        if now["applied"].get(producer, {"batch": -1})["batch"] >= batch:  # a twin of this writer was faster
            forget(asked)
            return False


def _decided(spark: SparkSession, path: str, now: dict, asked: DataFrame, touched: list[int], decide: Decide
             ) -> tuple[str, set[str], list[int], str]:
    """Decisions and new files of a batch against one version: (folder, buckets it replaces, its buckets, decisions)."""
    pets = _read(spark, path, now["files"], touched)
    decided, state, whole = decide(asked, pets.select(*STATE_COLUMNS))
    decisions = f"decided={uuid.uuid4().hex[:12]}"
    decided.write.parquet(f"{path}/{decisions}")
    made = spark.read.schema(decided.schema).parquet(f"{path}/{decisions}")
    replaces = {str(b) for b in touched} if whole else {str(b) for b in touched if len(now["files"].get(str(b), [])) >= MAX_FILES}
    if not whole:  # new pets are those that were just decided; a bucket of many files is rewritten with them
        state = made.where("accepted").select(*STATE_COLUMNS)
        full = pets.where(F.col("bucket").isin([int(b) for b in replaces])).select(*STATE_COLUMNS)
        state = state.unionByName(full)
    folder = _write(state, path, now["buckets"])
    return folder, replaces, _buckets_in(spark, path, folder), decisions


def submit_inserts(candidates: DataFrame, path: str, batch: int, producer: str = "", now=None, order_col: str | None = None) -> bool:
    """Give players (player, pet_name[, order_col]) their pets by the rules of ``pet_validate_insert``; False if applied before.

    A player's first candidate wins, of equal rows exactly one; a row without player or name is refused.
    """

    def decide(rows: DataFrame, pets: DataFrame) -> tuple[DataFrame, DataFrame, bool]:
        named = F.col("player").isNotNull() & F.col("pet_name").isNotNull()
        order = F.struct(*([F.col(order_col)] if order_col else []), "pet_name", "_no")
        good = pet_validate_insert(rows.where(named).withColumn("_order", order), pets, now, "_order")
        bad = rows.where(~named).select("player", "pet_name", F.lit(False).alias("accepted"), F.lit(MSG_NO_PLAYER).alias("reason"))
        return good.unionByName(bad, allowMissingColumns=True), good, False

    return _submit(candidates, path, batch, producer, decide)


def submit_updates(updates: DataFrame, path: str, batch: int, producer: str = "", order_col: str | None = None) -> bool:
    """Apply updates (player, new_player, mood, food[, order_col]) by the rules of ``pet_validate_update``; False if applied before.

    Each update is decided on its own; of a player's accepted ones the last by ``order_col`` stands.  An update of a
    player without a pet changes nothing (``accepted`` is NULL).
    """

    def decide(rows: DataFrame, pets: DataFrame) -> tuple[DataFrame, DataFrame, bool]:
        old = pets.select("player", F.col("is_dead").alias("_dead"))
        reason = (F.when(F.col("_dead"), MSG_DEAD)
                  .when(F.col("new_player").isNotNull() & (F.col("new_player") != F.col("player")), MSG_NO_SELLING))
        decided = (rows.join(old, "player", "left")
                   .select(*rows.columns, F.when(F.col("_dead").isNotNull(), reason.isNull()).alias("accepted"), reason.alias("reason")))
        order = F.struct(*([F.col(order_col)] if order_col else []), "_no")
        last = (decided.where("accepted").groupBy("player")
                .agg(F.max(F.struct(order.alias("at"), "new_player", "mood", "food")).alias("u")).select("player", "u.new_player", "u.mood", "u.food"))
        return decided.drop("_no"), pet_validate_update(pets, last).select(*STATE_COLUMNS), True

    return _submit(updates, path, batch, producer, decide)
