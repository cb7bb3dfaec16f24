"""An append log whose writes are units: all rows of a write become visible at once, with consecutive ids.

``spark.write.format("unit_log")`` and ``writeStream.format("unit_log")`` (a Python data source) write Parquet files
from the tasks under a hidden name, renamed when whole.  Each task's commit message names its file and rows; the
commit numbers them after the last unit and writes one entry ``_units/<n>.json``, which appears by an atomic
rename that never overwrites.  The id of a row is its file's first id plus its place in the file, so ids are never
counted over the log.  Rows of a failed write are in no entry, hence in no read.

A write may carry the name of its producer and its batch number (a stream does): a batch at or below the
producer's last committed one counts once.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from quarry.session import path_exists, ship_package

GROUP_ROWS = 1 << 17  # rows of a Parquet row group
ENTRY = "files array<struct<name string, rows long, first_id long>>, next_id long"


def _open_fs(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    """A task's file (empty name: no rows) and its place among the tasks."""

    part: int
    name: str
    rows: int


class _UnitWriter:
    def __init__(self, options: dict, schema: StructType):
        self.path = options["path"].rstrip("/")
        self.producer = options.get("producer", "")
        self.batch = int(options.get("batch", -1))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        part = TaskContext.get().partitionId()
        system, root = _open_fs(self.path)
        name = f"part-{part:06d}-{uuid.uuid4().hex}.parquet"
        hidden = f"{root}/data/.{name}"
        writer, held, rows = None, [], 0
        try:
            for b in iterator:
                if not b.num_rows:
                    continue
                if writer is None:
                    system.create_dir(f"{root}/data", recursive=True)
                    writer = pq.ParquetWriter(hidden, b.schema, filesystem=system, compression="zstd")
                held.append(b)
                rows += b.num_rows
                if sum(x.num_rows for x in held) >= GROUP_ROWS:
                    writer.write_table(pa.Table.from_batches(held))
                    held = []
            if writer is None:
                return Written(part, "", 0)
            if held:
                writer.write_table(pa.Table.from_batches(held))
        finally:
            if writer is not None:
                writer.close()
        system.move(hidden, f"{root}/data/{name}")
        return Written(part, name, rows)

    def _commit(self, messages: list, producer: str, batch: int) -> None:
        system, root = _open_fs(self.path)
        system.create_dir(f"{root}/_units", recursive=True)
        while True:
            names = sorted(i.base_name for i in system.get_file_info(fs.FileSelector(f"{root}/_units")) if i.base_name.endswith(".json"))
            last: dict = {"next_id": 1, "batches": {}}
            if names:
                with system.open_input_stream(f"{root}/_units/{names[-1]}") as f:
                    last = json.loads(f.read())
            if producer and last["batches"].get(producer, -1) >= batch:
                self.abort(messages)  # committed before: this attempt's files go
                return
            files, next_id = [], last["next_id"]
            for m in sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.part):
                files.append({"name": m.name, "rows": m.rows, "first_id": next_id})
                next_id += m.rows
            entry = {"files": files, "next_id": next_id,
                     "batches": last["batches"] | ({producer: batch} if producer else {})}
            version = int(names[-1][:-5]) + 1 if names else 0
            if _put(system, f"{root}/_units/{version:012d}.json", json.dumps(entry).encode()):
                return

    def abort(self, messages: list) -> None:
        system, root = _open_fs(self.path)
        for m in messages:
            if m is not None and m.name and system.get_file_info(f"{root}/data/{m.name}").type == fs.FileType.File:
                system.delete_file(f"{root}/data/{m.name}")


def _put(system: fs.FileSystem, path: str, content: bytes) -> bool:
    """Write a file that must not be there yet; False if it is."""
    folder, _, name = path.rpartition("/")
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as f:
        f.write(content)
    if isinstance(system, fs.LocalFileSystem):  # a link fails where the name is taken, also for writers at the same moment
        try:
            os.link(draft, path)
        except FileExistsError:
            return False
        finally:
            system.delete_file(draft)
        return True
    if system.get_file_info(path).type != fs.FileType.NotFound:
        system.delete_file(draft)
        return False
    system.move(draft, path)
    return True


class UnitBatchWriter(_UnitWriter, DataSourceArrowWriter):
    def commit(self, messages: list) -> None:
        self._commit(messages, self.producer, self.batch)


class UnitStreamWriter(_UnitWriter, DataSourceStreamArrowWriter):
    def commit(self, messages: list, batchId: int) -> None:
        self._commit(messages, self.producer or "stream", batchId)

    def abort(self, messages: list, batchId: int) -> None:
        _UnitWriter.abort(self, messages)


class UnitLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "unit_log"

    def writer(self, schema: StructType, overwrite: bool) -> UnitBatchWriter:
        if overwrite:
            raise ValueError("a unit log only grows")
        return UnitBatchWriter(dict(self.options), schema)

    def streamWriter(self, schema: StructType, overwrite: bool) -> UnitStreamWriter:
        return UnitStreamWriter(dict(self.options), schema)


def register(spark: SparkSession) -> None:
    ship_package(spark)
    spark.dataSource.register(UnitLog)


def append_unit(rows: DataFrame, path: str, order: list[str] | None = None, producer: str = "", batch: int = -1) -> None:
    """Append ``rows`` as one unit; ids follow ``order`` within it (range partitions, so no task takes all)."""
    register(rows.sparkSession)
    if order:
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows.write.format("unit_log").option("producer", producer).option("batch", batch).mode("append").save(path)


def read_units(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """id and the columns of every committed row; the files are scanned by Spark, with its pruning."""
    kind = spark.createDataFrame([], schema).schema
    if not path_exists(spark, f"{path}/_units") or not path_exists(spark, f"{path}/data"):
        return spark.createDataFrame([], StructType().add("id", "long", False)).crossJoin(spark.createDataFrame([], kind)).limit(0)
    entries = spark.read.schema(ENTRY).json(f"{path}/_units").select(F.inline("files"))
    data = spark.read.schema(kind).parquet(f"{path}/data").select(
        *kind.names, F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    found = data.join(entries.select(F.col("name").alias("_file"), "first_id"), "_file")
    return found.select((F.col("first_id") + F.col("_place")).alias("id"), *kind.names)
