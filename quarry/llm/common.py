"""Helpers that several operators share: Arrow column access, row identity, word splitting.

A word is a maximal run of bytes outside space and 0x09-0x0D; ``bytes.split()`` splits on
exactly that set.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"[^\x20\x09-\x0D]+"


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The UTF-8 bytes of a string column; null becomes empty."""
    values = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    return [v or b"" for v in values.to_pylist()]


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: T.StructType | str
                ) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from fn(b)

    return df.mapInArrow(run, schema)


def extend_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict[str, pa.Array]]],
                   added: list[T.StructField]) -> DataFrame:
    """``df`` with columns computed from Arrow batches; ``make`` runs once per task.

    A computed column of the same name replaces the input's.
    """
    names = [f.name for f in added]
    kept = [f.name for f in df.schema if f.name not in names]
    schema = T.StructType([f for f in df.schema if f.name in kept] + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for b in batches:
            for at in range(0, b.num_rows, 1024):  # what a batch grows to stays small
                part = b.slice(at, 1024)
                out = fn(part)
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(n)) for n in kept] + [out[n] for n in names], kept + names)

    return df.mapInArrow(run, schema)


def row_hash(*columns: str) -> Column:
    """64 bits of a row's identity; joins use it beside the id, so two rows meet only if both agree.

    Rows that agree in id and text have equal results in every operator here.
    """
    return F.xxhash64(*columns)


def utf8_sha256(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)
