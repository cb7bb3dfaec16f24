"""Front matter as VARIANT: the whole YAML of a header, nested maps and lists included, with typed reads.

``operators.corpus.parse_front_matter`` keeps its flat ``map<string, string>`` view of the same headers.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.yaml import YamlError, load
from quarry.operators.corpus import _FENCE


def _as_json(value) -> str:
    return json.dumps(value, ensure_ascii=False, allow_nan=False)


def read_header(text: str | None) -> tuple[str | None, str | None]:
    """(JSON, None) of a header, or (None, what is wrong with it); both None without a header."""
    if not text:
        return None, None
    try:
        return _as_json(load(text)), None
    except (YamlError, ValueError) as e:  # numbers that JSON or Python cannot hold are errors of the header too
        return None, str(e)[:500]


def parse_front_matter_yaml(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``meta`` (VARIANT, NULL without a readable header), ``meta_error`` and ``content``.

    The text is cut at fence lines as ``parse_front_matter`` does: odd pieces are header, even ones body.  Only headers
    travel to Python, in Arrow batches; bodies stay in the JVM.
    """
    text = F.regexp_replace(F.col(text_col), r"\r\n?", "\n")
    cut = df.select("*", F.split(text, _FENCE, -1).alias("_pieces"))
    cut = cut.select(*[F.col(f"`{c}`") for c in df.columns],
                     F.array_join(F.filter("_pieces", lambda x, i: i % 2 == 0), "").alias("_content"),
                     F.array_join(F.filter("_pieces", lambda x, i: i % 2 == 1), "").alias("_header"))

    @F.arrow_udf("json string, error string")
    def read(headers: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in headers:
            found = [read_header(h) for h in column.to_pylist()]
            yield pa.StructArray.from_arrays([pa.array([j for j, _ in found], pa.string()), pa.array([e for _, e in found], pa.string())],
                                             ["json", "error"])

    parsed = cut.withColumn("_read", read(F.col("_header")))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in ("meta", "meta_error", "content")]
    return parsed.select(*kept, F.parse_json("_read.json").alias("meta"), F.col("_read.error").alias("meta_error"),
                         F.col("_content").alias("content"))


def header_get(meta: Column, path: str, kind: str) -> Column:
    """A typed read, e.g. ``header_get(F.col("meta"), "$.author.name", "string")``; NULL where it is missing or of another kind."""
    return F.try_variant_get(meta, path, kind)
