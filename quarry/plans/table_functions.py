"""Polymorphic table functions: operators over a TABLE argument, called from SQL.

``SELECT * FROM chunk_text(TABLE(docs) , 'article_id', 'content')`` and
``SELECT * FROM front_matter(TABLE(docs), 'text')``; a table may be a query, and ``PARTITION BY`` spreads it by key.  Each is a Python UDTF whose
``analyze`` reads the argument's schema, so the output carries the types of the columns it keeps.  They work a row at a
time, as UDTFs do; in jobs use the DataFrame operators of the same names.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import IntegerType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from quarry.session import ship_package


def _column(argument: AnalyzeArgument, name: str):
    if not argument.isTable:
        raise ValueError("the first argument is a table: TABLE(name) or TABLE(SELECT ...)")
    found = [f for f in argument.dataType.fields if f.name == name]
    if not found:
        raise ValueError(f"the table has no column {name}; it has {', '.join(f.name for f in argument.dataType.fields)}")
    return found[0]


def _name(argument: AnalyzeArgument | None, default: str) -> str:
    if argument is None:
        return default
    if argument.isTable or not isinstance(argument.value, str):
        raise ValueError("a column is named by a constant text")
    return argument.value


class ChunkText:
    """(id column, chunk_no, chunk) of every document."""

    def __init__(self):
        self.id_col, self.text_col = "article_id", "content"

    @staticmethod
    def analyze(docs: AnalyzeArgument, id_col: AnalyzeArgument | None = None, text_col: AnalyzeArgument | None = None) -> AnalyzeResult:
        key = _column(docs, _name(id_col, "article_id"))
        _column(docs, _name(text_col, "content"))
        return AnalyzeResult(StructType().add(key.name, key.dataType).add("chunk_no", IntegerType()).add("chunk", StringType()))

    def eval(self, row, id_col: str = "article_id", text_col: str = "content") -> Iterator[tuple]:
        from quarry.operators.corpus import split_text

        if row[text_col] is not None:
            for n, chunk in enumerate(split_text(row[text_col])):
                yield row[id_col], n, chunk


class FrontMatter:
    """The columns of the table, then header (JSON text), header_error and content."""

    @staticmethod
    def analyze(docs: AnalyzeArgument, text_col: AnalyzeArgument | None = None) -> AnalyzeResult:
        _column(docs, _name(text_col, "text"))
        out = StructType([f for f in docs.dataType.fields])
        for name in ("header", "header_error", "content"):
            if name in docs.dataType.names:
                raise ValueError(f"the table has a column {name} already")
            out = out.add(name, StringType())
        return AnalyzeResult(out)

    def eval(self, row, text_col: str = "text") -> Iterator[tuple]:
        import re

        from quarry.operators.corpus import _FENCE
        from quarry.operators.front_matter import read_header

        text = row[text_col]
        if text is None:
            yield *row, None, None, None
            return
        pieces = re.split(_FENCE, re.sub(r"\r\n?", "\n", text))
        yield *row, *read_header("".join(pieces[1::2])), "".join(pieces[::2])


def register_table_functions(spark: SparkSession) -> None:
    """Make ``chunk_text`` and ``front_matter`` callable from SQL in this session."""
    ship_package(spark)
    spark.udtf.register("chunk_text", udtf(ChunkText))
    spark.udtf.register("front_matter", udtf(FrontMatter))
