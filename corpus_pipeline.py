"""The corpus pipeline: quality filter, line dedup, near-dedup, source mixing, BPE encoding.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the
columns of ``documents``.  ``run`` writes each stage's rows as Parquet in the shared folder and reads them back
for the next one.

Defined cases, alike in all stages: a null text counts as empty (one empty line, no shingle, size 0) and its row goes
on under the same rules; rows without an id or with a repeated id stay rows of their own; columns that ``documents``
has beside its own go through unchanged, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, line_dedup, mixing, quality, simhash
from quarry.session import forget, materialize, ship_package


def _columns(docs: DataFrame) -> list[Column]:
    """The columns by their names as they are, dots included."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in docs.columns]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranker does not reject (score 0.3 or more); learned outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    ranker = quality.fit(docs.select("doc_id", "text"), labels, "quality", train=~quality.in_fold(F.col("doc_id"), 5, 0))
    slim = docs.select(F.struct(*_columns(docs)).alias("row"), F.col("text"))
    return quality.score_documents(slim, ranker).where("predicted = 1").select("row.*")


def line_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines whose key stands in 10 documents or more are cut from every text."""
    rest = F.struct(*[c for c, name in zip(_columns(docs), docs.columns, strict=True) if name != "text"])
    cut = line_dedup.drop_repeated_lines(docs.select("doc_id", "text", rest.alias("rest")))
    old = {name: F.col("rest").getField(name) for name in docs.columns if name != "text"}
    # n_chars follows the text where lines went
    new = {"text": F.col("text"), "n_chars": F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(old["n_chars"])}
    out = old | new
    return cut.select(*[out[name].alias(name) for name in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component stays: that of the smallest id, of equal ids that of the smallest hash."""
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars, n_tokens and the packed ids of every row."""
    import public_tokenizers

    docs = docs.select("doc_id", "lang", "source", "n_chars", "text")
    tables = bpe.prepare(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return bpe.encode_documents(docs, tables).select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_filter), ("line_dedup", line_filter), ("near_dedup", near_dedup), ("mix", mix_sources),
    ("encode", encode)]

#: The scores of the first stage are learned, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    written = None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        if written is not None:
            forget(written)
        written = docs
    return STAGES[-1][1](spark, docs, sf_dir)
