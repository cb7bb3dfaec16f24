"""Document corpus: front matter, typed articles, ids, chunking, embeddings.

The whole corpus is one DataFrame job: front matter is parsed with JVM regex/array
functions; chunking (a recursive character splitter) runs per document in
``mapInArrow``; embeddings are a hashing encoder built from Spark ML transformers, or a
pluggable batch encoder in a ``pandas_udf``.
"""

from __future__ import annotations

from typing import Iterator, List, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Chunking parameters and separators, in the order they are tried.
CHUNK_SIZE = 500
CHUNK_OVERLAP = 20
SEPARATORS = ["\n\n", "\n", " ", ".", "```"]
REQUIRED_KEYS = ("author", "title", "date")
EMBED_DIM = 384
# Characters of chunks that a task hands on at once.
CHUNK_BATCH = 1 << 20

# A line whose strip() is '---' toggles header mode and is dropped with its newline.
_FENCE = r"(?m)^[^\S\n]*---[^\S\n]*(?:\n|$)"


# A header line that counts: a key at the left margin, neither a list item nor a comment.
_TOP_LEVEL_LINE = r"^[^\s:#-][^:]*:"
# A quoted value with nothing but a comment after it, and the trailing comment of a bare one.
_QUOTED_VALUE = r"""^(["'])(.*?)\1\s*(?:#.*)?$"""
_TRAILING_COMMENT = r"(?:^|\s+)#.*$"


def _header_value(raw):
    """The value of a header line: unquoted, without its comment; NULL where it is empty."""
    bare = F.trim(F.regexp_replace(F.trim(raw), _TRAILING_COMMENT, ""))
    return (F.when(F.trim(raw).rlike(_QUOTED_VALUE), F.regexp_extract(F.trim(raw), _QUOTED_VALUE, 2))
            .when(~bare.isin("", "~", "null", "Null", "NULL"), bare))


def parse_front_matter(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``headers`` (map<string,string>) and ``content`` (string) from Markdown front matter.

    The text is cut at every fence line; even pieces are body, odd pieces header, so a
    fence inside the body moves the following lines into the header, as a toggling
    line reader does.  Of the header, the unindented ``key: value`` lines count (the last
    of repeated keys wins); nested blocks (indented lines), list items and comment lines are
    passed over, so a nested ``title`` never replaces the document's.  Surrounding quotes and
    trailing `` # comment``s are removed; an empty, ``~`` or ``null`` value is NULL.  A header
    key ``content`` replaces the body.  ``\\r\\n`` / ``\\r`` become ``\\n``.
    """
    text = F.regexp_replace(F.col(text_col), r"\r\n?", "\n")
    # staged projections: each step is computed once per row (the split is not repeated
    # inside the lambdas that read it)
    step = df.select("*", F.split(text, _FENCE, -1).alias("_pieces"))
    step = step.select("*", F.array_join(F.filter("_pieces", lambda x, i: i % 2 == 0), "").alias("content"),
                       F.array_join(F.filter("_pieces", lambda x, i: i % 2 == 1), "").alias("_header")).drop("_pieces")
    lines = F.filter(F.split("_header", "\n"), lambda l: l.rlike(_TOP_LEVEL_LINE))
    kv = F.transform(lines, lambda l: F.struct(
        F.trim(F.regexp_extract(l, r"^([^:]*):", 1)).alias("k"),
        _header_value(F.regexp_extract(l, r"^[^:]*:(.*)$", 1)).alias("v")))
    step = step.select("*", kv.alias("_kv")).drop("_header")
    step = step.select("*", F.transform("_kv", lambda e: e["k"]).alias("_keys"))
    # keep the last occurrence of each key
    last = F.filter("_kv", lambda e, i: (i == F.size("_keys") - 1)
                    | ~F.array_contains(F.slice("_keys", i + 2, F.greatest(F.size("_keys") - i - 1, F.lit(1))), e["k"]))
    # The parse leaves through a one-row generator: a later filter on headers/content
    # (the reject check) then stays above it.  Through plain projections Catalyst would
    # push it down and inline the whole split/extract chain into the condition, which
    # evaluated the regex split of every text once per reference (4x).
    step = step.select("*", F.map_from_entries(last).alias("_headers"))
    body = F.when(F.array_contains("_keys", "content"), F.col("_headers")["content"]).otherwise(F.col("content"))
    parsed = F.struct(F.col("_headers").alias("headers"), body.alias("content"))
    return step.select(*df.columns, F.inline(F.array(parsed)))


def articles(parsed: DataFrame, path_col: str = "path") -> tuple[DataFrame, DataFrame]:
    """Typed articles (path, author, title, content, publish_date) and rejects (path, reason).

    ``date`` is parsed as a timestamp (zone offsets honoured) and cast to a UTC date.
    Documents without front matter, without a value for a required key, or with a date that
    is none are rejected with a reason.
    """
    h = F.col("headers")
    # one reference to the header map keeps the reject condition small; the generator at the
    # end of parse_front_matter keeps it above the parse
    missing = F.array_except(F.array(*[F.lit(k) for k in REQUIRED_KEYS]),
                             F.map_keys(F.map_filter(h, lambda k, v: v.isNotNull())))
    ts = h.getItem("date").try_cast("timestamp")
    date = F.to_date(F.to_utc_timestamp(ts, F.current_timezone()))
    t = parsed.select(path_col, h.getItem("author").alias("author"), h.getItem("title").alias("title"),
                      "content", date.alias("publish_date"), missing.alias("_missing"))
    reason = (F.when(F.size("_missing") > 0, F.concat(F.lit("missing front matter key(s): "), F.array_join("_missing", ", ")))
              .when(F.col("publish_date").isNull(), F.lit("date is not a date")))
    ok = t.filter(reason.isNull()).drop("_missing")
    bad = t.filter(reason.isNotNull()).select(path_col, reason.alias("reason"))
    return ok, bad


def assign_ids(df: DataFrame, order: Sequence[str], col: str = "article_id", start: int = 1) -> DataFrame:
    """Surrogate ids 1..n in ``order`` (consecutive, deterministic, no single-partition window)."""
    from quarry.plans.scan import dense_ids

    return dense_ids(df, order, start=start, col=col)


# ---- chunking -------------------------------------------------------------------------------

def _split_keep(text: str, sep: str) -> List[str]:
    """Cut before every occurrence of ``sep`` (the separator starts the next piece)."""
    parts = text.split(sep)
    out = [parts[0]] + [sep + p for p in parts[1:]]
    return [p for p in out if p != ""]


def _merge(pieces: List[str], size: int, overlap: int) -> List[str]:
    chunks, cur, total = [], [], 0
    for p in pieces:
        n = len(p)
        if total + n > size and cur:
            joined = "".join(cur).strip()
            if joined:
                chunks.append(joined)
            while total > overlap or (total + n > size and total > 0):
                total -= len(cur[0])
                cur.pop(0)
        cur.append(p)
        total += n
    joined = "".join(cur).strip()
    if joined:
        chunks.append(joined)
    return chunks


def split_text(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
               separators: Sequence[str] = SEPARATORS) -> List[str]:
    """Recursive character splitting of one text (contract in the README).

    The first separator present cuts the text (kept at the start of the next piece);
    pieces shorter than ``size`` are merged up to ``size`` characters with up to
    ``overlap`` characters carried over; longer pieces are split again with the
    remaining separators, or kept whole - exactly as cut, not stripped - when none is left.
    """
    sep, rest = separators[-1], []
    for i, s in enumerate(separators):
        if s in text:
            sep, rest = s, list(separators[i + 1:])
            break
    out, good = [], []
    for piece in _split_keep(text, sep):
        if len(piece) < size:
            good.append(piece)
            continue
        if good:
            out.extend(_merge(good, size, overlap))
            good = []
        out.extend(split_text(piece, size, overlap, rest) if rest else [piece])
    if good:
        out.extend(_merge(good, size, overlap))
    return out


def chunk_text(df: DataFrame, id_col: str = "article_id", text_col: str = "content",
               size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """One row per chunk: (id, chunk_no, chunk).  Each document is split in the task that
    reads it (no shuffle); documents are independent, so the work spreads with the data.

    A task takes a few texts at a time out of their Arrow batch and hands its chunks on in batches of
    ``CHUNK_BATCH`` characters, so a Python worker's memory does not grow with the rows of a batch."""
    names = [id_col, "chunk_no", "chunk"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, nos, chunks, held = [], [], [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(nos, pa.int32()),
                                               pa.array(chunks, pa.string())], names)

        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if t is None:
                        continue
                    for n, c in enumerate(split_text(t, size, overlap)):
                        ids.append(i)
                        nos.append(n)
                        chunks.append(c)
                        held += len(c)
                        if held >= CHUNK_BATCH:
                            yield batch()
                            ids, nos, chunks, held = [], [], [], 0
        if ids:
            yield batch()

    return df.select(F.col(id_col).cast("bigint").alias(id_col), text_col).mapInArrow(
        run, f"{id_col} long, chunk_no int, chunk string")


# ---- embeddings -----------------------------------------------------------------------------

def embed_chunks(df: DataFrame, text_col: str = "chunk", dim: int = EMBED_DIM, out_col: str = "embedding",
                 encoder=None) -> DataFrame:
    """Add a ``dim``-wide L2-normalised vector per text (array<float>).

    The default encoder is deterministic and model-free: lower-cased word tokens hashed
    into ``dim`` buckets (term counts), then L2-normalised - JVM-side Spark ML
    transformers.  ``encoder`` plugs in another one (e.g. a pretrained sentence encoder
    loaded in the workers): a callable from a list of texts to an array of shape
    (len(texts), dim), applied per Arrow batch in a ``pandas_udf``; its rows are
    L2-normalised the same way.
    """
    if encoder is not None:
        return _embed_with(df, text_col, dim, out_col, encoder)
    from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
    from pyspark.ml.functions import vector_to_array

    tok = RegexTokenizer(inputCol=text_col, outputCol="_tokens", pattern=r"\w+", gaps=False, toLowercase=True)
    tf = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=dim)
    norm = Normalizer(inputCol="_tf", outputCol="_vec", p=2.0)
    tok.setInputCol("_text")
    cols = df.columns
    v = norm.transform(tf.transform(tok.transform(df.withColumn("_text", F.coalesce(F.col(text_col), F.lit(""))))))
    return v.select(*cols, vector_to_array("_vec", "float32").alias(out_col))


def _embed_with(df: DataFrame, text_col: str, dim: int, out_col: str, encoder) -> DataFrame:
    import numpy as np
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("array<float>")
    def encode(texts: pd.Series) -> pd.Series:
        v = np.asarray(encoder(texts.fillna("").tolist()), dtype=np.float64).reshape(len(texts), dim)
        n = np.linalg.norm(v, axis=1, keepdims=True)
        v = np.where(n > 0, v / np.where(n > 0, n, 1.0), v).astype(np.float32)
        return pd.Series(list(v))

    return df.select("*", encode(F.col(text_col)).alias(out_col))
