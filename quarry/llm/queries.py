"""Queries of the pipeline operators over the given tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import utf8_sha256
from quarry.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@_query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.simhash import near_duplicates

    return near_duplicates(_documents(spark, sf_dir))


@_query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.line_dedup import drop_repeated_lines

    cut = drop_repeated_lines(_documents(spark, sf_dir).select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_dropped",
                      utf8_sha256(F.coalesce("text", F.lit(""))).alias("kept_sha256"))


ORACLE["op8_line_dedup"] = r"""
WITH l AS (
  SELECT rowid AS r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i
  FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents)),
k AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
often AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(often.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE often.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN often ON k.key = often.key GROUP BY r
"""


@_query
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.mixing import mix_table

    return mix_table(_documents(spark, sf_dir))


ORACLE["op10_mix_sources"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(md5('20:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))), 1, 13))::BIGINT::DOUBLE + 0.5)
           / 4503599627370496.0 AS u
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap, row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / w, encode(source) NULLS LAST) AS place,
         1.5::DOUBLE * (SELECT sum(source_size) FROM s) AS total FROM s),
lv AS (
  SELECT a.place, (a.total - (SELECT coalesce(sum(b.cap), 0) FROM o b WHERE b.place < a.place))
           / (SELECT sum(b.w) FROM o b WHERE b.place >= a.place) AS level, a.cap / a.w AS most FROM o a),
t AS (
  SELECT source, source_size,
         least(cap, coalesce((SELECT arg_min(level, place) FROM lv WHERE level <= most) * w, cap)) AS target FROM o),
r AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio FROM t),
p AS (
  SELECT source, source_size, target, floor(ratio)::BIGINT AS whole, ratio - floor(ratio) AS f,
         target - floor(ratio) * source_size AS need FROM r),
q AS (
  SELECT d.*, p.source_size, p.target, p.whole, p.need,
         CASE WHEN f > 0 THEN (u / (1 - u)) / (f / (1 - f)) / (1 + (u / (1 - u)) / (f / (1 - f))) ELSE 1 END AS v
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
c AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY v, r ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto, upto - size AS before FROM q)
SELECT doc_id, size, source_size, target,
       (size * taken)::BIGINT AS taken, taken::BIGINT AS copies
FROM (SELECT *, whole + CASE WHEN need > 0 AND (upto < need OR (before < need AND upto - need <= need - before)) THEN 1 ELSE 0 END AS taken
      FROM c)
"""


@_query
def op6_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.multiset_hash import edit_likeness

    return edit_likeness(_documents(spark, sf_dir))


@_query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.warc import page_records, read_warc, write_warc
    from quarry.session import scratch_path

    path = scratch_path(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), path)
    return page_records(read_warc(spark, path))


ORACLE["op5_warc"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest AS d, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1),
j AS (SELECT p.*, f.first, f.first IS NOT NULL AND page_id IS DISTINCT FROM f.first AS again FROM p LEFT JOIN f ON d = payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first END AS refers_to FROM j
"""


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@_query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.quality import fit, in_fold, score_documents

    docs = _documents(spark, sf_dir).select("doc_id", "text")
    held_out = in_fold(F.col("doc_id"), 5, 0)
    ranker = fit(docs, _labels(spark, sf_dir), "quality", train=~held_out)
    return score_documents(docs, ranker).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@_query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.quality import in_fold
    from quarry.llm.toxicity import fit, tag_documents

    docs = _documents(spark, sf_dir).select("doc_id", "text")
    held_out = in_fold(F.col("doc_id"), 4, 2)
    tagger = fit(docs, _labels(spark, sf_dir), "toxic", train=~held_out)
    return tag_documents(docs, tagger).select("doc_id", held_out.alias("held_out"), "score", "predicted", "spans")


@_query
def op1_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.pivot_topk import pivot_topk

    return pivot_topk(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


ORACLE["op1_pivot_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e, len(embedding) AS n FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, o.vec_id, list_inner_product(q.e, o.e)::BIGINT AS score
  FROM v q JOIN v o ON q.n = o.n AND q.vec_id <> o.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@_query
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from quarry.llm.bpe import encode_documents, prepare

    docs = _documents(spark, sf_dir).select("doc_id", "text")
    tables = prepare(docs, public_tokenizers.path("byte_bpe_50k.json"))
    coded = encode_documents(docs, tables, decode=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        utf8_sha256(F.col("decoded")).alias("decoded_sha256"))


@_query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.substring_dedup import drop_repeated_passages

    cut = drop_repeated_passages(_documents(spark, sf_dir).select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", utf8_sha256(F.col("kept")).alias("kept_sha256"))


ORACLE["op2_substring_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
x AS (SELECT r, doc_id, i, list_aggregate(w[i : i + 12], 'string_agg', ' ') AS win
      FROM (SELECT r, doc_id, w, unnest(range(1, greatest(len(w) - 11, 1))) AS i FROM d)),
f AS (SELECT win, min(doc_id) AS lo FROM x GROUP BY win HAVING min(doc_id) < max(doc_id)),
g AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS at FROM x JOIN f USING (win) WHERE lo < doc_id),
t AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS at FROM d),
k AS (SELECT t.r, count(g.at) AS n_removed, string_agg(word, ' ' ORDER BY t.at) FILTER (WHERE g.at IS NULL) AS kept
      FROM t LEFT JOIN g ON t.r = g.r AND t.at = g.at GROUP BY t.r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""


@_query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.vector_codes import codebooks_sha256, compress, label_errors

    coded, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return (label_errors(coded).withColumn("codebooks_sha256", F.lit(codebooks_sha256(books)))
            .select("vec_id", "code", "error", "label_error", "codebooks_sha256"))


def _vector_codes_sql(rounds: int = 4, parts: int = 4, entries: int = 256) -> str:
    """One assignment and one mean a round, as chained common table expressions."""
    steps = []
    for i in range(rounds + 1):
        # doubles hold these whole numbers exactly
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT x.r, x.p, min(((x.xx + c.cc - 2 * list_inner_product(x.x, c.x))::BIGINT) * {entries} + c.e) AS best
  FROM x JOIN c{i} c ON c.p = x.p GROUP BY x.r, x.p)""")
        if i < rounds:
            steps.append(f"""m{i} AS MATERIALIZED (
  SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY pos)::DOUBLE[] AS x FROM (
    SELECT p, e, pos, sum(v)::BIGINT AS s, count(*) AS n FROM (
      SELECT x.p, a.best % {entries} AS e, unnest(x.x)::BIGINT AS v, generate_subscripts(x.x, 1) AS pos
      FROM x JOIN a{i} a ON a.r = x.r AND a.p = x.p) GROUP BY p, e, pos) GROUP BY p, e),
c{i + 1} AS MATERIALIZED (
  SELECT p, e, x, list_inner_product(x, x) AS cc FROM (
    SELECT c.p, c.e, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m ON m.p = c.p AND m.e = c.e))""")
    return f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda y: floor(1024 * y::DOUBLE)) AS w
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
x AS MATERIALIZED (
  SELECT r, p, w[p * len(w) // {parts} + 1 : (p + 1) * len(w) // {parts}] AS x, list_inner_product(x, x) AS xx
  FROM (SELECT r, w, unnest(range({parts})) AS p FROM v)),
c0 AS MATERIALIZED (SELECT p, r - 1 AS e, x, xx AS cc FROM x WHERE r <= {entries}),
{", ".join(steps)},
d AS (SELECT r, string_agg(lpad(lower(to_hex(best % {entries})), 2, '0'), '' ORDER BY p) AS code,
             sum(best // {entries})::BIGINT AS error FROM a{rounds} GROUP BY r),
h AS (SELECT sha256(string_agg(v::BIGINT::VARCHAR, ',' ORDER BY p, e, pos)) AS codebooks_sha256
      FROM (SELECT p, e, unnest(x) AS v, generate_subscripts(x, 1) AS pos FROM c{rounds}))
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM v JOIN d ON d.r = v.r, h
"""


ORACLE["op13_vector_codes"] = _vector_codes_sql()


@_query
def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.source_audit import divergence

    return divergence(_documents(spark, sf_dir).select("text", "lang", "source"))


ORACLE["op12_source_audit"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
t AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(DISTINCT r) AS docs, count(*) AS n FROM t GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= 30),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
g AS (
  SELECT lang, source, coalesce(any_value(v), 0) AS v, coalesce(sum(c.n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) s LEFT JOIN l USING (lang)
  LEFT JOIN (SELECT c.* FROM c JOIN k USING (lang, term)) c USING (lang, source) GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.total + 5 * g.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 5)) // (l.total + 5 * l.v) AS q
  FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(any_value(s.value), 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source AS l, y.source AS r, sum(abs(x.p - y.p)) AS value
             FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
    ON s.lang = a.lang AND s.l = a.source AND s.r = b.source GROUP BY ALL),
term AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank
      FROM (FROM pair UNION ALL FROM term))
SELECT * FROM r WHERE part = 'pair' OR rank <= 50
"""


@_query
def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.html_wrappers import extract_main_text

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract_main_text(pages).select("page_id", "url", "text", "n_chars")


#: The given pages mark the article by its element, which SQL can cut out; the operator knows more layouts than that.
ORACLE["op11_html_text"] = r"""
WITH a AS (
  SELECT row_number() OVER () AS r, page_id, url, coalesce(regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1), '') AS inner_html
  FROM pages),
b AS (SELECT r, unnest(string_split(regexp_replace(inner_html, '</?(?:p|h[1-6]|div|ul|ol|li|section|blockquote)(?:\s[^>]*)?>', chr(1), 'g'), chr(1))) AS piece,
             generate_subscripts(string_split(regexp_replace(inner_html, '</?(?:p|h[1-6]|div|ul|ol|li|section|blockquote)(?:\s[^>]*)?>', chr(1), 'g'), chr(1)), 1) AS i
      FROM a),
t AS (SELECT r, i, regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_replace(piece, '<br[^>]*>', ' ', 'g'), '<[^>]*>', '', 'g'),
                 '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&#x27;', chr(39)), '&amp;?', '&', 'g') AS piece FROM b),
k AS (SELECT r, i, trim(regexp_replace(piece, '\s+', ' ', 'g')) AS piece FROM t),
j AS (SELECT r, string_agg(piece, chr(10) ORDER BY i) FILTER (WHERE piece <> '') AS text FROM k GROUP BY r)
SELECT page_id, url, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n_chars FROM a LEFT JOIN j USING (r)
"""
