"""Source divergence audit: how far the term rates of each source stand from those of the others of its language.

Terms are counted by a token-start pointer sort.  A task lays the texts of a slice (``slice_bytes`` of whole texts,
ordered by language and source) in one buffer and keeps a pointer to the start of every term.  A multikey quicksort orders the pointers by the
terms they point at, eight bytes at a time: each pass sorts by the next eight bytes only the pointers of runs
that are still equal and go on.  Every run of equal terms then gives, for each source in it, the occurrences and the
documents they stand in.  Those counts are summed over slices by Spark, with map-side combining.

Kept terms stand in ``min_docs`` documents of the language.  A group (language, source) with N occurrences of
the V kept terms gives a term the rate p = 1 + floor(scale (count + smooth) / (N + smooth V)), in exact arithmetic.

The sum of |p - q| over all kept terms for two sources needs only the terms that one of them has: the others differ by the constant
gap of the two zero rates.  Rates are dealt by (language, pair of source blocks, term bucket); a task holds a bucket
of one block pair as a small matrix and gives one sum a pair of sources, so rows grow with the pairs asked for, not with
pairs times terms.

Defined cases: null text, language and source are empty; a group without kept terms has N = 0; a language without kept
terms has V = 0, rates of 1 + 0 and pair values 0; equal rows are documents each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import forget, materialize

COUNTED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("docs", pa.int64()),
                     ("n", pa.int64())])
SMALL = 256
TERM_BYTE = np.array([0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A or c >= 0x80 for c in range(256)])
LOWER = np.array([c + 32 if 0x41 <= c <= 0x5A else c for c in range(256)], np.uint8)


def term_pointers(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and document number of every term; document i ends at ``ends[i]``."""
    inside = TERM_BYTE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = ends[:-1][ends[:-1] < len(data)]
    first[cuts] = inside[cuts]  # a text that starts with a term does not continue the one before
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    before = ends[(ends > 0) & (ends <= len(data))] - 1
    last[before] = inside[before]
    start = np.flatnonzero(first)
    length = np.flatnonzero(last) + 1 - start
    return start, length, np.searchsorted(ends, start, "right")


def _eight(data: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Up to eight bytes from each position as a number that orders like them; ``left`` bytes count, the rest is zero.

    ``data`` has eight bytes of padding.
    """
    window = np.lib.stride_tricks.sliding_window_view(data, 8)[at]
    key = np.ascontiguousarray(window).view(">u8").ravel().astype(np.uint64)
    drop = (8 - np.minimum(left, 8)).astype(np.uint64) * np.uint64(8)
    return (key >> drop) << drop


def sort_terms(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pointers in the order of their terms, and the number of the run of equal terms each is in."""
    key = _eight(data, start, length)
    order = np.argsort(key)
    key = key[order]
    head = np.r_[True, key[1:] != key[:-1]][:len(key)]
    places, run, depth = np.arange(len(order)), np.cumsum(head) - 1, 8
    while len(places):
        # only runs of two or more with a term that goes on are looked at again
        open_runs = (np.bincount(run) > 1) & (np.bincount(run, weights=length[order[places]] > depth) > 0)
        still = open_runs[run]
        places, run = places[still], run[still]
        if not len(places):
            break
        pointers = order[places]
        if len(places) < SMALL:  # few pointers left: compare what is left of their terms at once
            rest = [data[start[p] + depth:start[p] + length[p]].tobytes() for p in pointers.tolist()]
            sub = sorted(range(len(places)), key=lambda i: (run[i], rest[i]))
            order[places] = pointers[sub]
            head[places[1:]] |= [run[i] != run[j] or rest[i] != rest[j] for j, i in zip(sub, sub[1:])]
            break
        left = np.maximum(length[pointers] - depth, 0)  # terms that end here have key 0 and sort first
        key = _eight(data, np.minimum(start[pointers] + depth, len(data) - 8), left)
        sub = np.lexsort((key, run))
        order[places], key = pointers[sub], key[sub]
        parts = np.r_[True, (key[1:] != key[:-1]) | (run[1:] != run[:-1])]
        head[places] |= parts
        run = np.cumsum(parts) - 1
        depth += 8
    return order, np.cumsum(head) - 1


def _count_slice(texts: pa.Array, langs: list[str], sources: list[str]) -> pa.RecordBatch:
    """Occurrences and documents of every (language, source, term) of a slice."""
    groups = sorted(set(zip(langs, sources)))
    number = {g: i for i, g in enumerate(groups)}
    of = np.array([number[g] for g in zip(langs, sources)])
    by_group = np.argsort(of, kind="stable")
    of = of[by_group]
    texts = pc.take(texts, pa.array(by_group)).cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    body = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    data = np.zeros(len(body) + 8, np.uint8)
    np.take(LOWER, body, out=data[:len(body)])
    start, length, doc = term_pointers(data[:len(body)], offsets[1:] - offsets[0])
    order, run = sort_terms(data, start, length)
    if not len(order):
        return pa.RecordBatch.from_pylist([], schema=COUNTED)
    # within a run by document, hence by group: documents lie in the order of their groups
    both = np.sort(run.astype(np.uint64) << np.uint64(32) | doc[order].astype(np.uint64))
    run_of, doc_of = (both >> np.uint64(32)).astype(np.int64), (both & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new_doc = np.r_[True, both[1:] != both[:-1]]
    group = of[doc_of]
    cuts = np.flatnonzero(np.r_[True, (run_of[1:] != run_of[:-1]) | (group[1:] != group[:-1])])
    n = np.diff(np.r_[cuts, len(both)])
    docs = np.add.reduceat(new_doc.astype(np.int64), cuts)
    sample = order[np.searchsorted(run, run_of[cuts])]  # one pointer of the run
    at, size = start[sample], length[sample]
    flat = np.repeat(at - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
    bounds = np.r_[0, np.cumsum(size)].astype(np.int32)
    terms = pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(bounds), pa.py_buffer(data[flat])])
    which = pa.array(group[cuts])
    return pa.RecordBatch.from_arrays([pc.take(pa.array([g[0] for g in groups], pa.string()), which),
                                       pc.take(pa.array([g[1] for g in groups], pa.string()), which), terms,
                                       pa.array(docs), pa.array(n)], schema=COUNTED)


def _count_terms(slice_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            lang, source, text = (table.column(i) for i in range(3))
            text = pa.chunked_array([c.cast(pa.large_binary()) for c in text.chunks]).combine_chunks()
            return _count_slice(text, lang.to_pylist(), source.to_pylist())

        for b in batches:
            lengths = np.cumsum(pc.binary_length(b.column(2)).to_numpy(zero_copy_only=False))
            at = 0
            while at < b.num_rows:  # whole texts, a slice past ``slice_bytes`` by one text at most
                base = int(lengths[at - 1]) if at else 0
                to = min(int(np.searchsorted(lengths, base + slice_bytes - size)) + 1, b.num_rows)
                held.append(b.slice(at, to - at))
                size += int(lengths[to - 1]) - base
                at = to
                if size >= slice_bytes:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    return run


def count_terms(docs: DataFrame, slice_bytes: int = 8 << 20, text_col: str = "text", lang_col: str = "lang",
                source_col: str = "source") -> DataFrame:
    """(lang, source, term, docs, n) over all texts."""
    slim = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a)
                         for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    part = slim.mapInArrow(_count_terms(slice_bytes), "lang string, source string, term binary, docs long, n long")
    return part.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))


def _rate(n: Column, total: Column, kept: Column, smooth: int, scale: int) -> Column:
    """1 + floor(scale (n + smooth) / (total + smooth kept)) on decimals, exact; 1 where nothing is kept."""
    whole = "decimal(20,0)"
    top = (n + F.lit(smooth)).cast(whole) * F.lit(scale).cast("decimal(10,0)")
    below = (total + F.lit(smooth) * kept).cast(whole)
    return F.lit(1).cast("long") + F.coalesce(F.call_function("div", top, F.nullif(below, F.lit(0).cast(whole))),
                                              F.lit(0).cast("long"))


def _pair_sums(block: int):
    """Rows of one (language, block pair, bucket) -> sums over its terms of |p - q| less the gap of the zero rates."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        a, b = key[1].as_py(), key[2].as_py()
        number, zero = table.column("number").to_numpy(), table.column("zero").to_numpy()
        numbers, row = np.unique(number, return_inverse=True)
        base = np.zeros(len(numbers), np.int64)
        base[row] = zero
        seen = np.flatnonzero(pc.is_valid(table.column("term")).to_numpy())
        terms, column = np.unique(table.column("term").take(pa.array(seen)).combine_chunks().dictionary_encode().indices.to_numpy(),
                                  return_inverse=True)
        rates = np.repeat(base[:, None], len(terms), axis=1)
        rates[row[seen], column] = table.column("p").to_numpy()[seen]
        left, right = numbers // block == a, numbers // block == b
        lefts, rights, values = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in np.flatnonzero(left):
            others = np.flatnonzero(right & (numbers > numbers[i]))
            values.append(np.abs(rates[others] - rates[i]).sum(axis=1) - len(terms) * np.abs(base[others] - base[i]))
            lefts.append(np.full(len(others), numbers[i]))
            rights.append(numbers[others])
        l, r, v = (np.concatenate(x) for x in (lefts, rights, values))
        return pa.table({"lang": pa.array([key[0].as_py()] * len(l), pa.string()), "l": l, "r": r, "value": v})

    return run


def divergence(docs: DataFrame, min_docs: int = 30, smooth: int = 5, scale: int = 1_000_000_000, top: int = 50,
               block: int = 64, bucket_cells: int = 65_536, slice_bytes: int = 8 << 20, text_col: str = "text",
               lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank.

    ``pair``: item is every other source of the language, value the sum over its kept terms of |p - q|.
    ``term``: item is a kept term that the group has at a higher rate than the language, value the gap; the ``top``
    first.  Ranks go by value descending, then item.
    """
    counts = materialize(count_terms(docs, slice_bytes, text_col, lang_col, source_col), "term-counts")
    in_lang = (counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
               .where(F.col("docs") >= min_docs).drop("docs"))
    in_lang = materialize(in_lang, "kept-terms")
    kept = materialize(counts.join(in_lang, ["lang", "term"]), "kept-counts")
    seen = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
                       F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source")).distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = materialize(in_lang.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total")), "kept-langs")
    zero = F.lit(0).cast("long")
    # one row a (language, source): numbered within the language, with its totals and the rate of a term it lacks
    stats = (seen.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
             .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "v", "lang_total")])
             .withColumn("number", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1)
             .withColumn("zero", _rate(zero, F.col("total"), F.col("v"), smooth, scale))
             .withColumn("blocks", F.floor((F.count(F.lit(1)).over(Window.partitionBy("lang")) + (block - 1)) / block)))
    stats = materialize(stats, "group-stats")
    rated = materialize(
        kept.join(stats, ["lang", "source"])
        .select("lang", "source", "term", "number", "zero", "blocks", "v",
                _rate(F.col("n"), F.col("total"), F.col("v"), smooth, scale).alias("p"),
                _rate(F.col("lang_n"), F.col("lang_total"), F.col("v"), smooth, scale).alias("q")), "term-rates")
    forget(counts, in_lang, kept)

    # pairs: every row goes to the pairs of its block with each block of the language; every bucket has a row without a
    # term for each of its sources, as one that has none of the bucket's terms has their zero rates
    own = F.floor(F.col("number") / block)
    buckets = F.ceil(F.col("v") * F.lit(2 * block) / F.lit(bucket_cells))
    placed = ["lang", "blocks", "bucket", "term", "number", "zero", "p"]
    present = rated.withColumn("bucket", F.pmod(F.xxhash64("term"), buckets)).select(*placed)
    groups = (stats.where("v > 0").withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), buckets - 1)))
              .withColumn("term", F.lit(None).cast("binary")).withColumn("p", F.col("zero")).select(*placed))
    dealt = (present.unionByName(groups).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("lang", F.least(own, "other").alias("a"), F.greatest(own, "other").alias("b"), "bucket", "term", "number",
                     "zero", "p"))
    sums = (dealt.groupBy("lang", "a", "b", "bucket").applyInArrow(_pair_sums(block), "lang string, l long, r long, value long")
            .groupBy("lang", "l", "r").agg(F.sum("value").alias("value")))
    sums = materialize(sums, "pair-sums")
    both = sums.select("lang", "l", "r", "value").unionByName(sums.select("lang", F.col("r").alias("l"), F.col("l").alias("r"), "value"))
    one = stats.select("lang", "source", F.col("number").alias("l"), F.col("zero").alias("zero_l"), "v")
    two = stats.select("lang", F.col("source").alias("item"), F.col("number").alias("r"), F.col("zero").alias("zero_r"))
    asked = one.join(two, "lang").where("l <> r")  # the rows of the report themselves
    pairs = (asked.join(both, ["lang", "l", "r"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item",
                     (F.coalesce("value", zero) + F.col("v") * F.abs(F.col("zero_l") - F.col("zero_r"))).alias("value")))
    terms = rated.where(F.col("p") > F.col("q")).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(order)
    return (pairs.withColumn("rank", rank)
            .unionByName(terms.withColumn("rank", rank).where(F.col("rank") <= top)))
