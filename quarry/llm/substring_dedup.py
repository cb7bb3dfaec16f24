"""Substring dedup: an FM-index per shard, searched backwards over a wavelet matrix.

A word covered by a window of ``window`` consecutive words that also stands in a document with a smaller id is
removed.  Words are told apart by 64-bit hashes.

Shards are by content, so a document is streamed only to the shards that can hold its windows.  Each window has
an anchor, the ``gram``-word group in it with the smallest hash; equal windows have equal anchors.  Consecutive
windows with one anchor form a segment of at most 2 * window - gram words.

1. Every task lists its documents' segments by anchor and key (no words).
2. Anchors that one document alone holds cannot match and go; counts combine before the shuffle.
3. Equal segments of any number of documents are reduced to one, held by the smallest id; the words of
   these are cut from their documents and sent to the anchor's shard.
4. A shard's segments become an FM-index: BWT of the words (sorted to ``window`` words, which is
   enough for backward search of that depth), as a wavelet matrix of packed bits with rank counts.  Each window is
   searched backwards until its interval holds only itself (no match that long) or is
   complete; the smallest id among the suffixes of the interval is the window's first holder.
5. Results go back by segment key to all occurrences, and by document to the texts.

An anchor with more than ``anchor_limit`` distinct segments (the border of a passage that very many documents
hold, with other words around it) would make one large shard.  Its windows are instead grouped by a 128-bit
hash, with the smallest id combined before the shuffle: the same result from evenly spread keys.

Defined cases: a null or empty text has no words; rows without an id neither remove nor lose words; rows with equal
ids are one document to each other (a window shared only by them stays); texts of fewer words than the window
stay.  Memory: one shard of about ``shard_words`` words; a segment and a mark per window of a document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import extend_batches, row_hash, texts_of
from quarry.session import forget, materialize

MIX = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class WordHashes(dict):
    """word -> 64-bit hash; emptied when it grows large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _rolling(h: np.ndarray, width: int, factor: int) -> np.ndarray:
    """A hash of the words i .. i + width - 1 for every i."""
    n = len(h) - width + 1
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * np.uint64(factor) + h[k:k + n]
    return _mix(out)


def segments(h: np.ndarray, doc: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(anchor, key, start, windows) of the segments in words ``h`` of the documents ``doc`` (ascending numbers).

    No segment crosses from one document to the next.
    """
    n = len(h) - window + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    value = _rolling(h, gram, 0xD6E8FEB86659FD93)
    place = np.arange(len(value))

    def lesser(a, b):
        second = b[0] < a[0]  # the first of equals
        return np.where(second, b[0], a[0]), np.where(second, b[1], a[1])

    have, width, want = (value, place), 1, window - gram + 1
    while width < want:
        step = min(width, want - width)
        have = lesser((have[0][:-step], have[1][:-step]), (have[0][step:], have[1][step:]))
        width += step
    anchor_value, anchor_place = have
    whole = _rolling(h, window, 0xA0761D6478BD642F)
    valid = doc[:n] == doc[window - 1:]
    first = valid.copy()
    first[1:] &= (anchor_place[1:] != anchor_place[:-1]) | ~valid[:-1]
    start = np.flatnonzero(first)
    if not len(start):
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    run = np.cumsum(first) - 1
    count = np.bincount(run[valid], minlength=len(start))
    key = _mix(whole[start] * MIX + whole[start + count - 1] * np.uint64(0xC2B2AE3D27D4EB4F) + count.astype(np.uint64))
    return anchor_value[start], key, start, count


class WaveletMatrix:
    """Symbols as levels of packed bits; ``lead`` maps a position to that of the symbol's occurrences before it."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels = max(1, int(size - 1).bit_length())
        self.words, self.ranks, self.zeros = [], [], []
        s = symbols
        for level in range(self.levels - 1, -1, -1):
            bit = (s >> level) & 1 == 1
            packed = np.packbits(bit, bitorder="little")
            packed = np.concatenate([packed, np.zeros(8 + -len(packed) % 8, np.uint8)]).view(np.uint64)
            ones = np.bitwise_count(packed).astype(np.int64)
            self.words.append(packed)
            self.ranks.append(np.concatenate(([0], np.cumsum(ones)[:-1])))
            self.zeros.append(int(len(s) - bit.sum()))
            s = np.concatenate([s[~bit], s[bit]])
        self.first = np.zeros(size, np.int64)
        present, at = np.unique(s, return_index=True)
        self.first[present] = at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        pos = at
        one = np.uint64(1)
        for i in range(self.levels):
            word = pos >> 6
            below = (one << (pos & 63).astype(np.uint64)) - one
            ones = self.ranks[i][word] + np.bitwise_count(self.words[i][word] & below)
            up = (symbol >> (self.levels - 1 - i)) & 1 == 1
            pos = np.where(up, self.zeros[i] + ones, pos - ones)
        return pos - self.first[symbol]


class FMIndex:
    """Index of a text of symbols (0 ends a segment), for patterns of up to ``depth`` symbols."""

    def __init__(self, text: np.ndarray, size: int, depth: int):
        self.text, self.depth = text, depth
        n = len(text)
        rank, width = text.astype(np.int64), 1
        while width < depth:
            step = min(width, depth - width)
            after = np.concatenate([rank[step:], np.zeros(step, np.int64)])
            rank = np.unique(rank * (int(rank.max()) + 1) + after, return_inverse=True)[1].astype(np.int64)
            width += step
        self.suffixes = np.argsort(rank, kind="stable")
        self.matrix = WaveletMatrix(text[self.suffixes - 1], size)  # the symbol before the first is the last
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=size))))[:size]
        self.n = n

    def search(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Patterns text[s : s + depth] that stand more than once: (indices into ``starts``, low, high)."""
        live = np.arange(len(starts))
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), self.n, np.int64)
        for k in range(self.depth - 1, -1, -1):
            c = self.text[starts[live] + k]
            low = self.before[c] + self.matrix.rank(c, low)
            high = self.before[c] + self.matrix.rank(c, high)
            more = high - low > 1  # an interval of one holds only the pattern itself
            live, low, high = live[more], low[more], high[more]
        return live, low, high

    def least(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Per interval the smallest ``value`` (by text position) of its suffixes; intervals are equal or disjoint."""
        if not len(low):
            return np.zeros(0, value.dtype)
        heads, back = np.unique(low, return_inverse=True)
        ends = np.zeros(len(heads), np.int64)
        ends[back] = high
        ordered = np.append(value[self.suffixes], value.max())
        cuts = np.stack([heads, ends], axis=1).ravel()
        return np.minimum.reduceat(ordered, cuts)[::2][back]


def first_holders(words: list[np.ndarray], holder: np.ndarray, window: int) -> list[np.ndarray]:
    """Per segment, for each of its windows the smallest holder of a segment in which the window stands."""
    lengths = np.array([len(w) for w in words], np.int64)
    _, codes = np.unique(np.concatenate(words), return_inverse=True)
    begin = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1]
    total = int(lengths.sum()) + len(words)
    text = np.zeros(total, np.int64)
    inside = np.ones(total, bool)
    inside[begin + lengths] = False
    text[inside] = codes + 1
    of = np.repeat(np.arange(len(words)), lengths + 1)
    count = lengths - window + 1
    offset = np.concatenate(([0], np.cumsum(count)))
    segment = np.repeat(np.arange(len(words)), count)
    starts = begin[segment] + np.arange(offset[-1]) - offset[segment]
    out = holder[segment].copy()
    index = FMIndex(text, int(codes.max(initial=0)) + 2, window)
    at, low, high = index.search(starts)
    out[at] = index.least(low, high, holder[of])
    return np.split(out, offset[1:-1])


def _list_segments(id_type: T.DataType, window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            at = 0
            texts = texts_of(b, "text")
            while at < len(texts):
                words: list[bytes] = []
                sizes = []
                upto = at
                while upto < len(texts) and len(words) < 100_000:
                    own = texts[upto].split()
                    words.extend(own)
                    sizes.append(len(own))
                    upto += 1
                doc = np.repeat(np.arange(len(sizes)), sizes)
                anchor, key, start, count = segments(hashes.of(words), doc, window, gram)
                if len(start):
                    own = doc[start]
                    first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
                    take = pa.array(own + at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor.view(np.int64)), pa.array(key.view(np.int64)), b.column(0).take(take), b.column(1).take(take),
                         pa.array((start - first[own]).astype(np.int32)), pa.array(count.astype(np.int16))],
                        ["anchor", "key", "doc_id", "row", "start", "windows"])
                at = upto

    schema = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("key", T.LongType()),
                           T.StructField("doc_id", id_type), T.StructField("row", T.LongType()),
                           T.StructField("start", T.IntegerType()), T.StructField("windows", T.ShortType())])
    return run, schema


def _cut_words(window: int):
    """(text, asked segments) -> anchor, key, holder, the segment's word hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            out: list[tuple] = []
            for doc_id, t, asked in zip(b.column(0).to_pylist(), texts_of(b, "text"), b.column(2).to_pylist()):
                h = hashes.of(t.split())
                for s in asked:
                    out.append((s["anchor"], s["key"], doc_id, h[s["start"]:s["start"] + s["windows"] + window - 1].tobytes()))
                if len(out) > 20_000:
                    yield _columns(out)
                    out = []
            if out:
                yield _columns(out)

    def _columns(rows: list[tuple]) -> pa.RecordBatch:
        a, k, d, w = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(k, pa.int64()), pa.array(d, pa.int64()),
                                           pa.array(w, pa.binary())], ["anchor", "key", "holder", "words"])

    return run


def _search_shards(window: int):
    """Rows sorted by shard -> anchor, key, first holder per window."""

    def answer(anchors: list, keys: list, holders: list, words: list) -> pa.RecordBatch:
        found = first_holders([np.frombuffer(w, np.uint64) for w in words], np.array(holders, np.int64), window)
        offsets = np.concatenate(([0], np.cumsum([len(f) for f in found])))
        return pa.RecordBatch.from_arrays(
            [pa.array(anchors, pa.int64()), pa.array(keys, pa.int64()),
             pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(found)))], ["anchor", "key", "first"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts = None, ([], [], [], [])
        for b in batches:
            numbers = b.column(0).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist(), len(numbers)]
            columns = [b.column(i).to_pylist() for i in range(1, 5)]
            for x, y in zip(cuts[:-1], cuts[1:]):
                if x == y:
                    continue
                if numbers[x] != shard and parts[0]:
                    yield answer(*parts)
                    parts = ([], [], [], [])
                shard = numbers[x]
                for have, column in zip(parts, columns):
                    have.extend(column[x:y])
        if parts[0]:
            yield answer(*parts)

    return run


def _cut_windows(window: int):
    """Segments of hot anchors -> one row a window with two hashes of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                words = [np.frombuffer(w, np.uint64) for w in part.column(3).to_pylist()]
                if not words:
                    continue
                h = np.concatenate(words)
                doc = np.repeat(np.arange(len(words)), [len(w) for w in words])
                n = len(h) - window + 1
                ok = np.flatnonzero(doc[:n] == doc[window - 1:])
                first = np.concatenate(([0], np.cumsum([len(w) for w in words])))[:-1]
                own = doc[ok]
                take = pa.array(own)
                yield pa.RecordBatch.from_arrays(
                    [part.column(i).take(take) for i in range(3)]
                    + [pa.array((ok - first[own]).astype(np.int32)), pa.array(_rolling(h, window, 0xA0761D6478BD642F)[ok].view(np.int64)),
                       pa.array(_rolling(h, window, 0xE7037ED1A0B428DB)[ok].view(np.int64))],
                    ["anchor", "key", "holder", "at", "one", "two"])

    return run


def repeated_windows(docs: DataFrame, window: int = 13, gram: int = 4, shard_words: int = 1 << 18, anchor_limit: int = 10_000
                     ) -> DataFrame:
    """doc_id, row, marks: per document of ``docs`` (doc_id long, row, text) the windows that a smaller id holds.

    A mark is (start, bits): bit i is set if the window that begins at word start + i is repeated.
    """
    if not 1 <= gram <= window <= gram + 30:
        raise ValueError("gram must be 1 to window, and window - gram at most 30")
    run, schema = _list_segments(docs.schema["doc_id"].dataType, window, gram)
    known = docs.where(F.col("doc_id").isNotNull())
    every = materialize(known.select("doc_id", "row", "text").mapInArrow(run, schema), "segments")
    shared = materialize(every.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
                         .where("lo < hi").select("anchor"), "shared-anchors")
    found = materialize(every.join(shared, "anchor", "left_semi"), "shared-segments")
    forget(every, shared)
    # one occurrence of each distinct segment, in the smallest document
    where = F.struct("doc_id", "row", "start", "windows")
    distinct = found.groupBy("anchor", "key").agg(F.min(where).alias("at")).select("anchor", "key", "at.*")
    asked = distinct.groupBy(F.col("doc_id").alias("__id"), F.col("row").alias("__row")).agg(
        F.collect_list(F.struct("anchor", "key", "start", "windows")).alias("asked"))
    # rows that agree in id and text are cut once
    texts = known.join(asked, (known["doc_id"] == asked["__id"]) & (known["row"] == asked["__row"]))
    cut = texts.select("doc_id", "text", "asked").mapInArrow(
        _cut_words(window), "anchor long, key long, holder long, words binary")
    cut = materialize(cut.dropDuplicates(["anchor", "key"]) if _has_repeats(known) else cut, "segment-words")
    hot = materialize(cut.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > anchor_limit).select("anchor"), "hot-anchors")
    even = cut.join(hot, "anchor", "left_anti")
    words = cut.agg(F.sum(F.octet_length("words") / 8 + 1)).first()[0] or 0
    shards = max(1, -(-int(words) // shard_words))
    first = (even.select(F.pmod("anchor", F.lit(shards)).cast("int").alias("shard"), "anchor", "key", "holder", "words")
             .repartition("shard").sortWithinPartitions("shard")
             .mapInArrow(_search_shards(window), "anchor long, key long, first array<long>"))
    single = cut.join(hot, "anchor", "left_semi").select("anchor", "key", "holder", "words").mapInArrow(
        _cut_windows(window), "anchor long, key long, holder long, at int, one long, two long")
    single = materialize(single, "hot-windows")
    least = single.groupBy("one", "two").agg(F.min("holder").alias("least"))
    apart = (single.join(least, ["one", "two"]).groupBy("anchor", "key")
             .agg(F.array_sort(F.collect_list(F.struct("at", "least"))).alias("all"))  # at most one row a window
             .select("anchor", "key", F.transform("all", lambda x: x["least"]).alias("first")))
    holders = materialize(first.unionByName(apart), "first-holders")
    forget(cut, hot, single)
    bits = F.aggregate(F.transform("first", lambda x, i: F.when(x < F.col("doc_id"), F.call_function("shiftleft", F.lit(1), i))
                                   .otherwise(F.lit(0))), F.lit(0), lambda a, b: a + b)
    marks = found.join(holders, ["anchor", "key"]).select("doc_id", "row", "start", bits.alias("bits")).where("bits <> 0")
    return marks.groupBy("doc_id", "row").agg(F.collect_set(F.struct("start", "bits")).alias("marks"))


def _has_repeats(docs: DataFrame) -> bool:
    """Whether some rows agree in id and text."""
    return bool(docs.groupBy("doc_id", "row").agg(F.count(F.lit(1)).alias("n")).where("n > 1").head(1))


def drop_repeated_passages(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text", **options
                           ) -> DataFrame:
    """``docs`` with n_words, n_removed, kept (kept words joined by one space) and removed (intervals of word numbers)."""
    row = row_hash(id_col, text_col)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), row.alias("row"), F.col(text_col).alias("text"))
    marks = repeated_windows(slim, window, **options).select(
        F.col("doc_id").alias("__id"), F.col("row").alias("__row"), F.col("marks").alias("__marks"))
    joined = docs.join(marks, (docs[id_col] == marks["__id"]) & (row == marks["__row"]), "left").drop("__id", "__row")
    interval = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]))

    def make():
        def cut(b: pa.RecordBatch) -> dict[str, pa.Array]:
            n, gone, kept, spans = [], [], [], []
            for t, marks in zip(texts_of(b, text_col), b.column(b.schema.get_field_index("__marks")).to_pylist()):
                words = t.split()
                n.append(len(words))
                if not marks:
                    gone.append(0)
                    kept.append(b" ".join(words))
                    spans.append([])
                    continue
                edge = np.zeros(len(words) + 1, np.int64)
                for m in marks:
                    for i in range(m["bits"].bit_length()):
                        if m["bits"] >> i & 1:
                            edge[m["start"] + i] += 1
                            edge[m["start"] + i + window] -= 1
                covered = np.cumsum(edge[:-1]) > 0
                gone.append(int(covered.sum()))
                kept.append(b" ".join([w for w, c in zip(words, covered.tolist()) if not c]))
                turn = np.flatnonzero(np.diff(np.r_[False, covered, False].astype(np.int8))).reshape(-1, 2)
                spans.append([{"first": int(x), "end": int(y)} for x, y in turn])
            return {"n_words": pa.array(n, pa.int64()), "n_removed": pa.array(gone, pa.int64()),
                    "kept": pa.array(kept, pa.binary()).cast(pa.string()),
                    "removed": pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))}

        return cut

    return extend_batches(joined, make, [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                                         T.StructField("kept", T.StringType()), T.StructField("removed", interval)]).drop("__marks")
