"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

The words of all documents are counted (combined in each task, then shuffled), the most frequent
``lexicon_size`` are cut into pre-tokens and encoded once, and the pre-tokens are compiled into a minimal
acyclic automaton over bytes: equal suffixes share states, and every arc carries a number such that their sum along
a word is the word's place in the table of id lists.  Automaton, id lists, merges and vocabulary are one
flat file that each worker maps into memory.

Encoding splits a text at the added tokens, then by the tokenizer's pattern, walks the distinct pre-tokens of a
batch through the automaton together, and merges the ones it does not know exactly, by rank, leftmost first.  Words
met before are kept in a bounded table of the worker.  Decoding joins the bytes of the ids.

The tokenizer file is a parameter (byte-level BPE in the tokenizers library's JSON); it is read on the driver
and shipped, never trained.  Ids are packed little-endian unsigned 32-bit.

Defined cases: a null text counts as empty and has no ids; texts, documents and words may be of any length.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import tempfile
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import extend_batches, texts_of
from quarry.session import forget, materialize

# fixed value: the white space of the tokenizer's pattern engine (Unicode White_Space)
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# fixed value: the byte-level pre-tokenizer's pattern
PATTERN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
           rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file: printable Latin-1 for itself, the rest from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """bytes of each id, merge ranks and results, added tokens; all from the JSON text."""

    def __init__(self, text: str):
        j = json.loads(text)
        model = j["model"]
        letters = byte_letters()
        size = max([*model["vocab"].values(), *(a["id"] for a in j["added_tokens"])]) + 1
        self.token_bytes = [b""] * size
        for token, i in model["vocab"].items():
            self.token_bytes[i] = bytes(letters[c] for c in token)
        self.added = {a["content"]: a["id"] for a in j["added_tokens"]}
        for content, i in self.added.items():
            self.token_bytes[i] = content.encode()
        self.byte_ids = np.zeros(256, np.int64)
        for c, b in letters.items():
            self.byte_ids[b] = model["vocab"][c]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        v = model["vocab"]
        self.merges = np.array([(v[a], v[b], v[a + b]) for a, b in pairs], np.int64).reshape(-1, 3)


class Minimal:
    """A minimal acyclic automaton from words in byte order, each equivalence class of suffixes one state."""

    def __init__(self, words: list[bytes]):
        self.register: dict[tuple, int] = {}
        self.states: list[tuple[bool, list[tuple[int, int]]]] = []
        path: list[list] = [[False, []]]  # states of the last word, not yet registered
        before = b""
        for w in words:
            common = os.path.commonprefix([before, w])
            self._close(path, before, len(common))
            path.extend([False, []] for _ in range(len(w) - len(common)))
            path[-1][0] = True
            before = w
        self._close(path, before, 0)
        self.start = self._state(path[0])

    def _close(self, path: list[list], word: bytes, upto: int) -> None:
        while len(path) - 1 > upto:
            state = self._state(path.pop())
            path[-1][1].append((word[len(path) - 1], state))

    def _state(self, node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in self.register:
            self.register[key] = len(self.states)
            self.states.append((node[0], list(node[1])))
        return self.register[key]

    def arrays(self) -> dict[str, np.ndarray]:
        """arc (state * 256 + byte, ascending), target, skip (words that come before by this arc), final, start."""
        below = np.zeros(len(self.states), np.int64)
        arcs, target, skip = [], [], []
        for s, (final, out) in enumerate(self.states):  # targets have smaller numbers
            n = int(final)
            for byte, t in out:
                arcs.append(s * 256 + byte)
                target.append(t)
                skip.append(n)
                n += int(below[t])
            below[s] = n
        final = np.array([f for f, _ in self.states], np.int64)
        return {"arc": np.array(arcs, np.int64), "target": np.array(target, np.int64), "skip": np.array(skip, np.int64),
                "final": final, "start": np.array([self.start], np.int64)}


def ragged(lists: list) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, values) of lists of numbers or bytes."""
    offsets = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    return offsets, np.concatenate([np.asarray(x, np.int64) for x in lists]) if len(lists) else np.zeros(0, np.int64)


def gather(offsets: np.ndarray, values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, values) of the lists at ``rows``, one after the other."""
    size = offsets[rows + 1] - offsets[rows]
    ends = np.concatenate(([0], np.cumsum(size)))
    return ends, values[np.repeat(offsets[rows] - ends[:-1], size) + np.arange(ends[-1])]


class Tables:
    """Named integer arrays in one flat file, mapped into memory."""

    @staticmethod
    def packed(arrays: dict[str, np.ndarray]) -> bytes:
        head, body, at = {}, [], 0
        for name, a in arrays.items():
            kind = np.dtype("u1") if name.endswith("_bytes") else np.dtype("<i8") if name in ("arc", "merge_key") else np.dtype("<i4")
            data = a.astype(kind).tobytes()
            data += bytes(-len(data) % 8)
            head[name] = [at, len(a), kind.str]
            body.append(data)
            at += len(data)
        index = json.dumps(head).encode()
        index += b" " * (-len(index) % 8)
        return len(index).to_bytes(8, "little") + index + b"".join(body)

    def __init__(self, packed: bytes):
        with tempfile.NamedTemporaryFile() as f:  # the mapping outlives the name, so no file is left behind
            f.write(packed)
            f.flush()
            raw = np.memmap(f.name, np.uint8, "r")
        size = int.from_bytes(raw[:8].tobytes(), "little")
        for name, (at, n, kind) in json.loads(raw[8:8 + size].tobytes()).items():
            first = 8 + size + at
            setattr(self, name, raw[first:first + n * np.dtype(kind).itemsize].view(kind))


class Merger:
    """Exact merging of byte strings: of the pairs present, the one of lowest rank, leftmost first."""

    def __init__(self, t: Tables):
        self.key, self.rank, self.result = np.asarray(t.merge_key), np.asarray(t.merge_rank).astype(np.int64), np.asarray(t.merge_result).astype(np.int64)
        self.byte_ids = np.asarray(t.byte_ids).astype(np.int64)
        self.none = np.int64(1 << 40)
        self.single = None

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place of the pair in the key table where the pair merges, else ``none``; ordered by rank through ``rank``."""
        key = a * (1 << 32) + b
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where((self.key[at] == key) & (a >= 0) & (b >= 0), self.rank[at] * (1 << 20) + at, self.none)

    def many(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word; words of like length go through the merges together."""
        out: list = [None] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        at = 0
        while at < len(order):
            longest = max(8, 2 * len(words[order[at]]))
            if len(words[order[at]]) > 128:
                out[order[at]] = self.one(words[order[at]])
                at += 1
                continue
            group = []
            while at < len(order) and len(words[order[at]]) <= longest and len(group) < 4096:
                group.append(order[at])
                at += 1
            for i, ids in zip(group, self._together([words[i] for i in group])):
                out[i] = ids
        return out

    def _together(self, words: list[bytes]) -> list[np.ndarray]:
        n, width = len(words), max(map(len, words))
        ids = np.full((n, width + 1), -1, np.int64)
        for i, w in enumerate(words):
            ids[i, :len(w)] = self.byte_ids[np.frombuffer(w, np.uint8)]
        rank = self.ranks(ids[:, :-1], ids[:, 1:])
        done: list = [None] * n
        live = np.arange(n)
        column = np.arange(width + 1)
        while True:
            at = rank.argmin(axis=1)
            low = rank[np.arange(len(rank)), at]
            go = low < self.none
            for i in np.flatnonzero(~go).tolist():
                done[live[i]] = ids[i][ids[i] >= 0]
            if not go.any():
                return done
            live, ids, rank, at, low = live[go], ids[go], rank[go], at[go], low[go]
            row = np.arange(len(ids))
            ids[row, at] = self.result[low & ((1 << 20) - 1)]
            shift = np.minimum(column[None, :] + (column[None, :] > at[:, None]), width)
            ids = np.take_along_axis(ids, shift, axis=1)
            ids[:, -1] = -1
            rank = np.take_along_axis(rank, np.minimum(shift[:, :-1], width - 1), axis=1)
            rank[:, -1] = self.none
            rank[row, at] = self.ranks(ids[row, at], ids[row, np.minimum(at + 1, width)])
            left = at > 0
            rank[row[left], at[left] - 1] = self.ranks(ids[row[left], at[left] - 1], ids[row[left], at[left]])

    def one(self, word: bytes) -> np.ndarray:
        """A long word, with a heap of its pairs."""
        if self.single is None:
            self.single = {(int(k) >> 32, int(k) & 0xFFFFFFFF): (int(r), int(x)) for k, r, x in zip(self.key, self.rank, self.result)}
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(*self.single[p], i, *p) for i in range(n - 1) if (p := (ids[i], ids[i + 1])) in self.single]
        heap = [(r, i, x, a, b) for r, x, i, a, b in heap]
        heapq.heapify(heap)
        while heap:
            _, i, x, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = x, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and (p := (ids[left], ids[right])) in self.single:
                    r, y = self.single[p]
                    heapq.heappush(heap, (r, left, y, *p))
        return np.array([x for x in ids if x >= 0], np.int64)


class Codec:
    """Encoder and decoder of one worker over the mapped tables."""

    MOST = 300_000  # words kept

    def __init__(self, packed: bytes):
        self.t = Tables(packed)
        self.merger = Merger(self.t)
        self.find = regex.compile(PATTERN).findall
        added = json.loads(np.asarray(self.t.added_bytes).tobytes() or b"{}")
        self.added = {k: int(v) for k, v in added.items()}
        # longest first, as overlapping added tokens are matched
        self.cut = regex.compile("(" + "|".join(regex.escape(a) for a in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.vocab_offsets = np.asarray(self.t.vocab_offsets).astype(np.int64)
        self.vocab = np.asarray(self.t.vocab_bytes)
        self._empty()

    def _empty(self) -> None:
        self.rows: dict[str, int] = {}
        self.offsets, self.ids = np.zeros(1, np.int64), np.zeros(0, np.int64)
        for token, i in self.added.items():
            self.rows[token] = len(self.rows)
            self.offsets, self.ids = np.r_[self.offsets, len(self.ids) + 1], np.r_[self.ids, i]

    def look_up(self, words: list[bytes]) -> np.ndarray:
        """Place of each word in the id lists by walking the automaton, -1 where it is not in it."""
        t = self.t
        offsets = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, words), np.int64, len(words)), out=offsets[1:])
        raw = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        length = np.diff(offsets)
        place = np.full(len(words), -1, np.int64)
        live = np.arange(len(words))
        state = np.full(len(words), int(t.start[0]), np.int64)
        total = np.zeros(len(words), np.int64)
        step = 0
        while len(live) and len(t.arc):
            end = length[live] == step
            done = end & (t.final[state] == 1)
            place[live[done]] = total[done]
            live, state, total = live[~end], state[~end], total[~end]
            if not len(live):
                break
            key = state * 256 + raw[offsets[live] + step]
            at = np.minimum(np.searchsorted(t.arc, key), len(t.arc) - 1)
            ok = t.arc[at] == key
            live, state, total = live[ok], t.target[at[ok]].astype(np.int64), total[ok] + t.skip[at[ok]]
            step += 1
        return place

    def _learn(self, new: list[str]) -> None:
        words = [w.encode() for w in new]
        place = self.look_up(words)
        known = place >= 0
        lists: list = [None] * len(words)
        at, values = gather(np.asarray(self.t.word_offsets).astype(np.int64), np.asarray(self.t.word_ids), place[known])
        for j, i in enumerate(np.flatnonzero(known).tolist()):
            lists[i] = values[at[j]:at[j + 1]]
        unseen = np.flatnonzero(~known).tolist()
        for i, ids in zip(unseen, self.merger.many([words[i] for i in unseen])):
            lists[i] = ids
        offsets, ids = ragged(lists)
        for w in new:
            self.rows[w] = len(self.rows)
        self.offsets = np.r_[self.offsets, offsets[1:] + len(self.ids)]
        self.ids = np.r_[self.ids, ids]

    def split(self, text: str) -> list[str]:
        if self.cut is None or not any(a in text for a in self.added):
            return self.find(text)
        out: list[str] = []
        for part in self.cut.split(text):
            out.extend([part] if part in self.added else self.find(part))
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of the texts."""
        words: list[str] = []
        ends = [0]
        for t in texts:
            words.extend(self.split(t))
            ends.append(len(words))
        if len(self.rows) > self.MOST:
            self._empty()
        new = [w for w in dict.fromkeys(words) if w not in self.rows]
        for at in range(0, len(new), 1 << 16):
            self._learn(new[at:at + (1 << 16)])
        rows = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
        word_ends, ids = gather(self.offsets, self.ids, rows)
        return word_ends[np.array(ends)], ids

    def decode(self, ids: np.ndarray) -> bytes:
        return gather(self.vocab_offsets, self.vocab, ids)[1].tobytes()


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """word, n over all documents (words between white space); a task combines its own counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": pa.array(list(counts), pa.binary()), "n": pa.array(list(counts.values()), pa.int64())})

        for b in batches:
            for at in range(0, b.num_rows, 512):
                for t in texts_of(b.slice(at, 512), "text"):
                    counts.update(t.split())
                if len(counts) > 200_000:
                    yield rows()
                    counts.clear()
        yield rows()

    return (docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")))


def compile_tables(vocabulary: Vocabulary, frequent: list[bytes]) -> bytes:
    """The flat file: automaton and id lists of the frequent words' pre-tokens, merges, vocabulary."""
    find = regex.compile(PATTERN).findall
    tokens: set[str] = set()
    for w in frequent:
        text = w.decode("utf-8", "replace")
        tokens.update(find(" " + text))
        tokens.update(find(text))
    words = sorted(t.encode() for t in tokens)
    key = vocabulary.merges[:, 0] * (1 << 32) + vocabulary.merges[:, 1]
    order = np.argsort(key, kind="stable")
    first = np.r_[True, np.diff(key[order]) != 0] if len(order) else np.zeros(0, bool)
    order = order[first]
    vocab_offsets = np.concatenate(([0], np.cumsum([len(b) for b in vocabulary.token_bytes])))
    arrays = {"merge_key": key[order], "merge_rank": order, "merge_result": vocabulary.merges[order, 2],
              "byte_ids": vocabulary.byte_ids, "vocab_offsets": vocab_offsets,
              "vocab_bytes": np.frombuffer(b"".join(vocabulary.token_bytes), np.uint8),
              "added_bytes": np.frombuffer(json.dumps(vocabulary.added).encode(), np.uint8)}

    class Merges:  # the merger reads its tables by name
        pass

    t = Merges()
    t.__dict__.update(arrays)
    offsets, ids = ragged(Merger(t).many(words))
    return Tables.packed(arrays | {"word_offsets": offsets, "word_ids": ids} | Minimal(words).arrays())


_codecs: dict[str, Codec] = {}


def _codec(packed: bytes) -> Codec:
    """One codec a worker process and set of tables."""
    key = hashlib.sha256(packed).hexdigest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(packed)
    return _codecs[key]


def frequent_words(docs: DataFrame, most: int, text_col: str = "text") -> list[bytes]:
    """The most frequent words, in order; at most ``most``, as many whole eighths of a power of two of counts as fit.

    Words met once are left out, and those of over 64 bytes.  The driver gets one row per class of counts, then
    the chosen words, never a list from each partition.
    """
    step = F.floor(8 * F.log2("n")).cast("int")
    counts = materialize(word_counts(docs, text_col).where((F.col("n") > 1) & (F.length("word") <= 64))
                         .withColumn("step", step), "word-counts")
    least, room = None, most
    for r in sorted(counts.groupBy("step").agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True):
        room -= r["words"]
        if room < 0:
            break
        least = r["step"]
    rows = [] if least is None else counts.where(F.col("step") >= least).collect()
    forget(counts)
    return [bytes(r["word"]) for r in sorted(rows, key=lambda r: (-r["n"], r["word"]))]


def prepare(docs: DataFrame, tokenizer_path: str, lexicon_size: int = 1 << 15, text_col: str = "text"):
    """A broadcast of the tables (a few MB: bounded by the vocabulary and ``lexicon_size`` words)."""
    with open(tokenizer_path, encoding="utf-8") as f:
        vocabulary = Vocabulary(f.read())
    frequent = frequent_words(docs, lexicon_size, text_col)
    return SparkContext.getOrCreate().broadcast(compile_tables(vocabulary, frequent))


def encode_documents(docs: DataFrame, tables, decode: bool = False, text_col: str = "text") -> DataFrame:
    """``docs`` with n_tokens, ids (packed), and with ``decode`` the text that the ids give."""
    added = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    if decode:
        added.append(T.StructField("decoded", T.StringType()))

    def make():
        codec = _codec(tables.value)

        def run(b: pa.RecordBatch) -> dict[str, pa.Array]:
            count, ids, back = [], [], []
            texts = [t.decode() for t in texts_of(b, text_col)]
            for at in range(0, len(texts), 128):
                ends, found = codec.encode(texts[at:at + 128])
                for x, y in zip(ends[:-1].tolist(), ends[1:].tolist()):
                    count.append(y - x)
                    ids.append(found[x:y].astype("<u4").tobytes())
                    if decode:
                        back.append(codec.decode(found[x:y]).decode("utf-8", "replace"))
            out = {"n_tokens": pa.array(count, pa.int64()), "ids": pa.array(ids, pa.binary())}
            return out | ({"decoded": pa.array(back, pa.string())} if decode else {})

        return run

    return extend_batches(docs, make, added)


def decode_documents(encoded: DataFrame, tables) -> DataFrame:
    """``encoded`` with the text that its packed ids give; null ids give an empty text."""

    def make():
        codec = _codec(tables.value)
        return lambda b: {"decoded": pa.array([
            codec.decode(np.frombuffer(x or b"", "<u4").astype(np.int64)).decode("utf-8", "replace")
            for x in b.column(b.schema.get_field_index("ids")).to_pylist()], pa.string())}

    return extend_batches(encoded, make, [T.StructField("decoded", T.StringType())])
