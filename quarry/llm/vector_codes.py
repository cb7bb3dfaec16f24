"""Vector code compression: product codes learned over Hilbert-sorted flat blocks, in exact integers.

Vectors become integers, floor(1024 x), and are cut into ``parts`` consecutive parts.  The sub-vectors of a part are
sorted along a Hilbert curve and laid out in flat blocks of ``block_rows``; a block stores its box (least and
greatest value of every component), its sums and its rows.  A round measures each block's box against the entries
of its part's codebook: an entry whose least distance to the box is above another's greatest one can be
nearest to no row in it.  What is left is the block's shortlist.  One entry takes the block's sums as they
are; several are compared row by row by an integer kernel.  Tasks give one sum a component and entry, so what the driver gathers in a
round is the size of the codebooks, whatever the number of rows.

The sort range-partitions on (part, curve position, row number): equal vectors, however many, spread over
partitions.

Defined cases: rows whose vector is null, or holds a null, NaN or infinity (1024 x beyond a double counts as one),
take no part, and neither do vectors whose length is not that of the smallest id's; null ids sort last; a repeated
id is as many rows, which start codebooks in the order of their packed bytes; a length that ``parts`` does not divide gives the first parts one component more; an error
beyond a long is null.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import forget, materialize

LIMB = 40  # sums travel as signed pieces of this many bits
BLOCK = "part int, n int, lo binary, hi binary, sums binary, rows binary, vecs binary"
SUMS = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("pos", pa.int32()), ("limb", pa.int32()),
                  ("value", pa.int64())])
CODED = pa.schema([("row", pa.int64()), ("part", pa.int32()), ("entry", pa.int32()), ("error", pa.int64())])


def _pack(x: np.ndarray) -> bytes:
    """Whole numbers held as doubles, in 2, 4 or 8 bytes each (8: doubles, which hold them exactly)."""
    most = np.abs(x).max(initial=0.0)
    return x.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8").tobytes()


def _unpack(packed: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0)
    return np.frombuffer(packed, {2: "<i2", 4: "<i4", 8: "<f8"}[len(packed) // n]).astype(np.float64)


def _whole_vectors(factor: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, dims, packed = [], [], []
            lists = b.column(0)
            for i in range(b.num_rows):
                v = lists[i]
                if not v.is_valid or v.values.null_count:
                    continue
                with np.errstate(over="ignore", invalid="ignore"):
                    x = np.floor(factor * v.values.to_numpy(zero_copy_only=False).astype(np.float64))
                if np.isfinite(x).all():
                    keep.append(i)
                    dims.append(len(x))
                    packed.append(_pack(x))
            rest = b.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(dims, pa.int32()), pa.array(packed, pa.binary()),
                                              *rest.columns[1:]], ["dim", "vec", *b.schema.names[1:]])

    return run


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """(n, d) cell numbers below 2^bits -> (n, bytes) positions on the Hilbert curve, most significant byte first.

    The axes-to-transpose form of the curve (Skilling, 2004), for all rows at once.
    """
    x = cells.astype(np.uint32).copy()
    n, d = x.shape
    for bit in range(bits - 1, 0, -1):
        low = np.uint32((1 << bit) - 1)
        for i in range(d):
            high = (x[:, i] >> np.uint32(bit)) & np.uint32(1) == 1
            swap = np.where(high, np.uint32(0), (x[:, 0] ^ x[:, i]) & low)
            x[:, i] ^= swap
            x[:, 0] ^= np.where(high, low, swap)
    for i in range(1, d):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(n, np.uint32)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[:, d - 1] >> np.uint32(bit)) & np.uint32(1) == 1, np.uint32((1 << bit) - 1), np.uint32(0))
    x ^= turn[:, None]
    planes = [(x >> np.uint32(bit)) & np.uint32(1) for bit in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes, axis=1).astype(np.uint8), axis=1)


@dataclass
class Grid:
    """Cuts of every component into cells: quantiles of the starting entries (they steer the order, not the result)."""

    bounds: list[tuple[int, int]]  # of each part in the vector
    cuts: list[np.ndarray]  # per part: (components, cells - 1)
    bits: list[int]

    @classmethod
    def of(cls, start: np.ndarray, bounds: list[tuple[int, int]]) -> Grid:
        cuts, bits = [], []
        for a, z in bounds:
            b = max(1, min(8, 64 // max(z - a, 1)))
            at = np.arange(1, 1 << b) / (1 << b)
            cuts.append(np.quantile(start[:, a:z], at, axis=0).T if z > a and len(start) else np.zeros((0, len(at))))
            bits.append(b)
        return cls(bounds, cuts, bits)

    def keys(self, vectors: np.ndarray, part: int) -> list[bytes]:
        a, z = self.bounds[part]
        if z == a:
            return [b""] * len(vectors)
        cells = np.stack([np.searchsorted(c, vectors[:, a + i], "right") for i, c in enumerate(self.cuts[part])], axis=1)
        return [k.tobytes() for k in hilbert_keys(cells, self.bits[part])]


def _cut(grid: Grid):
    """(dim, vec, row) -> one row a part: part, key, row and the packed sub-vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = np.stack([_unpack(v, d) for d, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist())])
            for part, (a, z) in enumerate(grid.bounds):
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(np.full(len(x), part), pa.int32()), "key": pa.array(grid.keys(x, part), pa.binary()),
                    "row": b.column(2), "sub": pa.array([_pack(v[a:z]) for v in x], pa.binary())})

    return run


def _blocks(widths: list[int], block_rows: int):
    """Sorted sub-vectors -> flat blocks with their box and sums."""

    def block(part: int, rows: list[int], subs: list[bytes]) -> dict:
        x = np.stack([_unpack(s, widths[part]) for s in subs])
        whole = len(x) * np.abs(x).max(initial=0.0) < 2.0 ** 62
        return {"part": part, "n": len(x), "lo": x.min(axis=0).tobytes(), "hi": x.max(axis=0).tobytes(),
                "sums": x.astype(np.int64).sum(axis=0).tobytes() if whole else None,
                "rows": np.array(rows, "<i8").tobytes(), "vecs": _pack(x)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int32()), ("n", pa.int32())]
                           + [(c, pa.binary()) for c in ("lo", "hi", "sums", "rows", "vecs")])
        part, rows, subs = -1, [], []
        for b in batches:
            made = []
            for p, row, sub in zip(*(b.column(i).to_pylist() for i in range(3))):
                if rows and (p != part or len(rows) == block_rows):
                    made.append(block(part, rows, subs))
                    rows, subs = [], []
                part = p
                rows.append(row)
                subs.append(sub)
            if made:
                yield pa.RecordBatch.from_pylist(made, schema=schema)
        if rows:
            yield pa.RecordBatch.from_pylist([block(part, rows, subs)], schema=schema)

    return run


class Codebook:
    """Entries of one part with kernels that give exact squared distances."""

    def __init__(self, entries: list[list[int]]):
        self.entries = entries
        self.near = np.array(entries, dtype=np.float64).reshape(len(entries), len(entries[0]))  # for box distances
        self.most = max((abs(v) for e in entries for v in e), default=0)

    def shortlist(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Entries that may be nearest (or tie) to a row inside the box, in index order."""
        below, above = lo - self.near, self.near - hi
        least = (np.maximum(np.maximum(below, above), 0.0) ** 2).sum(axis=1)
        most = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(axis=1)
        return np.flatnonzero(least * (1 - 1e-9) <= most.min() * (1 + 1e-9))  # distances here are rounded

    def nearest(self, x: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, list[int] | np.ndarray]:
        """Index of the nearest entry of every row (ties to the lower) and the squared distance."""
        span = 2 * max(float(np.abs(x).max(initial=0.0)), float(self.most)) + 1
        reach = x.shape[1] * span * span
        if reach < 2.0 ** 52:  # every product and sum is a whole number that a double holds
            c = self.near[among]
            gap = (x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :] - 2 * (x @ c.T)
        elif reach < 2.0 ** 62:
            c, whole = self.near[among].astype(np.int64), x.astype(np.int64)
            gap = (whole * whole).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :] - 2 * (whole @ c.T)
        else:
            rows = [[int(v) for v in r] for r in x]
            gap = np.array([[sum((a - b) ** 2 for a, b in zip(r, self.entries[e])) for e in among] for r in rows], object)
        best = gap.argmin(axis=1)
        found = gap[np.arange(len(x)), best]
        return among[best], found if found.dtype == object else found.astype(np.int64)


def _split(value: int) -> list[int]:
    """Signed pieces of LIMB bits, lowest first."""
    sign, value, out = (-1 if value < 0 else 1), abs(value), []
    while value:
        out.append(sign * (value & ((1 << LIMB) - 1)))
        value >>= LIMB
    return out


class Sums:
    """Per entry: row count and component sums of one task."""

    def __init__(self, entries: int, width: int):
        self.low, self.high = np.zeros((entries, width + 1), np.int64), np.zeros((entries, width + 1), np.int64)
        self.large: dict[tuple[int, int], int] = defaultdict(int)

    def add(self, entry: int, count: int, sums: np.ndarray) -> None:
        row = np.r_[sums, count]
        high = row >> LIMB
        self.low[entry] += row - (high << LIMB)
        self.high[entry] += high

    def add_rows(self, entries: np.ndarray, x: np.ndarray) -> None:
        order = np.argsort(entries, kind="stable")
        entries, x = entries[order], x[order]
        cuts = np.flatnonzero(np.r_[True, entries[1:] != entries[:-1]])
        if len(x) * np.abs(x).max(initial=0.0) < 2.0 ** 62:
            sums = np.add.reduceat(x.astype(np.int64), cuts, axis=0)
            for e, n, s in zip(entries[cuts].tolist(), np.diff(np.r_[cuts, len(x)]).tolist(), sums):
                self.add(e, n, s)
        else:
            for e, r in zip(entries.tolist(), x):
                for pos, v in enumerate(r):
                    self.large[e, pos] += int(v)
                self.large[e, x.shape[1]] += 1

    def rows(self, part: int) -> Iterator[tuple[int, int, int, int, int]]:
        for limb, table in ((0, self.low), (1, self.high)):
            for e, pos in zip(*np.nonzero(table)):
                yield part, int(e), int(pos), limb, int(table[e, pos])
        for (e, pos), value in self.large.items():
            for limb, piece in enumerate(_split(value)):
                yield part, e, pos, limb, piece


def _block_rows(b: pa.RecordBatch, widths: list[int]) -> Iterator[tuple]:
    for part, n, lo, hi, sums, rows, vecs in zip(*(b.column(i).to_pylist() for i in range(7))):
        yield (part, n, np.frombuffer(lo, "<f8"), np.frombuffer(hi, "<f8"), sums, rows,
               lambda vecs=vecs, n=n, w=widths[part]: _unpack(vecs, n * w).reshape(n, w))


def _round(books: list[Codebook], widths: list[int]):
    """One assignment of all blocks -> count and sums of every entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [Sums(len(b.entries), w) for b, w in zip(books, widths)]
        for b in batches:
            for part, n, lo, hi, sums, _, vectors in _block_rows(b, widths):
                among = books[part].shortlist(lo, hi)
                if len(among) == 1 and sums is not None:
                    totals[part].add(int(among[0]), n, np.frombuffer(sums, "<i8"))
                else:
                    x = vectors()
                    totals[part].add_rows(books[part].nearest(x, among)[0], x)
        out = [r for part, t in enumerate(totals) for r in t.rows(part)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), SUMS)], schema=SUMS)

    return run


def _assign(books: list[Codebook], widths: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, n, lo, hi, _, rows, vectors in _block_rows(b, widths):
                entry, error = books[part].nearest(vectors(), books[part].shortlist(lo, hi))
                long = pa.array([int(e) if e < 1 << 63 else None for e in error] if error.dtype == object else error, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(rows, "<i8")), pa.array(np.full(n, part), pa.int32()),
                                                  pa.array(entry, pa.int32()), long], schema=CODED)

    return run


def _next_books(books: list[Codebook], sums: pa.Table, widths: list[int]) -> list[Codebook]:
    """Every entry that took rows becomes the floored mean of them."""
    totals: dict[tuple[int, int, int], int] = defaultdict(int)
    for part, entry, pos, limb, value in zip(*(c.to_pylist() for c in sums.columns)):
        totals[part, entry, pos] += value << (LIMB * limb)
    out = []
    for part, (book, w) in enumerate(zip(books, widths)):
        entries = []
        for e, old in enumerate(book.entries):
            n = totals.get((part, e, w), 0)
            entries.append([totals.get((part, e, pos), 0) // n for pos in range(w)] if n else old)
        out.append(Codebook(entries))
    return out


def _long(column):
    return column.try_cast("long")


def compress(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, block_rows: int = 128,
             id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             factor: float = 1024.0) -> tuple[DataFrame, list[list[list[int]]]]:
    """(vec_id, label, code, error) of every row that takes part, and the codebooks (part, entry, component).

    ``entries`` of at most 256 (two hex digits a part) come from the smallest ids.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must be 1 to 256")
    slim = vectors.select(F.col(vector_col).alias("vector"), F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"))
    kinds = {f.name: f.dataType.simpleString() for f in slim.schema}
    whole = slim.mapInArrow(_whole_vectors(factor), f"dim int, vec binary, vec_id {kinds['vec_id']}, label {kinds['label']}")
    index = materialize(whole.withColumn("row", F.monotonically_increasing_id()), "vector-index")
    first = index.orderBy(F.col("vec_id").asc_nulls_last(), "vec").select("dim", "vec").limit(entries).collect()  # at most 256
    if not first:
        none = index.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return none, [[] for _ in range(parts)]
    dim = first[0]["dim"]
    start = np.array([_unpack(bytes(r["vec"]), dim) for r in first if r["dim"] == dim])
    if len(start) < entries:  # other lengths stood among the smallest ids
        same = index.where(F.col("dim") == dim).orderBy(F.col("vec_id").asc_nulls_last(), "vec").select("vec").limit(entries)
        start = np.array([_unpack(bytes(r["vec"]), dim) for r in same.collect()])
    sizes = [dim // parts + (1 if p < dim % parts else 0) for p in range(parts)]
    bounds = [(sum(sizes[:p]), sum(sizes[:p + 1])) for p in range(parts)]
    books = [Codebook([[int(v) for v in r[a:z]] for r in start]) for a, z in bounds]
    kept = index.where(F.col("dim") == dim)

    cut = kept.select("dim", "vec", "row").mapInArrow(_cut(Grid.of(start, bounds)), "part int, key binary, row long, sub binary")
    order = ["part", "key", "row"]
    flat = (cut.repartitionByRange(*order).sortWithinPartitions(*order).select("part", "row", "sub")
            .mapInArrow(_blocks(sizes, block_rows), BLOCK))
    blocks = materialize(flat, "vector-blocks")
    for _ in range(rounds):
        part_sums = blocks.mapInArrow(_round(books, sizes), "part int, entry int, pos int, limb int, value long")
        sums = part_sums.groupBy("part", "entry", "pos", "limb").agg(F.sum("value").alias("value"))
        books = _next_books(books, sums.toArrow(), sizes)  # parts x entries x components numbers
    coded = blocks.mapInArrow(_assign(books, sizes), "row long, part int, entry int, error long")
    digits = [F.lpad(F.lower(F.hex(F.max(F.when(F.col("part") == p, F.col("entry"))))), 2, "0") for p in range(parts)]
    whole_error = F.when(F.count("error") == parts, _long(F.sum(F.col("error").cast("decimal(20,0)"))))
    codes = coded.groupBy("row").agg(F.concat(*digits).alias("code"), whole_error.alias("error"))
    found = materialize(codes.join(kept.select("row", "vec_id", "label"), "row").select("vec_id", "label", "code", "error"),
                        "vector-codes")
    forget(blocks, index)
    return found, [b.entries for b in books]


def codebooks_sha256(books: list[list[list[int]]]) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(v) for part in books for e in part for v in e).encode()).hexdigest()


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with label_error: the errors of all rows of the same label (nulls together) summed.

    The totals are written first, so that the join's side of one row a label has a known size: Spark broadcasts it below its
    threshold and else splits hot labels of the other side.
    """
    total = F.when(F.count("error") == F.count(F.lit(1)), _long(F.sum(F.col("error").cast("decimal(20,0)"))))
    totals = materialize(coded.groupBy("label").agg(total.alias("label_error")).withColumnRenamed("label", "of_label"),
                         "label-errors")
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of_label"))).drop("of_label")
