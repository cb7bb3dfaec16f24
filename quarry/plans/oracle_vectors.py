"""DuckDB SQL for the random-projection LSH index (oracles of ``index_vectors`` and
``vector_topk_lsh``).

Spark's ``BucketedRandomProjectionLSH`` draws its projections from
``java.util.Random(seed)``: ``num_tables`` vectors of ``dim`` Gaussians (polar method,
drawn in pairs), each scaled to unit length.  The generator below follows that
published rule, so the projections are rebuilt here from the seed rather than
listed.  Bucket of a vector for table j: ``floor(dot(x, u_j) / bucket_length)``.
"""

from __future__ import annotations

import math

# Fixed values of java.util.Random (linear congruential generator, 48-bit state).
_MULT = 0x5DEECE66D
_ADD = 0xB
_MASK = (1 << 48) - 1


class _JavaRandom:
    def __init__(self, seed: int):
        self._s = (seed ^ _MULT) & _MASK
        self._spare = None

    def _next(self, bits: int) -> int:
        self._s = (self._s * _MULT + _ADD) & _MASK
        return self._s >> (48 - bits)

    def next_double(self) -> float:
        return ((self._next(26) << 27) + self._next(27)) * 2.0 ** -53

    def next_gaussian(self) -> float:
        if self._spare is not None:
            g, self._spare = self._spare, None
            return g
        while True:
            v1, v2 = 2 * self.next_double() - 1, 2 * self.next_double() - 1
            s = v1 * v1 + v2 * v2
            if 0 < s < 1:
                break
        m = math.sqrt(-2 * math.log(s) / s)
        self._spare = v2 * m
        return v1 * m


def projections(seed: int, num_tables: int, dim: int) -> list[list[float]]:
    r = _JavaRandom(seed)
    out = []
    for _ in range(num_tables):
        g = [r.next_gaussian() for _ in range(dim)]
        n = math.sqrt(sum(x * x for x in g))
        out.append([x / n for x in g])
    return out


def buckets_sql(source: str, id_col: str, vec_col: str, seed: int, num_tables: int, dim: int,
                bucket_length: float) -> str:
    """CTEs (without WITH) ending in ``lsh_buckets(<id_col>, "table", bucket)``."""
    rows = ", ".join(f"({j}, [{', '.join(repr(x) for x in u)}]::DOUBLE[])"
                     for j, u in enumerate(projections(seed, num_tables, dim)))
    return f"""lsh_proj AS (SELECT * FROM (VALUES {rows}) AS t(tbl, u)),
lsh_buckets AS (
  SELECT s.{id_col}, CAST(p.tbl AS INTEGER) AS "table",
         CAST(floor(list_dot_product(CAST(s.{vec_col} AS DOUBLE[]), p.u) / {float(bucket_length)}) AS BIGINT) AS bucket
    FROM {source} s CROSS JOIN lsh_proj p)"""
