"""Cycles and closure of role membership against plain Python."""

import random
from collections import defaultdict
from functools import lru_cache

import pytest

from quarry.operators.closure import membership_closure, membership_cycles

EDGE = "member_name string, group_name string"


def plain(edges):
    out = defaultdict(list)
    for a, b in edges:
        if a is not None and b is not None:
            out[a].append(b)

    def reach(a):
        seen, todo = set(), list(out[a])
        while todo:
            b = todo.pop()
            if b not in seen:
                seen.add(b)
                todo += out[b]
        return seen

    reached = {a: reach(a) for a in list(out)}
    cycles = {a: sorted(b for b in r if a in reached.get(b, ())) for a, r in reached.items() if a in r}
    rest = defaultdict(list)
    for a, bs in list(out.items()):
        rest[a] = [b for b in bs if a not in cycles and b not in cycles]

    @lru_cache(None)
    def paths(a, b):
        return sum((c == b) + paths(c, b) for c in rest.get(a, ()))

    roles = {x for e in edges for x in e if x is not None}
    closure = {(a, b, paths(a, b)) for a in roles for b in roles if a not in cycles and b not in cycles and paths(a, b)}
    return {(a, c[0], len(c)) for a, c in cycles.items()}, closure


CASES = {
    "self": [("a", "a"), ("a", "b")], "two": [("a", "b"), ("b", "a"), ("x", "a"), ("b", "y"), ("x", "y")],
    "diamonds": [(f"r{i}", f"r{j}") for i in range(12) for j in (i + 1, i + 2)] + [("r0", "r1")],  # a parallel edge
    "nulls": [(None, "a"), ("a", None), ("a", "b"), ("b", "c"), ("c", "b")], "repeated": [("a", "b")] * 3 + [("b", "c")] * 2,
    "two cycles": [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("e", "d"), ("e", "f"), ("g", "f"), ("h", "g")],
    "hub": [(f"u{i}", "hub") for i in range(200)] + [("hub", "top")],
}


def test_named_and_random_graphs(spark):
    """All graphs at once, told apart by a prefix of their roles."""
    r = random.Random(1)
    graphs = dict(CASES) | {f"random {n} {m}": [(f"r{r.randrange(n)}", f"r{r.randrange(n)}") for _ in range(m)]
                            for n, m in ((12, 14), (20, 22), (15, 40))}
    edges = [tuple(x and f"{name}/{x}" for x in e) for name, es in graphs.items() for e in es]
    df = spark.createDataFrame(edges, EDGE)
    cycles, closure = plain(edges)
    found = membership_cycles(df)
    assert {tuple(x) for x in found.collect()} == cycles
    assert {tuple(x) for x in membership_closure(df, found).collect()} == closure


@pytest.mark.parametrize("edges", [[], [("a", "b")]])
def test_without_cycles(spark, edges):
    df = spark.createDataFrame(edges, EDGE)
    assert membership_cycles(df).collect() == []
    assert [tuple(r) for r in membership_closure(df).collect()] == [(*e, 1) for e in edges]


def test_rounds_follow_the_logarithm_of_the_depth(spark):
    chain = spark.createDataFrame([(f"{i:05d}", f"{i + 1:05d}") for i in range(400)], EDGE)
    closure, rounds = membership_closure(chain, with_rounds=True)
    assert closure.count() == 400 * 401 // 2 and rounds <= 9
    ring = chain.unionByName(spark.createDataFrame([("00300", "00000")], EDGE))
    assert membership_cycles(ring).groupBy("cycle", "size").count().collect()[0].asDict() == {"cycle": "00000", "size": 301, "count": 301}
