"""Role membership with cycles reported, and its closure in rounds that grow with the logarithm of the depth.

edges(member_name, group_name).  Path doubling keeps two tables: the walks of exactly n edges and those of up to n.  One
join of the first with the second gives the walks of up to 2n, one with itself those of exactly 2n.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import forget, materialize

U, V, N = "member_name", "group_name", "paths"


def _joined(left: DataFrame, right: DataFrame, counted: bool) -> DataFrame:
    """Walks of ``left`` continued by walks of ``right``."""
    r = right.select(F.col(U).alias("_via"), F.col(V).alias("_end"), F.col(N).alias("_more"))
    n = F.sum(F.col(N) * F.col("_more")) if counted else F.lit(1).cast("long")
    return left.join(r, F.col(V) == F.col("_via")).groupBy(U, F.col("_end").alias(V)).agg(n.alias(N))


def _doubled(edges: DataFrame, counted: bool) -> tuple[DataFrame, int]:
    """Every pair with a walk between its ends (``counted``: and the number of walks, of a graph without cycles), and the rounds.

    Without cycles the walks of exactly n edges run out; with cycles the pairs stop growing.
    """
    exact = materialize(edges.select(U, V, N), "walks-exact")
    upto, rounds = exact, 0
    while True:
        rounds += 1
        more = upto.unionByName(_joined(exact, upto, counted)).groupBy(U, V)
        grown = materialize(more.agg((F.sum(N) if counted else F.max(N)).alias(N)), "walks-upto")
        twice = materialize(_joined(exact, exact, counted), "walks-exact")
        # row counts come from the Parquet footers
        done = twice.isEmpty() or (not counted and grown.count() == upto.count())
        if upto is not exact:
            forget(upto)
        forget(exact)
        upto, exact = grown, twice
        if done:
            forget(exact)
            return upto, rounds


def _core(edges: DataFrame, trims: int) -> DataFrame:
    """The edges left when roles without a member or without a group go, a few times: shallow hierarchies vanish."""
    for _ in range(trims):
        left = edges.join(edges.select(F.col(V).alias(U)).distinct(), U, "left_semi")
        left = left.join(edges.select(F.col(U).alias(V)).distinct(), V, "left_semi").select(U, V, N)
        edges = materialize(left, "core-edges")
        if edges.isEmpty():
            break
    return edges


def _counted(edges: DataFrame) -> DataFrame:
    """Parallel edges as one with their number; an end that is missing belongs to no role."""
    return (edges.where(F.col(U).isNotNull() & F.col(V).isNotNull()).groupBy(U, V).agg(F.count(F.lit(1)).alias(N)))


def membership_cycles(edges: DataFrame, trims: int = 4) -> DataFrame:
    """(role, cycle, size) of every role that reaches itself; roles of one cycle reach each other.

    ``cycle`` is the least name of the strongly connected component, ``size`` its number of roles.
    """
    core = _core(materialize(_counted(edges), "membership"), trims)
    if core.isEmpty():
        return core.select(F.col(U).alias("role"), F.col(U).alias("cycle"), F.lit(1).cast("long").alias("size"))
    reach, _ = _doubled(core.withColumn(N, F.lit(1).cast("long")), counted=False)
    back = reach.select(F.col(V).alias(U), F.col(U).alias(V))
    found = reach.join(back, [U, V], "left_semi").groupBy(F.col(U).alias("role")).agg(
        F.min(V).alias("cycle"), F.count(F.lit(1)).alias("size"))
    return materialize(found, "membership-cycles")


def membership_closure(edges: DataFrame, cycles: DataFrame | None = None, with_rounds: bool = False):
    """(user_name, group_name, paths): the closure of all memberships that involve no role of a cycle.

    A role of a cycle has no number of paths to or from it; ``cycles`` (computed here if not given) reports it instead.
    """
    found = membership_cycles(edges) if cycles is None else cycles
    bad = found.select(F.col("role").alias("_bad"))
    rest = _counted(edges).join(bad, F.col(U) == F.col("_bad"), "left_anti").join(bad, F.col(V) == F.col("_bad"), "left_anti")
    closure, rounds = _doubled(rest, counted=True)
    out = closure.select(F.col(U).alias("user_name"), F.col(V).alias("group_name"), N)
    return (out, rounds) if with_rounds else out
