"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

Each source gets a target number of words: weights are shared out by water filling, no
target above ``max_copies`` times its source.  A source whose target is r times its size
takes floor(r) whole copies of every document; the remainder is a Pareto sample: every
document draws a fixed uniform u (from its id and text) and is ranked by its random odds u/(1-u) over its
inclusion odds (those of the fraction still needed, times the document's own weight), and
the lowest ranks are taken until the words reach the target.

No source is ever sorted whole.  The cut of a source is found on the rank scaled to [0, 1):
sums over 4096 bins, then 4096 bins within the bin that holds the cut, then the few rows of
that bin in order; the sums combine before their shuffle, so a source with a third of all
rows costs no more than another.  The cut is one number per source, so documents are
joined to a table of one row per source and are not shuffled.

Rows that agree in id and text draw equally.  Where the cut falls among such rows, as many of them are taken as bring
the words nearest to the target: those rows alone are written with a number each, and the cut among them is found
on a hash of it in the same way, so any number of equal rows is parted.

Defined cases: a null text has size 0; a null source is a source of its own, last in order;
a null id draws as an id of its own, with its text; a source of size 0 has target 0; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import WORD
from quarry.session import materialize

BINS = 12  # bits of one level of bins


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _unit(text: Column) -> Column:
    """52 bits of a text's MD5 as a number in (0, 1); the same in every run and on every executor."""
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def _uniform(doc_id: Column, text: Column, seed: int) -> Column:
    own = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    return _unit(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), own))


def source_targets(sized: DataFrame, weights: tuple[float, ...], share: float, max_copies: float) -> DataFrame:
    """source, source_size, target, copies (whole copies of each document), fraction, need (words of the sample).

    One row per source; its windows see those rows only.  With the sources in order of
    capacity over weight, the water level is that of the first source it leaves below its capacity.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    per = per.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                           ((rank - 1) % len(weights) + 1).cast("int")))
    per = (per.withColumn("cap", F.col("source_size") * F.lit(float(max_copies)))
           .withColumn("total", F.lit(float(share)) * F.sum("source_size").over(everything)))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    per = (per.withColumn("level", (F.col("total") - before) / rest)
           .withColumn("level", F.when(F.col("level") <= F.col("cap") / F.col("w"), F.col("level"))))
    place = F.row_number().over(order)
    per = per.withColumn("place", F.when(F.col("level").isNotNull(), place))
    level = F.min(F.struct(F.coalesce("place", F.lit(1 << 60)), "level")).over(everything).getField("level")
    per = per.withColumn("target", F.least(F.col("cap"), F.coalesce(level * F.col("w"), F.col("cap"))))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return (per.withColumn("ratio", ratio).withColumn("copies", F.floor("ratio"))
            .withColumn("fraction", F.col("ratio") - F.col("copies"))
            .withColumn("need", F.col("target") - F.col("copies") * F.col("source_size"))
            .select("source", "source_size", "target", "copies", "fraction", "need"))


def _rank(u: Column, fraction: Column, weight: Column) -> Column:
    """The Pareto rank q = odds(u) / inclusion odds, scaled to q / (1 + q); 1 where nothing is to be sampled."""
    q = (u / (1 - u)) / (weight * fraction / (1 - fraction))
    return F.when((fraction > 0) & (weight > 0), q / (1 + q)).otherwise(F.lit(1.0))


def _first_reaching(rows: DataFrame, key: str) -> DataFrame:
    """Per source the first ``key`` at which the running words reach ``need``, with the words before it."""
    w = Window.partitionBy("source").orderBy(key)
    upto = F.sum("words").over(w)
    return (rows.withColumn("upto", upto).where(F.col("upto") >= F.col("need"))
            .groupBy("source").agg(F.min(F.struct(F.col(key), (F.col("upto") - F.col("words")).alias("before"))).alias("m"))
            .select("source", F.col(f"m.{key}").alias(key), F.col("m.before").alias("before")))


def _same_source(a: DataFrame, b: DataFrame) -> DataFrame:
    b = b.withColumnRenamed("source", "__source")
    return a.join(b, a["source"].eqNullSafe(b["__source"])).drop("__source")


def _cut(rows: DataFrame, needs: DataFrame, name: str) -> DataFrame:
    """source, v, words, before: the rank at which each source's running words reach its need.

    ``rows`` holds source, v in [0, 1] and size; ``words`` are those of all rows of that rank, ``before`` those below it.
    """
    fine = F.least(F.floor(F.col("v") * float(1 << 2 * BINS)), F.lit((1 << 2 * BINS) - 1))
    ranked = rows.select("source", "v", "size", fine.alias("fine"), F.shiftright(fine, BINS).alias("coarse"))
    binned = _same_source(ranked, needs.select("source", "need"))
    coarse = binned.groupBy("source", "need", "coarse").agg(F.sum("size").alias("words"))
    first = materialize(_same_source(_first_reaching(coarse, "coarse").withColumnRenamed("coarse", "at"),
                                     needs.select("source", "need")), f"{name}-coarse")
    inner = _same_source(ranked, first.select("source", "at", (F.col("need") - F.col("before")).alias("need"))
                         ).where(F.col("coarse") == F.col("at"))
    bins = inner.groupBy("source", "need", "fine").agg(F.sum("size").alias("words"))
    left = first.select("source", (F.col("need") - F.col("before")).alias("need"), F.col("before").alias("below"))
    second = materialize(_same_source(_first_reaching(bins, "fine").withColumnRenamed("fine", "at"), left), f"{name}-fine")
    last = _same_source(ranked, second.select("source", "at", (F.col("need") - F.col("before")).alias("need"),
                                              (F.col("below") + F.col("before")).alias("below"))
                        ).where((F.col("fine") == F.col("at")) & (F.col("size") > 0))
    last = last.groupBy("source", "need", "below", "v").agg(F.sum("size").alias("words"))  # equal ranks as one
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("v"))
    found = (last.withColumn("upto", upto).where(F.col("upto") >= F.col("need")).groupBy("source")
             .agg(F.min(F.struct("v", "words", (F.col("below") + F.col("upto") - F.col("words")).alias("before"))).alias("m")))
    return found.select("source", "m.v", "m.words", "m.before")


def plan_mix(sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, max_copies: float = 2
             ) -> DataFrame:
    """One row per source: its targets, ``cut`` and ``ties``; a document joins the sample if its rank is below the cut.

    ``sized`` holds source, size, u and weight per document and is read a few times.  Of the rows at the cut, which
    agree in id and text, ``ties`` join: as many as bring the words nearest to the target.
    """
    targets = materialize(source_targets(sized, weights, share, max_copies), "mix-targets")
    asked = targets.where(F.col("need") > 0).select("source", "fraction", "need")
    ranked = _same_source(sized, asked).select("source", "size", _rank(F.col("u"), F.col("fraction"), F.col("weight")).alias("v"))
    cuts = materialize(_cut(ranked, asked, "mix"), "mix-cuts")
    # rows of one rank have one text, hence one size
    sizes = (_same_source(ranked, cuts.select("source", F.col("v").alias("cut"))).where((F.col("v") == F.col("cut")) & (F.col("size") > 0))
             .groupBy("source").agg(F.max("size").alias("each"), F.count(F.lit(1)).alias("rows")))
    cuts = _same_source(cuts.withColumnRenamed("v", "cut"), sizes)
    cuts = cuts.select(F.col("source").alias("__cut_source"), "cut", "before", "each", "rows")
    joined = targets.join(cuts, targets["source"].eqNullSafe(cuts["__cut_source"]), "left")
    # a target that rounding leaves a hair above all words of its source has no row that reaches it
    cut = F.when(F.col("need") > 0, F.coalesce("cut", F.lit(1.0))).otherwise(F.lit(0.0))
    nearest = F.floor((F.col("need") - F.col("before")) / F.col("each") + 0.5)
    ties = F.when(F.col("need") > 0, F.least(nearest, F.col("rows")))
    return materialize(joined.select("source", "source_size", "target", "copies", "fraction", cut.alias("cut"),
                                     F.coalesce(ties, F.lit(0)).cast("long").alias("ties"), F.coalesce("rows", F.lit(0)).alias("rows")), "mix-plan")


def _take(planned: DataFrame, u: Column, weight: Column, size: Column) -> DataFrame:
    """``planned`` (rows beside their source's plan in ``__mix``) with ``__take``: how often each row is taken."""
    rank = _rank(u, F.col("__mix.fraction"), weight)
    at_cut = (rank == F.col("__mix.cut")) & (size > 0)
    parted = at_cut & (F.col("__mix.ties") > 0) & (F.col("__mix.ties") < F.col("__mix.rows"))
    rows = planned.withColumn("__rank", rank).withColumn("__parted", F.coalesce(parted, F.lit(False)))
    joins = (F.col("__rank") < F.col("__mix.cut")) | (at_cut & (F.col("__mix.ties") > 0))
    whole = rows.where("NOT __parted").withColumn("__take", (F.col("__mix.copies") + joins.cast("long")).cast("long"))
    # equal rows that the cut parts: numbered once they are written, the first by a hash of the number join
    ties = materialize(rows.where("__parted").withColumn("__row", F.monotonically_increasing_id()), "mix-ties")
    lot = ties.select(F.col("__mix.source").alias("source"), F.col("__mix.ties").alias("need"),
                      _unit(F.col("__row").cast("string")).alias("v"), F.lit(1).cast("long").alias("size"))
    last = materialize(_cut(lot, lot.select("source", "need").distinct(), "mix-ties"), "mix-tie-cuts")
    last = last.select(F.col("source").alias("__cut_source"), F.col("v").alias("__last"))
    chosen = ties.join(last, F.col("__mix.source").eqNullSafe(F.col("__cut_source")))
    chosen = chosen.withColumn("__take", (F.col("__mix.copies") + (_unit(F.col("__row").cast("string")) <= F.col("__last")).cast("long")).cast("long"))
    return whole.unionByName(chosen.drop("__row", "__cut_source", "__last"))


def _beside_plan(rows: DataFrame, source: Column, plan: DataFrame) -> DataFrame:
    """``rows`` joined to their source's plan, one row per source, as the struct ``__mix``."""
    p = plan.select(F.struct(*plan.columns).alias("__mix"))
    return rows.join(p, source.eqNullSafe(F.col("__mix.source")))


def mix_table(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, max_copies: float = 2,
              seed: int = 20, weight: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
              source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken (words), copies: what the mix takes of every document.

    ``weight`` (a column of ``docs``, positive) multiplies a document's inclusion odds.
    """
    sized = materialize(_sized(docs, weight, seed, id_col, text_col, source_col), "mix-sizes")
    planned = _beside_plan(sized, F.col("source"), plan_mix(sized, weights, share, max_copies))
    taken = _take(planned, F.col("u"), F.col("weight"), F.col("size"))
    return taken.select("doc_id", "size", F.col("__mix.source_size").alias("source_size"), F.col("__mix.target").alias("target"),
                        (F.col("size") * F.col("__take")).alias("taken"), F.col("__take").alias("copies"))


def _sized(docs: DataFrame, weight: Column | None, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    own = F.lit(1.0) if weight is None else F.coalesce(weight.cast("double"), F.lit(1.0))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       word_count(F.col(text_col)).alias("size"), _uniform(F.col(id_col), F.col(text_col), seed).alias("u"),
                       own.alias("weight"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, max_copies: float = 2,
        seed: int = 20, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: rows of ``docs`` (same columns), each as often as it is taken; only rows that tie at a cut are written first."""
    sized = materialize(_sized(docs, None, seed, id_col, text_col, source_col).select("source", "size", "u", "weight"),
                        "mix-sizes")
    plan = plan_mix(sized, weights, share, max_copies)
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), F.col(id_col).alias("__id"),
                       F.col(text_col).alias("__text"), F.col(source_col).alias("__source"))
    planned = _beside_plan(kept, F.col("__source"), plan)
    out = _take(planned, _uniform(F.col("__id"), F.col("__text"), seed), F.lit(1.0), word_count(F.col("__text")))
    out = out.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("__take").cast("int"))))
    return out.select(*[F.col("__doc").getField(c).alias(c) for c in docs.columns])
