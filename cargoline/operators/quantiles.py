"""Exact continuous percentile (``percentile_cont``) that survives hot groups.

Spark's exact ``percentile`` keeps a value->count map per group in one task,
so a group holding a third of a 100 TB table would not fit.  This operator
stays exact without that, and moves no row of the input by its group:

1. one aggregate pass per group: ``count`` and an approximate bracket
   ``percentile_approx(v, [p - m, p + m], accuracy)`` (GK sketch, rank error
   at most n / accuracy, partial aggregation on the map side).  The brackets, one
   row a group, are written; up to BROADCAST_GROUPS of them are broadcast, more are joined;
2. one aggregate counts rows per (side of the bracket, value): values below
   or above the bracket collapse into one count each, values inside -- about
   ``8 n / accuracy`` ranks (wider, in ranks, for small groups) -- are counted
   per distinct value.  Partial aggregation does this in the scan's tasks, so only those
   counts are exchanged, and they are written;
3. inside the bracket, values are dealt by their place to a thousand parts; a window
   over the part counts finds the parts that hold ranks floor/ceil of ``p (n - 1)``,
   and a window over the distinct values of those parts alone finds the values, which
   are interpolated linearly, the ``percentile_cont`` definition.

If the sketch ever missed its guarantee, the group is widened to all its
values.  The input is read once for the sketch and once for the counts, both when the
operator is called: hand in a written frame where it is costly to compute.
``method="approx"`` returns ``percentile_approx`` (an observed value) and
``method="builtin"`` Spark's exact ``percentile`` for small groups.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


from cargoline.session import written_once

#: parts of a bracket; the last window sees one of them
SUB_BRACKETS = 1000
#: groups up to this number have their brackets (keys and two numbers each) broadcast
BROADCAST_GROUPS = 50_000


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", small: bool = False) -> DataFrame:
    if not keys:
        return left.crossJoin(F.broadcast(right)) if how == "inner" else left.join(right, how=how)
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(F.broadcast(renamed) if small else renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def percentile_cont(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    p: float,
    alias: str = "percentile",
    method: str = "exact",
    accuracy: int = 10000,
    extra: Sequence = (),
) -> DataFrame:
    """Return ``keys + extra + [alias]``: the p-th continuous percentile of
    ``value`` over the non-NULL values of each group (NULL for a group without
    any).  ``extra`` are aggregate columns over the group's rows, computed in
    the same first pass -- a scorecard and its percentile read the input twice.
    """
    keys = list(keys)
    extra = list(extra)
    extra_names = [df.select(e).columns[0] for e in extra] if extra else []
    if method in ("builtin", "approx"):
        fn = F.percentile if method == "builtin" else (lambda c, q: F.percentile_approx(c, q, accuracy))
        return df.groupBy(*keys).agg(*extra, fn(F.col(value).cast("double"), p).alias(alias))
    if method != "exact":
        raise ValueError(f"unknown method {method!r}")
    v = df.select(*keys, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())

    # Bracket half-widths (in quantile units), narrowest first.  A group uses
    # the narrowest one spanning at least 8 ranks on each side of the target:
    # with half-width m >= 4/accuracy the sketch's rank error (n/accuracy) plus
    # the floor/ceil of the target take at most m*n/4 + 2 of them.  Wider ones
    # serve small groups, where one rank is a large share; the last is the
    # whole range (min..max) for groups of a handful of values.
    margins = sorted({4.0 / accuracy, 16.0 / accuracy, 64.0 / accuracy, 1 / 64, 1 / 16, 1 / 4} - {0.0})
    margins = [m for m in margins if m >= 4.0 / accuracy and m < 1.0] + [1.0]
    probs = []
    for m in margins:
        probs += [max(0.0, p - m), min(1.0, p + m)]
    x = F.col(value).cast("double")
    stats = df.groupBy(*keys).agg(
        *extra,
        F.count(x).alias("_n"),
        F.percentile_approx(x, probs, accuracy).alias("_b"),
        F.min(x).alias("_min"),
        F.max(x).alias("_max"),
    )
    pick_lo = pick_hi = None
    for i in reversed(range(len(margins))):
        lo_i = F.col("_min") if probs[2 * i] <= 0.0 else F.col("_b")[2 * i]
        hi_i = F.col("_max") if probs[2 * i + 1] >= 1.0 else F.col("_b")[2 * i + 1]
        wide_enough = F.lit(margins[i]) * F.col("_n") >= 8
        if pick_lo is None:
            pick_lo, pick_hi = lo_i, hi_i
        else:
            pick_lo = F.when(wide_enough, lo_i).otherwise(pick_lo)
            pick_hi = F.when(wide_enough, hi_i).otherwise(pick_hi)
    stats = stats.select(*keys, *extra_names, "_n", pick_lo.alias("_lo"), pick_hi.alias("_hi")) \
        .withColumn("_pos", (F.col("_n") - 1).cast("double") * F.lit(p)) \
        .withColumn("_r_lo", F.floor("_pos")) \
        .withColumn("_r_hi", F.ceil("_pos"))
    stats = written_once(stats, "quantile-brackets")
    key_bytes = sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys), F.lit(0))
    size = stats.agg(F.count(F.lit(1)).alias("n"), F.sum(key_bytes).alias("bytes")).first()  # one row a group
    small = size.n <= BROADCAST_GROUPS and (size.bytes or 0) <= 64 * BROADCAST_GROUPS

    bounds = stats.filter(F.col("_n") > 0)
    counts = written_once(bracket_counts(v, bounds, keys, small), "quantile-counts")
    # Counts by part (at most SUB_BRACKETS + 2 rows a group) tell which parts hold the
    # target ranks; only their distinct values are put in order.
    def running(order: Sequence[str], within_keys: Sequence[str]):
        return Window.partitionBy(*within_keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    parts = counts.groupBy(*keys, "_part").agg(F.sum("_c").alias("_c"))
    parts = parts.withColumn("_before", F.sum("_c").over(running(["_part"], keys)) - F.col("_c"))
    parts = _null_safe_join(parts, bounds.select(*keys, "_pos", "_r_lo", "_r_hi"), keys, small=small)
    first, last = F.col("_before"), F.col("_before") + F.col("_c") - 1
    holding = written_once(parts.filter((first <= F.col("_r_hi")) & (last >= F.col("_r_lo"))), "quantile-parts")  # three rows a group at most
    missed = holding.filter(~F.col("_part").between(0, SUB_BRACKETS - 1)).select(*keys).distinct()
    ranked = _null_safe_join(counts, holding.select(*keys, F.col("_part").alias("_p"), "_before", "_pos", "_r_lo", "_r_hi"), keys, small=small)
    ranked = ranked.filter(F.col("_part") == F.col("_p"))
    ranked = ranked.withColumn("_cum", F.col("_before") + F.sum("_c").over(running(["_x"], [*keys, "_part"])))
    covers = lambda r: (F.col("_cum") - F.col("_c") <= F.col(r)) & (F.col("_cum") > F.col(r))
    picked = ranked.groupBy(*keys).agg(
        F.max(F.when(covers("_r_lo"), F.col("_x"))).alias("_x_lo"),
        F.max(F.when(covers("_r_hi"), F.col("_x"))).alias("_x_hi"),
        F.max("_pos").alias("_pos"),
        F.max("_r_lo").alias("_r_lo"),
    )
    values = picked.select(*keys, (F.col("_x_lo") + (F.col("_pos") - F.col("_r_lo")) * (F.col("_x_hi") - F.col("_x_lo")))
                           .cast("double").alias("_inside"))
    out = _null_safe_join(stats.select(*keys, *extra_names), values, keys, "left", small)
    answer = F.col("_inside")
    if not missed.isEmpty():  # a rank outside its bracket breaks the sketch's guarantee: all the group's values
        wide = _null_safe_join(v, missed, keys, small=small).groupBy(*keys).agg(F.percentile("_v", p).cast("double").alias("_whole"))
        out = _null_safe_join(out, wide, keys, "left", small)
        answer = F.coalesce("_whole", "_inside")
    # every group of the input, with NULL where it had no value
    return out.select(*keys, *extra_names, answer.alias(alias))


def bracket_counts(v: DataFrame, bounds: DataFrame, keys: Sequence[str], small: bool) -> DataFrame:
    """Rows of ``v`` (keys, _v) counted per group, part and value.

    Every value falls below (part -1), inside or above (part SUB_BRACKETS) its group's
    bracket; outside, all values of a side are one count.  Inside, values are dealt by
    their place in the bracket to SUB_BRACKETS parts.
    """
    tagged = _null_safe_join(v, bounds.select(*keys, "_lo", "_hi"), keys, small=small)
    side = F.when(F.col("_v") < F.col("_lo"), 0).when(F.col("_v") > F.col("_hi"), 2).otherwise(1)
    within = F.when(F.col("_hi") > F.col("_lo"), F.least(
        F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * SUB_BRACKETS), F.lit(SUB_BRACKETS - 1))).otherwise(0)
    part = F.when(side == 0, -1).when(side == 2, SUB_BRACKETS).otherwise(within).cast("int")
    return tagged.groupBy(*keys, part.alias("_part"), F.when(side == 1, F.col("_v")).alias("_x")).agg(F.count(F.lit(1)).alias("_c"))
