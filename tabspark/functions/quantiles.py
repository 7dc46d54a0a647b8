"""Exact percentiles from one read of the input, safe when one group holds most of the rows.

Spark's built-in ``percentile`` keeps a value->count map per group and merges it in one task, so a hot group
with many distinct values lands whole in one task. ``exact_percentiles`` selects the wanted ranks by ranges:

1. rows are counted per (group, value) with map-side partial aggregation: the only shuffle of the input, and
   one that deals a hot group out by value;
2. every value has an order-preserving range code (about 0.017 % wide, data independent, so no extra job finds
   boundaries); the counts of the ranges get prefix sums per group (a window over the group's range rows: at
   most 4096 per power of two spanned by its values);
3. only ranges that hold a wanted rank are ranked inside, from the counts of step 1 (Spark reuses that
   exchange), and
4. neighbours of ``p * (n - 1)`` are interpolated linearly.

Sums that callers want beside the percentiles (counts, failures, totals, means) travel with the counts of
step 1, so a panel reads its input once.

The position ``p * (n - 1)`` and the interpolation ``lo + (hi - lo) * frac`` are evaluated in fixed-point
decimal and rounded HALF_UP, so the result is exact and does not depend on task order. ``method="approx"``
switches to Spark's bounded-memory ``percentile_approx`` sketch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabspark.functions.columns import join_null_safe as _join

# Sub-buckets per power of two; bucket width is 2**(1/4096) - 1, about
# 0.017 %, so even a group holding a third of a very large table leaves only
# a few million distinct values in the bucket that holds a wanted rank.
_RESOLUTION = 4096
# Fixed-point type for exact interpolation and means (9 decimals, < 1e15).
VALUE_DEC = "decimal(24,9)"


def _p_literal(p: float) -> tuple[str, int]:
    """Exact decimal text of a probability and its number of decimals."""
    d = Decimal(repr(float(p))).normalize()
    digits = max(0, -d.as_tuple().exponent)
    if digits > 8:
        raise ValueError(f"percentile {p} has more than 8 decimals")
    return format(d, "f"), digits


def _fixed(c: Column) -> Column:
    """Fixed-point value, null when the double has no 9-decimal form
    (NaN, +-inf, |v| >= 1e15)."""
    return c.cast("double").try_cast(VALUE_DEC)


def _unfixable(c: Column) -> Column:
    """Rows whose value is present but has no fixed-point form."""
    return F.count(F.when(c.isNotNull() & _fixed(c).isNull(), F.lit(1)))


def exact_mean(value: str | Column, decimals: int = 9) -> Column:
    """Mean in fixed point: exact sum of 9-decimal values, rounded HALF_UP.

    Unlike a double average it does not depend on the order in which tasks
    add their partial sums, so it is the same on every run and every engine.
    Groups holding NaN, infinities or values beyond 1e15 fall back to the
    double average.
    """
    c = F.col(value) if isinstance(value, str) else value
    exact = F.round(F.avg(_fixed(c)), decimals).cast("double")
    return F.when(_unfixable(c) == 0, exact).otherwise(F.avg(c.cast("double")))


def exact_sum(value: str | Column) -> Column:
    """Order-independent sum: 9-decimal fixed point, returned as double."""
    c = F.col(value) if isinstance(value, str) else value
    return F.when(_unfixable(c) == 0, F.sum(_fixed(c)).cast("double")).otherwise(F.sum(c.cast("double")))


def value_bucket(v: Column) -> Column:
    """Monotone (non-decreasing) integer code of a double.

    Negative values map below zero, zero sits in between, NaN above +inf,
    matching Spark's total order for doubles.
    """
    # codes: positives in [-1075*R, 1024*R], zero at -10M, negatives below
    # -15M (mirrored), infinities and NaN at the ends
    pos = F.floor(F.log2(v) * _RESOLUTION)
    neg = -F.floor(F.log2(-v) * _RESOLUTION) - F.lit(20_000_000)
    return (
        F.when(F.isnan(v), F.lit(100_000_000))
        .when(v == float("inf"), F.lit(90_000_000))
        .when(v == float("-inf"), F.lit(-90_000_000))
        .when(v > 0, pos)
        .when(v < 0, neg)
        .otherwise(F.lit(-10_000_000))
        .cast("long")
    )


def bucket_end(code: Column) -> Column:
    """Upper end of the range that a ``value_bucket`` code stands for (the value itself for zero, NaN and the
    infinities; for negative values the end nearer to zero)."""
    step = F.lit(1.0 / _RESOLUTION)
    return (
        F.when(code == 100_000_000, F.lit(float("nan")))
        .when(code == 90_000_000, F.lit(float("inf")))
        .when(code == -90_000_000, F.lit(float("-inf")))
        .when(code == -10_000_000, F.lit(0.0))
        .when(code < -10_000_000, -F.pow(F.lit(2.0), -(code + 20_000_000) * step))
        .otherwise(F.pow(F.lit(2.0), (code + 1) * step))
    )


def percentile_expr(value: str | Column, p: float, method: str = "exact") -> Column:
    """Single-aggregate percentile for places where groups are provably small."""
    c = F.col(value) if isinstance(value, str) else value
    if method == "approx":
        return F.percentile_approx(c.cast("double"), p, 10000)
    return F.percentile(c.cast("double"), F.lit(p))


def _wanted_ranks(ps: Mapping[str, float], n: Column):
    """Per percentile: (lo rank, hi rank, frac) of the linear interpolation,
    computed in fixed-point decimal."""
    out = []
    for name in ps:
        text, digits = _p_literal(ps[name])
        pos = (n - 1).cast("decimal(20,0)") * F.lit(text).cast(f"decimal({digits + 1},{digits})")
        lo_r = F.floor(pos).cast("long")
        frac = (pos - F.floor(pos)).cast("decimal(10,8)")
        out.append((lo_r, F.when(frac > 0, lo_r + 1).otherwise(lo_r), frac))
    return out


def _interpolate(lo: Column, hi: Column, frac: Column, decimals: int) -> Column:
    exact = F.round(_fixed(lo) + (_fixed(hi) - _fixed(lo)) * frac, decimals).cast("double")
    # NaN / infinite / huge neighbours: plain double interpolation
    loose = F.when(lo == hi, lo).otherwise(lo + (hi - lo) * frac.cast("double"))
    return F.coalesce(exact, loose)


_SUM = "decimal(38,9)"


def exact_percentiles(
    df: DataFrame,
    by: Sequence[str],
    value: str | Column,
    ps: Mapping[str, float],
    method: str = "exact",
    decimals: int = 9,
    sums: Mapping[str, Column] | None = None,
    mean: tuple[str, int] | None = None,
    total: str | None = None,
) -> DataFrame:
    """One row per group of ``by`` with one column per entry of ``ps``.

    Ranks ``p * (n - 1)`` and the interpolation are computed in fixed-point decimal and rounded HALF_UP to
    ``decimals`` (at most 9), so results are exact and reproducible. Null values have no rank; a group whose
    values are all null has null percentiles.

    From the same read: ``sums`` names row-level integers to add up per group (as long), ``mean`` names the
    mean of the value and its decimals (as ``exact_mean``), ``total`` its sum (as ``exact_sum``).
    """
    by, sums = list(by), dict(sums or {})
    if not by:   # one global group: run it as a constant group
        g = df.withColumn("_all", F.lit(0))
        return exact_percentiles(g, ["_all"], value, ps, method, decimals, sums, mean, total).drop("_all")
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    base = df.select(*by, v.alias("_v"), *[c.cast("long").alias(f"_s{k}") for k, c in enumerate(sums.values())])
    if method == "approx":
        more = [exact_mean("_v", mean[1]).alias(mean[0])] if mean else []
        more += [exact_sum("_v").alias(total)] if total else []
        return base.groupBy(*by).agg(*[F.percentile_approx("_v", p, 10000).alias(name) for name, p in ps.items()],
                                     *[F.sum(f"_s{k}").alias(name) for k, name in enumerate(sums)], *more)

    # 1: counts and sums per (group, value), as one array: both readers below need the same aggregate then,
    # and Spark reuses its exchange (lone columns would be pruned from one of them)
    counts = base.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c"), *[F.sum(f"_s{k}").alias(f"_s{k}") for k in range(len(sums))])
    packed = F.transform(F.array(*[F.col(c).cast(_SUM) for c in counts.columns[len(by) + 1:]]), lambda x: x)
    counts = counts.select(*by, "_v", value_bucket(F.col("_v")).alias("_b"), packed.alias("_a"))
    rows, known = F.col("_a")[0].cast("long"), F.col("_v").isNotNull()

    # 2: ranges per group with what the caller wants of the whole group (small: groups x ranges)
    fixed = _fixed(F.col("_v"))
    ranges = counts.groupBy(*by, "_b").agg(
        F.coalesce(F.sum(F.when(known, rows)), F.lit(0)).alias("_bc"),
        F.sum((fixed * rows).cast(_SUM)).alias("_fixed"), F.sum(F.when(known, F.col("_v") * rows)).alias("_loose"),
        F.sum(F.when(known & fixed.isNull(), rows)).alias("_unfixable"),
        *[F.sum(F.col("_a")[k + 1]).alias(f"_s{k}") for k in range(len(sums))])
    grp = Window.partitionBy(*by)
    # null values come first and count nothing
    run = grp.orderBy(F.col("_b").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = ranges.withColumns({"_end": F.sum("_bc").over(run), "_n": F.sum("_bc").over(grp)}).withColumn("_start", F.col("_end") - F.col("_bc"))

    # 3: wanted ranks per group, each with the range that holds it
    wanted = []
    for i, (lo_r, hi_r, frac) in enumerate(_wanted_ranks(ps, F.col("_n"))):
        wanted += [F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), r.alias("r"), frac.alias("frac")) for side, r in ((0, lo_r), (1, hi_r))]
    inside = F.filter(F.array(*wanted), lambda t: (t["r"] >= F.col("_start")) & (t["r"] < F.col("_end")))
    targets = ranges.select(*by, "_b", "_start", inside.alias("_t")).where(F.size("_t") > 0)
    held = _join(counts, targets, [*by, "_b"])
    inner = Window.partitionBy(*by, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = held.withColumn("_ce", F.col("_start") + F.sum(rows).over(inner)).withColumn("_cs", F.col("_ce") - rows)
    here = F.filter("_t", lambda t: (t["r"] >= F.col("_cs")) & (t["r"] < F.col("_ce")))
    picked = held.select(*by, "_v", F.explode(here).alias("_t"))

    # 4: interpolate
    aggs = []
    for i, name in enumerate(ps):
        lo, hi = (F.max(F.when((F.col("_t.i") == i) & (F.col("_t.side") == side), F.col("_v"))) for side in (0, 1))
        aggs.append(_interpolate(lo, hi, F.max(F.when(F.col("_t.i") == i, F.col("_t.frac"))), decimals).alias(name))
    out = picked.groupBy(*by).agg(*aggs)

    loose, n = F.sum("_unfixable") > 0, F.sum("_bc")
    whole = [F.sum(f"_s{k}").cast("long").alias(name) for k, name in enumerate(sums)]
    if mean:
        exact = F.round(F.try_divide(F.sum("_fixed").cast("decimal(34,9)"), n.cast("decimal(20,0)")), mean[1]).cast("double")
        whole.append(F.when(loose, F.sum("_loose") / n).otherwise(exact).alias(mean[0]))
    if total:
        whole.append(F.when(loose, F.sum("_loose")).otherwise(F.sum("_fixed").cast("double")).alias(total))
    groups = ranges.groupBy(*by).agg(F.count(F.lit(1)).alias("_ranges"), *whole).drop("_ranges")
    return _join(groups, out, by, "left")
