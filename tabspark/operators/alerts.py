"""Documented alert rules (T13-T16) as one windowed aggregation per rule.

The same functions run on a batch DataFrame or on a stream (see
``tabspark.streaming.alerts``); only the percentile differs, because a
streaming aggregation needs a single aggregate function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabspark.functions.columns import count_where, lenient
from tabspark.functions.quantiles import (
    VALUE_DEC,
    bucket_end,
    exact_percentiles,
    exact_sum,
    percentile_expr,
    value_bucket,
)

TS = "TimeGenerated"

# Rule names, window and thresholds as documented.
WINDOW = "15 minutes"
SLOW_P95_MS = 200.0
RULES = ("app_request_failures", "app_slow_requests", "app_exceptions", "app_validation_failures")


def _win(ts: str = TS, window: str = WINDOW) -> Column:
    # group on the window struct itself so a stream's watermark applies to it
    return F.window(F.col(ts), window).alias("_w")


def _shape(df: DataFrame, rule: str, value: str, fired: Column) -> DataFrame:
    start = F.col("_w.start") if "_w" in df.columns else F.col("window_start")
    return df.select(F.lit(rule).alias("alert"), start.alias("window_start"),
                     F.col(value).cast("double").alias("value"), fired.alias("fired"))


def request_failures(requests: DataFrame, window: str = WINDOW) -> DataFrame:
    """Failed requests per window; fires when > 0."""
    agg = requests.groupBy(_win(TS, window)).agg(count_where(F.col("Success") == F.lit(False)).alias("v"))
    return _shape(agg, RULES[0], "v", F.col("v") > 0)


def histogram_p95(requests: DataFrame, window: str = WINDOW) -> DataFrame:
    """T14 from a histogram: (window ``_w``, v). The first aggregate counts rows per window and value range
    (``value_bucket``, 0.017 % wide), so the state of a window is bounded by the ranges its values span,
    however many rows it has, and counts of different tasks and batches add up. The second one reads the
    range that holds the 95th percentile's rank, ceil(0.95 n), and gives its upper end, rounded to 6 places."""
    bucket = value_bucket(F.col("DurationMs").cast("double"))
    counts = requests.where(F.col("DurationMs").isNotNull()).groupBy(_win(TS, window), bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_c"))
    ranges = counts.groupBy(F.window("_w", window).alias("_w")).agg(F.sort_array(F.collect_list(F.struct("_b", "_c"))).alias("_h"), F.sum("_c").alias("_n"))
    rank = F.ceil(F.col("_n") * F.lit(0.95).cast("decimal(3,2)")).cast("long")
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("b"))
    found = F.aggregate("_h", start, lambda a, x: F.struct(
        (a["seen"] + x["_c"]).alias("seen"), F.coalesce(a["b"], F.when(a["seen"] + x["_c"] >= rank, x["_b"])).alias("b")))
    return ranges.select("_w", F.round(bucket_end(found["b"]), 6).alias("v"))


def slow_requests(requests: DataFrame, window: str = WINDOW, streaming: bool = False,
                  exact: bool = True, histogram: bool = False) -> DataFrame:
    """p95 latency per window; fires when above 200 ms.

    On a stream the p95 is one aggregate per window (streams allow no joins
    after aggregation). ``exact=True`` keeps the window's values in state and
    rounds to the batch path's fixed point (equal results); ``exact=False``
    keeps a bounded ``percentile_approx`` sketch instead, for very hot windows.
    ``histogram=True`` (append mode only: it aggregates twice) keeps a bounded
    histogram, whose result does not depend on the order of rows.
    """
    if histogram:
        agg = histogram_p95(requests, window)
    elif streaming:
        p = percentile_expr("DurationMs", 0.95)
        # NaN and values beyond the fixed point stay as they are, as in the batch path
        p95 = (F.coalesce(p.try_cast(VALUE_DEC).cast("double"), p) if exact
               else percentile_expr("DurationMs", 0.95, method="approx"))
        agg = requests.groupBy(_win(TS, window)).agg(p95.alias("v"))
    else:
        w = requests.withColumn("window_start", F.window(F.col(TS), window).start)
        agg = exact_percentiles(w, ["window_start"], "DurationMs", {"v": 0.95})
    return _shape(agg, RULES[1], "v", F.col("v") > SLOW_P95_MS)


def exceptions(exc: DataFrame, window: str = WINDOW) -> DataFrame:
    """Exceptions per window; fires when > 0."""
    agg = exc.groupBy(_win(TS, window)).agg(F.count(F.lit(1)).alias("v"))
    return _shape(agg, RULES[2], "v", F.col("v") > 0)


def validation_failures(metrics: DataFrame, window: str = WINDOW) -> DataFrame:
    """Sum of the ``validation_failures`` metric per window; fires when > 0."""
    m = metrics.where(F.col("Name") == "validation_failures")
    agg = m.groupBy(_win(TS, window)).agg(exact_sum(lenient("Value", "double")).alias("v"))
    return _shape(agg, RULES[3], "v", F.col("v") > 0)


def evaluate_alerts(requests: DataFrame, exc: DataFrame, metrics: DataFrame,
                    window: str = WINDOW, fired_only: bool = True) -> DataFrame:
    """All four rules, one row per (alert, window)."""
    out = (request_failures(requests, window)
           .unionByName(slow_requests(requests, window))
           .unionByName(exceptions(exc, window))
           .unionByName(validation_failures(metrics, window)))
    return out.where(F.col("fired")) if fired_only else out
