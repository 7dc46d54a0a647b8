"""Binary-classifier evaluation.

Input is a long table ``(group..., label, score)``; every metric is computed
per group in the same plan.

* Confusion counts, precision, recall, F1, accuracy (E4-E6): one aggregation.
* ROC AUC with ties averaged and step-sum average precision (E1-E3) need
  cumulative counts in score order. A global window would run in one task.
  Rows first collapse to (group, score) counts (partial aggregation). Groups
  with a bounded number of distinct scores are folded in one sorted
  aggregate; larger groups use the two-level form: scores map to
  order-preserving buckets, bucket totals get prefix sums in a small table,
  and the running sums inside a bucket come from a window partitioned by
  (group, bucket).
* AUC is accumulated as an exact integer (2 x numerator) and divided once. AP is accumulated as positives x
  precision in whole units of 1e-15, so it is the same however tasks and paths add it up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabspark.functions.columns import count_where, join_null_safe, safe_ratio
from tabspark.functions.quantiles import exact_percentiles, value_bucket

METRIC_ORDER = ("roc_auc", "average_precision", "f1", "precision", "recall", "accuracy",
                "tn", "fp", "fn", "tp", "prediction_latency_ms_per_row", "row_count")


def binary_label(label: str) -> Column:
    """The label as long; a row with any other value than 0 and 1 (null too) ends the job. Checked where
    the label is read, so it costs no pass of its own."""
    y = F.col(label)
    bad = F.concat(F.lit(f"labels in {label} must be 0 or 1; found "), F.coalesce(y.cast("string"), F.lit("null")))
    return F.when(y.cast("double").isin(0.0, 1.0), y.cast("long")).otherwise(F.raise_error(bad).cast("long"))


def _pairs(n: Column, weight: Column) -> Column:
    """n * weight of two counts, exact beyond 64 bits."""
    return (n.cast("decimal(19,0)") * weight.cast("decimal(19,0)")).cast("decimal(38,0)")


_AP_UNITS = 10**15


def _ap_units(p: Column, tp: Column, fp: Column) -> Column:
    """p * precision in units of 1e-15, precision rounded down to a unit."""
    precision = F.call_function("div", (tp.cast("decimal(19,0)") * F.lit(_AP_UNITS).cast("decimal(16,0)")).cast("decimal(38,0)"), (tp + fp).cast("decimal(38,0)"))
    return _pairs(p, precision)


def confusion(df: DataFrame, label: str, score: str, by: Sequence[str] = (),
              threshold: float = 0.5) -> DataFrame:
    """E4-E6 per group: tn fp fn tp, precision, recall, f1, accuracy, row_count."""
    y = binary_label(label)
    pred = F.col(score) >= F.lit(float(threshold))
    out = df.groupBy(*by).agg(
        count_where((y == 0) & ~pred).alias("tn"),
        count_where((y == 0) & pred).alias("fp"),
        count_where((y == 1) & ~pred).alias("fn"),
        count_where((y == 1) & pred).alias("tp"),
        F.count(F.lit(1)).alias("row_count"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return out.select(
        *by, "tn", "fp", "fn", "tp", "row_count",
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, tp + fn).alias("recall"),
        safe_ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        safe_ratio(tp + tn, F.col("row_count")).alias("accuracy"),
    )


# Groups with at most this many distinct scores are evaluated by one sorted
# fold (bounded memory); larger groups take the two-level path.
SMALL_GROUP = 100_000


def rank_metrics(df: DataFrame, label: str, score: str, by: Sequence[str] = (),
                 small_group: int = SMALL_GROUP) -> DataFrame:
    """E1-E3 per group: roc_auc (ties averaged), average_precision (step sum).

    Rows collapse to (group, score) counts first. Groups with at most
    ``small_group`` distinct scores are folded in one aggregate (their score
    counts sorted descending, running TP/FP in a single pass); larger groups
    use the two-level prefix sums. Single-class groups get AUC 0.5 and
    AP = mean(label).
    """
    by = list(by)
    if not by:
        g = df.withColumn("_all", F.lit(0))
        return rank_metrics(g, label, score, ["_all"], small_group).drop("_all")
    y = binary_label(label)
    s = F.col(score).cast("double")
    per_score = df.groupBy(*by, s.alias("_s")).agg(
        F.sum(y).alias("_p"), (F.count(F.lit(1)) - F.sum(y)).alias("_n"))
    distinct = per_score.groupBy(*by).agg(F.count(F.lit(1)).alias("_ds"))
    tagged = join_null_safe(per_score, distinct, by)

    small = tagged.where(F.col("_ds") <= small_group).groupBy(*by).agg(
        F.sort_array(F.collect_list(F.struct("_s", "_p", "_n")), asc=False).alias("_arr"))
    init = F.struct(F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("fp"),
                    F.lit(0).cast("decimal(38,0)").alias("auc2"), F.lit(0).cast("decimal(38,0)").alias("ap"))

    def step(acc, x):
        tp = acc["tp"] + x["_p"]
        fp = acc["fp"] + x["_n"]
        return F.struct(tp.alias("tp"), fp.alias("fp"),
                        (acc["auc2"] + _pairs(x["_n"], 2 * acc["tp"] + x["_p"])).cast("decimal(38,0)").alias("auc2"),
                        (acc["ap"] + _ap_units(x["_p"], tp, fp)).cast("decimal(38,0)").alias("ap"))

    folded = small.select(*by, F.aggregate("_arr", init, step).alias("_f")).select(
        *by, F.col("_f.auc2").alias("_auc2"), F.col("_f.ap").alias("_ap"),
        F.col("_f.tp").alias("_totp"), F.col("_f.fp").alias("_totn"))

    large = _large_rank_sums(tagged.where(F.col("_ds") > small_group).drop("_ds"), by)
    agg = folded.unionByName(large)
    both = (F.col("_totp") > 0) & (F.col("_totn") > 0)
    return agg.select(
        *by,
        F.when(both, F.col("_auc2").cast("double") / (F.lit(2.0) * F.col("_totp") * F.col("_totn"))).otherwise(F.lit(0.5))
        .alias("roc_auc"),
        F.when(both, F.call_function("div", F.col("_ap"), F.col("_totp").cast("decimal(38,0)")).cast("double") / F.lit(float(_AP_UNITS)))
        .otherwise(F.col("_totp") / (F.col("_totp") + F.col("_totn")))
        .alias("average_precision"),
    )


def _large_rank_sums(per_score: DataFrame, by: list[str]) -> DataFrame:
    """Two-level cumulative sums for groups with many distinct scores:
    (group, auc2, ap, totp, totn)."""
    per_score = per_score.withColumn("_b", value_bucket(F.col("_s")))
    grp = Window.partitionBy(*by)
    down = grp.orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    buckets = (per_score.groupBy(*by, "_b").agg(F.sum("_p").alias("_bp"), F.sum("_n").alias("_bn"))
               .withColumn("_pa", F.sum("_bp").over(down) - F.col("_bp"))
               .withColumn("_na", F.sum("_bn").over(down) - F.col("_bn"))
               .withColumn("_totp", F.sum("_bp").over(grp))
               .withColumn("_totn", F.sum("_bn").over(grp))
               .drop("_bp", "_bn"))
    inner = Window.partitionBy(*by, "_b").orderBy(F.col("_s").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    j = join_null_safe(per_score, buckets, [*by, "_b"])
    j = (j.withColumn("_tp", F.col("_pa") + F.sum("_p").over(inner))
          .withColumn("_fp", F.col("_na") + F.sum("_n").over(inner)))
    auc2 = _pairs(F.col("_n"), 2 * (F.col("_tp") - F.col("_p")) + F.col("_p"))
    ap = _ap_units(F.col("_p"), F.col("_tp"), F.col("_fp"))
    return j.groupBy(*by).agg(
        F.sum(auc2).cast("decimal(38,0)").alias("_auc2"), F.sum(ap).cast("decimal(38,0)").alias("_ap"),
        F.first("_totp").alias("_totp"), F.first("_totn").alias("_totn"))


def binary_metrics(df: DataFrame, label: str, score: str, by: Sequence[str] = ("split",),
                   threshold: float = 0.5) -> DataFrame:
    """Every split metric per group (latency is added by the caller)."""
    by = list(by)
    if not by:  # one global group: join the two one-row results on a constant
        g = df.withColumn("_all", F.lit(0))
        return binary_metrics(g, label, score, ["_all"], threshold).drop("_all")
    return join_null_safe(confusion(df, label, score, by, threshold), rank_metrics(df, label, score, by), by)


def metrics_long(metrics: DataFrame, by: str = "split",
                 names: Sequence[str] = METRIC_ORDER) -> DataFrame:
    """``<split>_<metric>`` -> value, numeric metrics only, as double."""
    present = [n for n in names if n in metrics.columns]
    pairs = F.array(*[F.struct(F.lit(n).alias("m"), F.col(n).cast("double").alias("v")) for n in present])
    return metrics.select(by, F.explode(pairs).alias("x")).select(
        F.concat_ws("_", F.col(by), F.col("x.m")).alias("metric"), F.col("x.v").alias("value"))


def latency_stats(df: DataFrame, ms: str, rows: str | Column | None = None,
                  by: Sequence[str] = (), method: str = "exact") -> DataFrame:
    """p50/p95/p99 latency (linear interpolation) and rows per second."""
    by = list(by)
    if not by:
        g = df.withColumn("_all", F.lit(0))
        return latency_stats(g, ms, rows, ["_all"], method).drop("_all")
    r = F.lit(1) if rows is None else (F.col(rows) if isinstance(rows, str) else rows)
    out = exact_percentiles(df, by, ms, {"p50_latency_ms": 0.5, "p95_latency_ms": 0.95, "p99_latency_ms": 0.99}, method=method,
                            sums={"_rows": r, "runs": F.lit(1)}, total="_ms")
    per_second = F.when(F.col("_ms") > 0, F.col("_rows") / (F.col("_ms") / 1000.0))
    return out.select(*by, "runs", per_second.alias("throughput_rows_per_sec"), "p50_latency_ms", "p95_latency_ms", "p99_latency_ms")
