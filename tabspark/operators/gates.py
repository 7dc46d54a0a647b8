"""Promotion gates (E12-E14) as column expressions over a metrics table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspark.contract import TrainingConfig

QUALITY_FAILED = "quality_thresholds_not_met"
PERFORMANCE_FAILED = "performance_thresholds_not_met"
DISABLED = "registration_disabled"


def gate(metrics: DataFrame, perf: DataFrame, cfg: TrainingConfig, by: str = "split",
         registration_enabled: bool = True) -> DataFrame:
    """One decision row per ``by`` value.

    ``metrics`` carries roc_auc, f1, precision, recall per group; ``perf`` is a
    one-row table with p95_latency_ms and throughput_rows_per_sec. A missing
    (null) performance figure fails the performance gate; the gate can be
    disabled. Skip reason priority: quality, then performance, then disabled.
    """
    quality = ((F.col("roc_auc") >= cfg.min_auc) & (F.col("f1") >= cfg.min_f1)
               & (F.col("precision") >= cfg.min_precision) & (F.col("recall") >= cfg.min_recall))
    if cfg.enable_performance_gate:
        performance = F.coalesce(
            (F.col("p95_latency_ms") <= cfg.max_p95_latency_ms)
            & (F.col("throughput_rows_per_sec") >= cfg.min_throughput_rows_per_sec), F.lit(False))
    else:
        performance = F.lit(True)
    # perf is a single row: attach it with a join on a constant key
    joined = metrics.withColumn("_g", F.lit(0)).join(
        F.broadcast(perf.select("p95_latency_ms", "throughput_rows_per_sec").limit(1).withColumn("_g", F.lit(0))),
        on="_g", how="left")
    out = joined.select(by, quality.alias("quality_passed"), performance.alias("performance_passed"))
    enabled = F.lit(bool(registration_enabled))
    return out.select(
        by, "quality_passed", "performance_passed",
        (enabled & F.col("quality_passed") & F.col("performance_passed")).alias("register"),
        F.when(~F.col("quality_passed"), F.lit(QUALITY_FAILED))
        .when(~F.col("performance_passed"), F.lit(PERFORMANCE_FAILED))
        .when(~enabled, F.lit(DISABLED)).alias("skip_reason"),
    )
