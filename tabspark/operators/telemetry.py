"""Request telemetry analytics.

The workbook panels re-expressed as DataFrame functions. ``ago(24h)`` becomes
``as_of - lookback`` with ``as_of`` passed in (never ``now()``), ``bin(t, 1h)``
becomes a tumbling ``window(t, bin).start`` (only non-empty bins appear), and
percentiles are exact (see ``tabspark.functions.quantiles``) unless
``method="approx"``.

All rollups aggregate before joining: the correlated-operations view joins four
tables that are each already grouped by ``OperationId``, so every join input is
hash-partitioned on the join key and AQE can pick broadcast or sort-merge from
runtime sizes.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabspark.functions.columns import count_where, lenient, ts_lit
from tabspark.functions.quantiles import exact_percentiles
from tabspark.operators.ranking import top_per_group  # noqa: F401  (re-exported)
from tabspark.sources.io import DATE_PARTITION

TS = "TimeGenerated"
OP = "OperationId"

# The custom metric names shown on the metrics panel, and the
# two message substrings the run monitor searches traces for.
PANEL_METRICS = ("prediction_latency_ms", "prediction_count", "validation_failures")
TRACE_NEEDLES = ("Blob trigger", "ACA job")


def recent(df: DataFrame, as_of: str | datetime, lookback: str = "24 hours", ts: str = TS) -> DataFrame:
    """Rows newer than ``as_of - lookback`` (the ``ago()`` filter).

    On a table written partitioned by ``event_date`` the same cutoff is also
    applied to the date column, so Spark prunes whole date folders before
    reading (the timestamp predicate alone only filters row groups)."""
    cutoff = ts_lit(as_of) - F.expr(f"INTERVAL {lookback}")
    out = df.where(F.col(ts) > cutoff)
    if DATE_PARTITION in df.columns:
        out = out.where(F.col(DATE_PARTITION) >= F.to_date(cutoff))
    return out


def time_bin(ts: str = TS, bin: str = "1 hour") -> Column:
    """Tumbling bin start, keeping the input timestamp type."""
    return F.window(F.col(ts), bin).start


def _binned(df: DataFrame, bin: str) -> DataFrame:
    return df.withColumn("_bin", time_bin(TS, bin))


def _failed() -> Column:
    return F.when(F.col("Success") == F.lit(False), F.lit(1)).otherwise(F.lit(0))


def request_health(requests: DataFrame, as_of, lookback: str = "24 hours", bin: str = "1 hour",
                   method: str = "exact") -> DataFrame:
    """Total, failed, average ms (2 dp) and p95 ms (2 dp) per time bin."""
    b = _binned(recent(requests, as_of, lookback), bin)
    out = exact_percentiles(b, ["_bin"], "DurationMs", {"P95DurationMs": 0.95}, method, decimals=2, mean=("AvgDurationMs", 2),
                            sums={"TotalRequests": F.lit(1), "FailedRequests": _failed()})
    return out.select(F.col("_bin").alias(TS), "TotalRequests", "FailedRequests", "AvgDurationMs", "P95DurationMs")


def failed_requests(requests: DataFrame, as_of, lookback: str = "24 hours", bin: str = "1 hour") -> DataFrame:
    """Failed requests per bin."""
    b = _binned(recent(requests, as_of, lookback).where(F.col("Success") == F.lit(False)), bin)
    return b.groupBy(F.col("_bin").alias(TS)).agg(F.count(F.lit(1)).alias("FailedRequests"))


def slow_requests(requests: DataFrame, as_of, lookback: str = "24 hours", bin: str = "1 hour",
                  method: str = "exact") -> DataFrame:
    """p95 duration of successful requests per bin."""
    b = _binned(recent(requests, as_of, lookback).where(F.col("Success") == F.lit(True)), bin)
    return exact_percentiles(b, ["_bin"], "DurationMs", {"P95DurationMs": 0.95}, method) \
        .withColumnRenamed("_bin", TS)


def latest_per_operation(requests: DataFrame, tiebreak: str | None = None) -> DataFrame:
    """T4: ``arg_max(TimeGenerated, *) by OperationId``.

    ``max_by`` is a plain aggregate with partial aggregation, so a hot
    operation costs one row per map task. Ties on the time are broken by
    ``tiebreak`` (largest wins) so the result is deterministic.
    """
    cols = [c for c in requests.columns if c != OP]
    order = F.struct(F.col(TS), F.col(tiebreak)) if tiebreak else F.col(TS)
    latest = requests.groupBy(OP).agg(F.max_by(F.struct(*[F.col(c) for c in cols]), order).alias("_r"))
    return latest.select(OP, *[F.col(f"_r.{c}").alias(c) for c in cols])


def dependency_rollup(deps: DataFrame, method: str = "exact") -> DataFrame:
    """T5: dependency count, failed count and p95 ms per operation."""
    out = exact_percentiles(deps, [OP], "DurationMs", {"P95DependencyMs": 0.95}, method,
                            sums={"DependencyCount": F.lit(1), "FailedDependencies": _failed()})
    return out.select(OP, "DependencyCount", "FailedDependencies", "P95DependencyMs")


def trace_rollup(traces: DataFrame) -> DataFrame:
    """Trace count and error-level (severity >= 3) count per operation."""
    return traces.groupBy(OP).agg(F.count(F.lit(1)).alias("TraceCount"),
                                  count_where(F.col("SeverityLevel") >= 3).alias("ErrorTraceCount"))


def exception_rollup(exceptions: DataFrame) -> DataFrame:
    """Exception count per operation."""
    return exceptions.groupBy(OP).agg(F.count(F.lit(1)).alias("ExceptionCount"))


_REQ_PROJECT = ("RequestTime", OP, "RequestName", "Success", "DurationMs", "ResultCode", "Url",
                "AppRoleName", "AppRoleInstance", "OperationName")


def _correlate(req: DataFrame, deps: DataFrame, traces: DataFrame, exceptions: DataFrame,
               with_success: bool, method: str) -> DataFrame:
    joined = (req.join(dependency_rollup(deps, method), OP, "left")
              .join(trace_rollup(traces), OP, "left")
              .join(exception_rollup(exceptions), OP, "left"))
    base = [c for c in _REQ_PROJECT if with_success or c != "Success"]
    return joined.select(
        *base,
        F.coalesce("DependencyCount", F.lit(0)).alias("DependencyCount"),
        F.coalesce("FailedDependencies", F.lit(0)).alias("FailedDependencies"),
        "P95DependencyMs",
        F.coalesce("TraceCount", F.lit(0)).alias("TraceCount"),
        F.coalesce("ErrorTraceCount", F.lit(0)).alias("ErrorTraceCount"),
        F.coalesce("ExceptionCount", F.lit(0)).alias("ExceptionCount"),
    )


def _latest_requests(requests: DataFrame, tiebreak: str | None) -> DataFrame:
    return latest_per_operation(requests, tiebreak).select(
        F.col(TS).alias("RequestTime"), OP, F.col("Name").alias("RequestName"), "Success", "DurationMs",
        "ResultCode", "Url", "AppRoleName", "AppRoleInstance", "OperationName")


def correlated_operations(requests: DataFrame, deps: DataFrame, traces: DataFrame, exceptions: DataFrame,
                          as_of, lookback: str = "24 hours", tiebreak: str | None = None,
                          method: str = "exact") -> DataFrame:
    """Latest request per operation with its dependency, trace and
    exception rollups; counts default to 0, p95 stays null; newest first."""
    r = [recent(x, as_of, lookback) for x in (requests, deps, traces, exceptions)]
    out = _correlate(_latest_requests(r[0], tiebreak), r[1], r[2], r[3], True, method)
    return out.orderBy(F.col("RequestTime").desc())


def failed_drilldown(requests: DataFrame, deps: DataFrame, traces: DataFrame, exceptions: DataFrame,
                     as_of, lookback: str = "24 hours", tiebreak: str | None = None,
                     method: str = "exact") -> DataFrame:
    """As T8 but over failed requests only (filter before arg_max), without Success."""
    r = [recent(x, as_of, lookback) for x in (requests, deps, traces, exceptions)]
    failed = r[0].where(F.col("Success") == F.lit(False))
    out = _correlate(_latest_requests(failed, tiebreak), r[1], r[2], r[3], False, method)
    return out.orderBy(F.col("RequestTime").desc())


def event_counts(df: DataFrame, as_of, name: str, lookback: str = "24 hours", bin: str = "1 hour",
                 where: Column | None = None) -> DataFrame:
    """Rows per bin (exceptions; traces with severity >= 3)."""
    d = recent(df, as_of, lookback)
    if where is not None:
        d = d.where(where)
    return _binned(d, bin).groupBy(F.col("_bin").alias(TS)).agg(F.count(F.lit(1)).alias(name))


def custom_metrics(metrics: DataFrame, as_of, lookback: str = "24 hours", bin: str = "1 hour",
                   names: Sequence[str] = PANEL_METRICS, method: str = "exact") -> DataFrame:
    """Average and p95 of the numeric value by metric name and bin."""
    d = recent(metrics, as_of, lookback).where(F.col("Name").isin(*names))
    d = _binned(d, bin).withColumn("_val", lenient("Value", "double"))
    out = exact_percentiles(d, ["Name", "_bin"], "_val", {"P95Value": 0.95}, method, mean=("AvgValue", 9))
    return out.select("Name", F.col("_bin").alias(TS), "AvgValue", "P95Value")


def trace_search(traces: DataFrame, as_of, lookback: str = "10 minutes",
                 needles: Sequence[str] = TRACE_NEEDLES, k: int = 10,
                 tiebreak: str | None = None) -> DataFrame:
    """Newest ``k`` traces whose message contains any needle (case-insensitive).

    ``orderBy().limit()`` plans as a distributed top-k (per-task heaps merged),
    never a full sort.
    """
    d = recent(traces, as_of, lookback)
    cond = None
    for n in needles:
        c = F.lower(F.col("Message")).contains(n.lower())
        cond = c if cond is None else (cond | c)
    order = [F.col(TS).desc()] + ([F.col(tiebreak).desc()] if tiebreak else [])
    return d.where(cond).orderBy(*order).limit(k).select(TS, "Message")


def run_log(logs: DataFrame, prefix: str, k: int = 200, tiebreak: str | None = None) -> DataFrame:
    """Oldest ``k`` log lines of the container groups starting with ``prefix``
    (case-insensitive)."""
    d = logs.where(F.lower(F.col("ContainerGroupName_s")).startswith(prefix.lower()))
    order = [F.col(TS).asc()] + ([F.col(tiebreak).asc()] if tiebreak else [])
    return d.orderBy(*order).limit(k).select(TS, "Log_s")


def cohort_gate(requests: DataFrame, baseline: str, candidate: str, cohort: str = "Revision",
                p95_factor: float = 1.5, p95_floor_ms: float = 200.0,
                error_factor: float = 2.0, error_floor: float = 0.01, method: str = "exact") -> DataFrame:
    """Candidate vs baseline cohort. Limits are ``max(1.5 x baseline p95,
    200 ms)`` and ``max(2 x baseline error rate, 0.01)``; the candidate fails
    when above either (strict ``>``) or when a metric is missing."""
    d = requests.where(F.col(cohort).isin(baseline, candidate))
    per = exact_percentiles(d, [cohort], "DurationMs", {"_p95": 0.95}, method, sums={"_n": F.lit(1), "_f": _failed()})
    per = per.withColumn("_err", F.col("_f") / F.col("_n"))

    def pick(c, who):
        return F.max(F.when(F.col(cohort) == who, F.col(c)))

    row = per.agg(pick("_p95", baseline).alias("baseline_p95_ms"), pick("_err", baseline).alias("baseline_error_rate"),
                  pick("_p95", candidate).alias("candidate_p95_ms"), pick("_err", candidate).alias("candidate_error_rate"))
    p95_limit = F.greatest(F.col("baseline_p95_ms") * F.lit(p95_factor), F.lit(p95_floor_ms))
    err_limit = F.greatest(F.col("baseline_error_rate") * F.lit(error_factor), F.lit(error_floor))
    row = row.withColumn("p95_limit_ms", p95_limit).withColumn("error_rate_limit", err_limit)
    # greatest() skips nulls, so a missing baseline is checked explicitly
    missing = (F.col("candidate_p95_ms").isNull() | F.col("candidate_error_rate").isNull()
               | F.col("baseline_p95_ms").isNull() | F.col("baseline_error_rate").isNull())
    reason = (F.when(missing, F.lit("missing_metrics"))
              .when(F.col("candidate_error_rate") > F.col("error_rate_limit"), F.lit("error_rate_above_limit"))
              .when(F.col("candidate_p95_ms") > F.col("p95_limit_ms"), F.lit("p95_above_limit")))
    return row.withColumn("reason", reason).withColumn("passed", F.col("reason").isNull())
