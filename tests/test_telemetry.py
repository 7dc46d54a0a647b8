from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tabspark.operators import alerts as al
from tabspark.operators import telemetry as te

AS_OF = "2024-01-02 00:00:00"
T0 = datetime(2024, 1, 1, 22, 0, 0)

REQ = ("TimeGenerated timestamp_ntz, OperationId long, Name string, OperationName string, Success boolean, "
       "DurationMs double, ResultCode string, Url string, AppRoleName string, AppRoleInstance string, "
       "Revision string, event_id long")


def _req(spark, rows):
    full = [(T0 + timedelta(minutes=m), op, "predict", "POST /predict", ok, ms, "200" if ok else "500",
             "/predict", "svc", "r0", rev, i) for i, (m, op, ok, ms, rev) in enumerate(rows)]
    return spark.createDataFrame(full, REQ)


def test_request_health_bins_and_rounding(spark):
    df = _req(spark, [(1, 1, True, 10.0, "a"), (2, 1, False, 20.005, "a"), (70, 2, True, 5.0, "a"),
                      (-26 * 60, 3, True, 1.0, "a")])  # last one is older than 24 h
    out = {r["TimeGenerated"]: r for r in te.request_health(df, AS_OF).collect()}
    assert len(out) == 2
    first = out[datetime(2024, 1, 1, 22, 0)]
    assert (first["TotalRequests"], first["FailedRequests"]) == (2, 1)
    assert first["AvgDurationMs"] == 15.0  # 15.0025 -> 15.0
    assert first["P95DurationMs"] == 19.5  # 10 + 0.95 * 10.005 = 19.50475 -> 19.5


def test_correlated_operations_defaults(spark):
    req = _req(spark, [(1, 1, True, 10.0, "a"), (5, 1, False, 30.0, "a"), (3, 2, True, 5.0, "a")])
    deps = spark.createDataFrame([(T0 + timedelta(minutes=2), 1, False, 7.0)],
                                 "TimeGenerated timestamp_ntz, OperationId long, Success boolean, DurationMs double")
    traces = spark.createDataFrame([(T0, 2, 4, "x")], "TimeGenerated timestamp_ntz, OperationId long, SeverityLevel int, Message string")
    exc = spark.createDataFrame([], "TimeGenerated timestamp_ntz, OperationId long")
    out = {r["OperationId"]: r for r in te.correlated_operations(req, deps, traces, exc, AS_OF, tiebreak="event_id").collect()}
    assert out[1]["DurationMs"] == 30.0 and out[1]["Success"] is False  # latest request wins
    assert (out[1]["DependencyCount"], out[1]["FailedDependencies"], out[1]["P95DependencyMs"]) == (1, 1, 7.0)
    assert out[2]["DependencyCount"] == 0 and out[2]["P95DependencyMs"] is None
    assert (out[2]["TraceCount"], out[2]["ErrorTraceCount"], out[2]["ExceptionCount"]) == (1, 1, 0)
    failed = te.failed_drilldown(req, deps, traces, exc, AS_OF, tiebreak="event_id")
    assert "Success" not in failed.columns and failed.count() == 1


def test_trace_search_and_run_log(spark):
    rows = [(T0 + timedelta(minutes=i), 1, 1, ("BLOB TRIGGER hit" if i % 2 else "other") + str(i), i) for i in range(30)]
    tr = spark.createDataFrame(rows, "TimeGenerated timestamp_ntz, OperationId long, SeverityLevel int, Message string, event_id long")
    out = te.trace_search(tr, AS_OF, "1 day", k=10).collect()
    assert len(out) == 10 and all("TRIGGER" in r["Message"] for r in out)
    assert out[0]["TimeGenerated"] > out[-1]["TimeGenerated"]
    logs = spark.createDataFrame([(T0 + timedelta(seconds=i), f"Job-Exec-{i % 3}", f"l{i}") for i in range(10)],
                                 "TimeGenerated timestamp_ntz, ContainerGroupName_s string, Log_s string")
    got = te.run_log(logs, "job-exec-1", k=2).collect()
    assert [r["Log_s"] for r in got] == ["l1", "l4"]


def test_cohort_gate(spark):
    rows = [(i, 1, True, 100.0, "base") for i in range(20)] + [(i, 1, i >= 2, 150.0, "cand") for i in range(20)]
    r = te.cohort_gate(_req(spark, rows), "base", "cand").first()
    assert r["p95_limit_ms"] == 200.0 and r["error_rate_limit"] == 0.01
    assert r["reason"] == "error_rate_above_limit" and r["passed"] is False
    missing = te.cohort_gate(_req(spark, rows[:20]), "base", "cand").first()
    assert missing["reason"] == "missing_metrics"


def test_alert_rules(spark):
    df = _req(spark, [(1, 1, False, 250.0, "a"), (2, 1, True, 260.0, "a"), (40, 1, True, 10.0, "a")])
    exc = spark.createDataFrame([(T0,)], "TimeGenerated timestamp_ntz")
    met = spark.createDataFrame([(T0, "validation_failures", "2"), (T0, "prediction_count", "5")],
                                "TimeGenerated timestamp_ntz, Name string, Value string")
    fired = {(r["alert"], r["window_start"]) for r in al.evaluate_alerts(df, exc, met).collect()}
    assert fired == {("app_request_failures", T0), ("app_slow_requests", T0), ("app_exceptions", T0),
                     ("app_validation_failures", T0)}


def test_custom_metrics_filters_names(spark):
    met = spark.createDataFrame([(T0, "validation_failures", "2"), (T0, "validation_failures", "n/a"),
                                 (T0, "cpu", "5")], "TimeGenerated timestamp_ntz, Name string, Value string")
    out = te.custom_metrics(met, AS_OF).collect()
    assert len(out) == 1 and out[0]["AvgValue"] == 2.0 and out[0]["P95Value"] == 2.0


def test_top_per_group_skewed(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 4000, "hot").otherwise("cold").alias("g"), F.col("id"))
    out = te.top_per_group(df, "g", [F.col("id").desc()], 3).collect()
    got = sorted((r["g"], r["rank"], r["id"]) for r in out)
    assert got == [("cold", 1, 4999), ("cold", 2, 4998), ("cold", 3, 4997), ("hot", 1, 3999), ("hot", 2, 3998), ("hot", 3, 3997)]


def test_date_partitioned_store_prunes_and_agrees(spark, tmp_dir):
    from conftest import SF001

    from tabspark.sources import fixtures as fx
    from tabspark.sources.io import write_by_date
    req = fx.telemetry(spark, SF001, "requests")
    write_by_date(req, f"{tmp_dir}/requests", mode="overwrite")
    stored = spark.read.parquet(f"{tmp_dir}/requests")
    a = te.request_health(stored, "2024-01-31 00:00:00").drop("event_date")
    b = te.request_health(req, "2024-01-31 00:00:00")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    plan = te.recent(stored, "2024-01-31 00:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "event_date#" in plan


def test_cohort_gate_missing_baseline(spark):
    rows = [(i, 1, True, 150.0, "cand") for i in range(20)]
    r = te.cohort_gate(_req(spark, rows), "base", "cand").first()
    assert r["reason"] == "missing_metrics" and r["passed"] is False


def test_recent_on_date_partitions_with_midday_cutoff(spark, tmp_dir):
    from tabspark.sources.io import write_by_date
    rows = [(datetime(2024, 1, d, h, 0, 0), i) for i, (d, h) in enumerate([(1, 6), (1, 18), (2, 6), (2, 18), (3, 1)])]
    df = spark.createDataFrame(rows, "TimeGenerated timestamp_ntz, id long")
    write_by_date(df, f"{tmp_dir}/t", mode="overwrite")
    got = sorted(r["id"] for r in te.recent(spark.read.parquet(f"{tmp_dir}/t"), "2024-01-03 00:00:00", "30 hours").collect())
    assert got == [2, 3, 4]   # cutoff 2024-01-01 18:00 (exclusive) -> from Jan 2 06:00 on
