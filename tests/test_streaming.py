from conftest import SF0001
from pyspark.sql import functions as F

from tabspark.operators import alerts as al
from tabspark.operators import ledger as le
from tabspark.sources import fixtures as fx
from tabspark.streaming import alerts as sa
from tabspark.streaming.ingest import start_ingest


def test_ingest_two_files_then_rerun_is_idempotent(spark, tmp_dir):
    raw = fx.acs_raw(spark, SF0001)
    raw.where(F.col("k") % 2 == 0).write.parquet(f"{tmp_dir}/landing/a")
    raw.where(F.col("k") % 2 == 1).write.parquet(f"{tmp_dir}/landing/b")
    folder = f"{tmp_dir}/raw/monthly"
    for part in ("a", "b"):
        spark.read.parquet(f"{tmp_dir}/landing/{part}").coalesce(1).write.mode("append").parquet(folder)
    log = []
    start_ingest(spark, folder, raw.schema, f"{tmp_dir}/clean", f"{tmp_dir}/ledger", f"{tmp_dir}/ck",
                 log=log).awaitTermination()
    runs = le.read_runs(spark, f"{tmp_dir}/ledger")
    assert runs.where(F.col("status") == "COMPLETED").count() == 2
    assert len(log) == 2
    # a second stream with a fresh checkpoint re-offers both files: both skipped
    log2 = []
    start_ingest(spark, folder, raw.schema, f"{tmp_dir}/clean", f"{tmp_dir}/ledger", f"{tmp_dir}/ck2",
                 log=log2).awaitTermination()
    assert [r["status"] for r in log2] == ["SKIPPED", "SKIPPED"]
    assert le.read_runs(spark, f"{tmp_dir}/ledger").count() == 2
    clean = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_dir}/clean/clean/monthly")
    assert clean.count() > 0.9 * raw.count() * 0.9


def test_alert_stream_equals_batch(spark, tmp_dir):
    events = fx.table(spark, SF0001, "events")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(SF0001)
    v = {n: stream.where(fx._VIEWS[n][1]).selectExpr(*fx._VIEWS[n][0]) if fx._VIEWS[n][1]
         else stream.selectExpr(*fx._VIEWS[n][0]) for n in ("requests", "exceptions", "metrics")}
    qs = sa.start_alerts(sa.rule_streams(v["requests"], v["exceptions"], v["metrics"]), f"{tmp_dir}/sink",
                         f"{tmp_dir}/ck", output_mode="complete", name_prefix="t_")
    for q in qs:
        q.awaitTermination()
    got = set()
    for rule in al.RULES:
        got |= {(r["alert"], r["window_start"]) for r in spark.table(f"t_{rule}").collect()}
    batch = al.evaluate_alerts(fx.telemetry(spark, SF0001, "requests"), fx.telemetry(spark, SF0001, "exceptions"),
                               fx.telemetry(spark, SF0001, "metrics"))
    want = {(r["alert"], r["window_start"]) for r in batch.collect()}
    assert got == want


def test_alert_stream_append_with_watermark(spark, tmp_dir):
    events = fx.table(spark, SF0001, "events")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(SF0001)
    exc = stream.where("event_type = 'error'").selectExpr(*fx._VIEWS["exceptions"][0])
    req = stream.where(fx._VIEWS["requests"][1]).selectExpr(*fx._VIEWS["requests"][0])
    met = stream.selectExpr(*fx._VIEWS["metrics"][0])
    streams = {al.RULES[2]: sa.rule_streams(req, exc, met)[al.RULES[2]]}
    for q in sa.start_alerts(streams, f"{tmp_dir}/sink", f"{tmp_dir}/ck"):
        q.awaitTermination()
    out = spark.read.parquet(f"{tmp_dir}/sink/{al.RULES[2]}")
    n_batch = al.exceptions(fx.telemetry(spark, SF0001, "exceptions")).count()
    # append mode emits only windows closed by the watermark: all but the last few
    assert 0 < out.count() <= n_batch


def test_late_row_behind_watermark_is_dropped(spark, tmp_dir):
    from datetime import datetime, timedelta
    t0 = datetime(2024, 1, 1, 0, 0, 0)
    schema = "TimeGenerated timestamp_ntz, OperationId long"
    src = f"{tmp_dir}/in"

    def land(minutes):
        spark.createDataFrame([(t0 + timedelta(minutes=m), 1) for m in minutes], schema) \
            .coalesce(1).write.mode("append").parquet(src)

    def run():
        exc = spark.readStream.schema(schema).parquet(src)
        stream = {al.RULES[2]: al.exceptions(sa.with_event_time(exc, "15 minutes"))}
        for q in sa.start_alerts(stream, f"{tmp_dir}/sink", f"{tmp_dir}/ck"):
            q.awaitTermination()

    land([1, 2, 20, 50])
    run()
    land([3, 100])           # minute 3 is behind the watermark (50 - 15 = 35)
    run()
    land([200])              # moves the watermark past the minute-100 window
    run()
    out = {r["window_start"]: r["value"] for r in spark.read.parquet(f"{tmp_dir}/sink/{al.RULES[2]}").collect()}
    first = [v for k, v in out.items() if k.minute == 0 and k.hour == 0]
    assert first == [2.0]    # the late row did not reopen the closed window
    assert any(k.hour == 1 and k.minute == 30 for k in out)  # window of minute 100 was emitted


def test_alert_stream_with_bounded_p95(spark, tmp_dir):
    events = fx.table(spark, SF0001, "events")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(SF0001)
    req = stream.where(fx._VIEWS["requests"][1]).selectExpr(*fx._VIEWS["requests"][0])
    exc = stream.where("event_type = 'error'").selectExpr(*fx._VIEWS["exceptions"][0])
    met = stream.selectExpr(*fx._VIEWS["metrics"][0])
    streams = {al.RULES[1]: sa.rule_streams(req, exc, met, exact_p95=False)[al.RULES[1]]}
    for q in sa.start_alerts(streams, f"{tmp_dir}/sink", f"{tmp_dir}/ck", output_mode="complete", name_prefix="approx_"):
        q.awaitTermination()
    assert spark.table(f"approx_{al.RULES[1]}").count() > 0


def test_stream_p95_of_a_window_with_nan_fires_as_in_batch(spark, tmp_dir):
    from datetime import datetime
    rows = [(datetime(2024, 1, 1, 0, 1), 5.0, True), (datetime(2024, 1, 1, 0, 2), float("nan"), True)]
    df = spark.createDataFrame(rows, "TimeGenerated timestamp_ntz, DurationMs double, Success boolean")
    batch, stream = al.slow_requests(df).first(), al.slow_requests(df, streaming=True).first()
    assert batch["fired"] and stream["fired"]


def test_ingest_records_a_file_without_clean_rows_as_failed(spark, tmp_dir):
    raw = fx.acs_raw(spark, SF0001)
    raw = raw.withColumn("AGEP", F.lit(500).cast(raw.schema["AGEP"].dataType))   # a range breach removes rows, it is not fatal
    raw.coalesce(1).write.parquet(f"{tmp_dir}/raw")
    log = []
    start_ingest(spark, f"{tmp_dir}/raw", raw.schema, f"{tmp_dir}/clean", f"{tmp_dir}/ledger", f"{tmp_dir}/ck",
                 log=log).awaitTermination()
    assert [(r["status"], r["message"]) for r in log] == [("FAILED", "Refusing to write an empty clean frame")]
    assert le.read_runs(spark, f"{tmp_dir}/ledger").where("status = 'COMPLETED'").count() == 0


def test_one_and_many_files_a_batch_give_the_same_tables_and_ledger(spark, tmp_dir):
    raw = fx.acs_raw(spark, SF0001).where("AGEP IS NOT NULL AND COW IS NOT NULL AND k % 211 <> 0")
    bad = raw.limit(40).withColumn("STATE", F.lit("??"))
    gone = raw.limit(30).withColumn("AGEP", F.lit(500.0))
    folder, made = f"{tmp_dir}/raw", {}
    raw.withColumn("p", F.col("k") % 5).repartitionByRange(5, "p").write.partitionBy("p").parquet(f"{folder}/good")
    bad.coalesce(1).write.parquet(f"{folder}/bad")
    gone.coalesce(1).write.parquet(f"{folder}/gone")
    for n in (1, 50):
        root, log = f"{tmp_dir}/{n}", []
        q = start_ingest(spark, folder, raw.schema, f"{root}/clean", f"{root}/ledger", f"{root}/ck", log=log, files_per_trigger=n)
        q.awaitTermination()
        assert len([p for p in q.recentProgress if p["numInputRows"]]) == (7 if n == 1 else 1)
        runs = le.read_runs(spark, f"{root}/ledger").select("raw_blob_name", "status", "payload").collect()
        tables = {r["raw_blob_name"]: sorted(map(str, spark.read.parquet(f"{root}/clean/" + r["raw_blob_name"].replace("raw/", "clean/", 1)).collect()))
                  for r in runs if r["status"] == "COMPLETED"}
        made[n] = (sorted(map(tuple, runs)), tables)
        assert sorted(r["status"] for r in log) == ["COMPLETED"] * 5 + ["FAILED"] * 2
        again = []   # all offered once more: the good ones are skipped, the others fail again
        start_ingest(spark, folder, raw.schema, f"{root}/clean", f"{root}/ledger", f"{root}/ck2", log=again, files_per_trigger=n).awaitTermination()
        assert sorted(r["status"] for r in again) == ["FAILED"] * 2 + ["SKIPPED"] * 5
    assert made[1] == made[50] and len(made[1][1]) == 5


def test_histogram_p95_and_late_rows_in_append_mode(spark, tmp_dir):
    import math
    from datetime import datetime, timedelta
    t0 = datetime(2024, 1, 1)
    schema = "TimeGenerated timestamp_ntz, DurationMs double, Success boolean"
    slices = [[(m, 10.0 + m) for m in range(60)], [(61, 300.0), (62, 250.0), (61, 0.0), (200, 1.0)], [(5, 9e9), (400, 1.0)]]
    for rows in slices:
        spark.createDataFrame([(t0 + timedelta(minutes=m), v, True) for m, v in rows], schema).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
    req = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/in")
    stream = al.slow_requests(sa.with_event_time(req, "15 minutes"), streaming=True, histogram=True)
    q = stream.writeStream.outputMode("append").option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).format("parquet").option("path", f"{tmp_dir}/out").start()
    q.awaitTermination()
    got = {int((r["window_start"] - t0).total_seconds() // 60): r for r in spark.read.parquet(f"{tmp_dir}/out").withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).collect()}
    assert sorted(got) == [0, 15, 30, 45, 60, 195]   # the window of minute 390 is still open

    def upper(v):
        return round(2 ** ((math.floor(math.log2(v) * 4096) + 1) / 4096), 6)

    assert got[0]["value"] == upper(10.0 + 14) and got[45]["value"] == upper(10.0 + 59)   # the late 9e9 is not in them
    assert got[60]["value"] == upper(300.0) and got[60]["fired"] and not got[0]["fired"]
