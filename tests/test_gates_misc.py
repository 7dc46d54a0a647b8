from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tabspark.contract import TrainingConfig
from tabspark.functions.columns import ts_lit
from tabspark.operators import gates as ga
from tabspark.operators import ledger as le
from tabspark.operators import score as sc
from tabspark.sources import io as sio

MET = "split string, roc_auc double, f1 double, precision double, recall double"
PERF = "p95_latency_ms double, throughput_rows_per_sec double"


def test_gate_priority_and_switches(spark):
    good = [("test", 0.95, 0.9, 0.9, 0.9)]
    fast = [(1.0, 5000.0)]
    r = ga.gate(spark.createDataFrame(good, MET), spark.createDataFrame(fast, PERF), TrainingConfig()).first()
    assert r["register"] is True and r["skip_reason"] is None
    slow = [(9.0, 5000.0)]
    r = ga.gate(spark.createDataFrame(good, MET), spark.createDataFrame(slow, PERF), TrainingConfig()).first()
    assert r["skip_reason"] == "performance_thresholds_not_met"
    r = ga.gate(spark.createDataFrame(good, MET), spark.createDataFrame(slow, PERF),
                TrainingConfig(enable_performance_gate=False)).first()
    assert r["register"] is True
    missing = [(None, None)]
    r = ga.gate(spark.createDataFrame(good, MET), spark.createDataFrame(missing, PERF), TrainingConfig()).first()
    assert r["performance_passed"] is False          # a missing figure fails the gate
    weak = [("test", 0.80, 0.9, 0.9, 0.9)]
    r = ga.gate(spark.createDataFrame(weak, MET), spark.createDataFrame(slow, PERF), TrainingConfig()).first()
    assert r["skip_reason"] == "quality_thresholds_not_met"   # quality is reported first
    r = ga.gate(spark.createDataFrame(good, MET), spark.createDataFrame(fast, PERF), TrainingConfig(),
                registration_enabled=False).first()
    assert r["register"] is False and r["skip_reason"] == "registration_disabled"


def test_read_clean_with_schema(spark, tmp_dir):
    spark.range(5).withColumn("x", F.col("id") * 1.5).write.parquet(f"{tmp_dir}/c")
    df = sio.read_clean(spark, f"{tmp_dir}/c", schema=spark.range(1).withColumn("x", F.lit(1.0)).schema)
    assert df.count() == 5 and dict(df.dtypes)["x"] == "double"


def test_latest_execution(spark):
    t = datetime(2024, 1, 31, 0, 0, 0)
    runs = spark.createDataFrame([("a", "cleaning", "COMPLETED", "r1", t - timedelta(minutes=30)),
                                  ("b", "training", "RUNNING", "r2", t - timedelta(minutes=5))],
                                 "raw_blob_name string, phase string, status string, run_id string, written_at timestamp_ntz")
    r = le.latest_execution(runs, ts_lit("2024-01-31 00:00:00")).first()
    assert (r["run_id"], r["status"], r["recent"]) == ("r2", "RUNNING", True)
    r = le.latest_execution(runs, ts_lit("2024-01-31 01:00:00")).first()
    assert r["recent"] is False


def test_check_vectors_expected_length(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0]), (3, None)], "id long, f array<double>")
    good, bad = sc.check_vectors(df, "f", expected=3)
    assert [r["id"] for r in good.collect()] == [2]
    assert sorted(r["status"] for r in bad.collect()) == ["empty", "length_mismatch"]
    with pytest.raises(ValueError, match="key is required"):
        sc.check_vectors(df, "f")


def test_cluster_settings():
    from tabspark.session import cluster_settings
    big = cluster_settings(100 * 2**40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 409600        # 100 TB / 256 MB
    small = cluster_settings(2**30, 64)
    assert int(small["spark.sql.shuffle.partitions"]) == 192          # 3 x cores floor
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
