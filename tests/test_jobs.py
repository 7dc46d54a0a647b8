import pytest
from conftest import SF0001

from tabspark.contract import CENSUS, TrainingConfig
from tabspark.operators import ledger as le
from tabspark.plans.cleaning_job import run_cleaning
from tabspark.plans.training_job import run_training
from tabspark.sources import fixtures as fx
from tabspark.sources import io as sio


def test_cleaning_job_runs_once(spark, tmp_dir):
    fx.acs_raw(spark, SF0001).write.parquet(f"{tmp_dir}/raw/monthly/jan.parquet")
    first = run_cleaning(spark, tmp_dir, "raw/monthly/jan.parquet", tmp_dir, f"{tmp_dir}/ledger",
                         CENSUS.with_passthrough("k"))
    assert first["status"] == "COMPLETED" and first["clean_blob_name"] == "clean/monthly/jan.parquet"
    m = first["transform_metrics"]
    assert m["input_rows"] - m["output_rows"] == m["rows_removed"] > 0
    second = run_cleaning(spark, tmp_dir, "/raw/monthly/jan.parquet", tmp_dir, f"{tmp_dir}/ledger",
                          CENSUS.with_passthrough("k"))
    assert second["status"] == "SKIPPED"
    assert le.read_runs(spark, f"{tmp_dir}/ledger").count() == 1
    clean = spark.read.parquet(f"{tmp_dir}/clean/monthly/jan.parquet")
    assert clean.count() == m["output_rows"]


def test_training_job_records_and_gates(spark, tmp_dir):
    fx.acs_raw(spark, SF0001).write.parquet(f"{tmp_dir}/raw/monthly/jan.parquet")
    run_cleaning(spark, tmp_dir, "raw/monthly/jan.parquet", tmp_dir, f"{tmp_dir}/ledger", CENSUS.with_passthrough("k"))
    clean = spark.read.parquet(f"{tmp_dir}/clean/monthly/jan.parquet")
    cfg = TrainingConfig(num_boost_round=5, enable_model_registration=True, min_auc=0.0, min_f1=0.0,
                         min_precision=0.0, min_recall=0.0, max_p95_latency_ms=1e9, min_throughput_rows_per_sec=0.0)
    out = run_training(spark, clean, "raw/monthly/jan.parquet", f"{tmp_dir}/ledger", f"{tmp_dir}/registry", cfg,
                       CENSUS.with_passthrough("k"))
    assert out["status"] == "COMPLETED"
    assert out["gate"]["register"] is True and out["gate"]["version"] == 1
    assert len(out["feature_importance"]) <= 50
    runs = le.latest_runs(le.read_runs(spark, f"{tmp_dir}/ledger")).collect()
    assert {(r["phase"], r["status"]) for r in runs} == {("cleaning", "COMPLETED"), ("training", "COMPLETED")}
    again = run_training(spark, clean, "raw/monthly/jan.parquet", f"{tmp_dir}/ledger", f"{tmp_dir}/registry", cfg)
    assert again["status"] == "SKIPPED"


def test_empty_clean_result_leaves_the_earlier_table(spark, tmp_dir):
    good = fx.acs_raw(spark, SF0001)
    good.write.parquet(f"{tmp_dir}/raw/monthly/jan.parquet")
    run_cleaning(spark, tmp_dir, "raw/monthly/jan.parquet", tmp_dir, f"{tmp_dir}/ledger", CENSUS)
    path = f"{tmp_dir}/clean/monthly/jan.parquet"
    before = sorted(map(str, spark.read.parquet(path).collect()))
    with pytest.raises(sio.EmptyInputError):
        sio.write_clean(spark.read.parquet(path).limit(0), path)
    assert before and sorted(map(str, spark.read.parquet(path).collect())) == before
    sio.write_clean(spark.read.parquet(path).limit(3), path)   # reads the table it replaces
    assert spark.read.parquet(path).count() == 3


def test_cleaning_job_publishes_versions(spark, tmp_dir):
    fx.acs_raw(spark, SF0001).write.parquet(f"{tmp_dir}/raw/monthly/jan.parquet")
    out = run_cleaning(spark, tmp_dir, "raw/monthly/jan.parquet", tmp_dir, f"{tmp_dir}/ledger", CENSUS.with_passthrough("k"), versioned=True)
    path = f"{tmp_dir}/{out['clean_blob_name']}"
    assert sio.versions(spark, path) == [1]
    assert sio.read_clean(spark, path).count() == out["transform_metrics"]["output_rows"] > 0
