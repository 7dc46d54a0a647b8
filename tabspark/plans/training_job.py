"""Training job: label -> exact split -> encode -> train -> evaluate -> gate ->
register -> ledger, with RUNNING / COMPLETED / FAILED records.

The split table is written once to the shared checkpoint folder; every later
step reads it (train, validation and test are filters of one table).
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import asdict
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.contract import CENSUS, CENSUS_NUMERIC_FEATURES, DataContract, TrainingConfig
from tabspark.operators import evaluate as ev
from tabspark.operators import features as fe
from tabspark.operators import gates as ga
from tabspark.operators import ledger as le
from tabspark.operators import lineage as lg
from tabspark.operators import registry as rg
from tabspark.operators import score as sc
from tabspark.operators import split as sp
from tabspark.operators import train as tr
from tabspark.session import checkpoint_dir, materialize, materialize_observed
from tabspark.sources import io as sio

PHASE = "training"


def fit_and_evaluate(clean: DataFrame, cfg: TrainingConfig, contract: DataContract = CENSUS,
                     numeric=CENSUS_NUMERIC_FEATURES, class_counts: dict | None = None) -> dict:
    """Split, encode, train and evaluate; returns the DataFrames and facts the
    job records. The driver holds only the vocabulary and one-row results.
    ``class_counts`` (from ``split.class_counts_from``) skips the counting job
    when the caller observed them while writing ``clean``."""
    spark = clean.sparkSession
    checkpoint_dir(spark)
    labelled = sp.label(clean, "PINCP", cfg.target_income_threshold)
    key = list(contract.passthrough) or None
    splitted = materialize(sp.split(labelled, cfg.random_seed, cfg.fractions, "TARGET", key=key,
                                    class_counts=class_counts), "split")
    train_rows = splitted.where(F.col("split") == "train")
    class_counts = sp.class_balance_guard(train_rows)
    enc = fe.FeatureEncoder.fit(train_rows, numeric, contract.code_column)
    enc.check(splitted)
    keep = ["split"] + (key or [])
    encoded = enc.transform(splitted, keep=keep, check=False)
    trained = tr.train(encoded.where(F.col("split") == "train"),
                       encoded.where(F.col("split") == "validation"), cfg)
    parts, latency = [], {}
    for name in ("validation", "test"):   # E7: a time of its own for each split
        t0 = time.perf_counter()
        part, seen = materialize_observed(sc.score(encoded.where(F.col("split") == name), trained.model, cfg.threshold,
                                                   keep=keep + ["TARGET"]), f"scored-{name}", F.count(F.lit(1)).alias("rows"))
        latency[name] = (time.perf_counter() - t0) * 1000.0 / max(seen["rows"], 1)
        parts.append(part)
    scored = parts[0].unionByName(parts[1])
    metrics = ev.binary_metrics(scored, "TARGET", "score", ["split"], cfg.threshold)
    per_split = F.create_map(*[F.lit(x) for pair in latency.items() for x in pair])
    metrics = metrics.withColumn("prediction_latency_ms_per_row", per_split[F.col("split")])
    return {"encoder": enc, "trained": trained, "metrics": metrics, "scored": scored,
            "encoded": encoded, "class_counts": class_counts}


def benchmark_sample(encoded: DataFrame, model, order_by: Sequence[str], limit: int = 512, warmups: int = 2, runs: int = 10) -> DataFrame:
    """Timed scoring of the first ``limit`` validation rows by ``order_by`` (M6 + E11 input): one row per
    timed run with its wall time and row count."""
    spark = encoded.sparkSession
    sample = materialize(sc.first_rows(encoded.where(F.col("split") == "validation"), order_by, limit), "sample")
    n = sample.count()
    if n == 0:  # M6 fallback: the first 100 training rows
        sample = materialize(sc.first_rows(encoded.where(F.col("split") == "train"), order_by, 100), "sample")
        n = sample.count()
    if n == 0:
        raise ValueError("Training data is empty")
    timings = []
    for i in range(warmups + runs):
        t0 = time.perf_counter()
        model.transform(sample).select("probability").count()
        if i >= warmups:
            timings.append(((time.perf_counter() - t0) * 1000.0, n))
    return spark.createDataFrame(timings, "ms double, rows long")


def run_training(spark: SparkSession, clean: DataFrame, raw_name: str, ledger_path: str,
                 registry_root: str, cfg: TrainingConfig = TrainingConfig(),
                 contract: DataContract = CENSUS, git_sha: str | None = None, image_digest: str | None = None) -> dict:
    """One training run with its ledger records; ``git_sha`` and ``image_digest`` name the code that runs,
    null where unknown. A registration that fails is recorded and leaves the training COMPLETED."""
    key = raw_name.strip().lstrip("/")
    runs = le.read_runs(spark, ledger_path)
    current = le.latest_runs(runs.where((F.col("phase") == PHASE) & (F.col("raw_blob_name") == key))).collect()
    if current and current[0]["status"] == le.STATUS_COMPLETED:
        return {"status": "SKIPPED", "raw_blob_name": key}
    run_id = uuid4().hex
    started = le.utc_now()
    le.append_runs(le.run_record(spark, key, PHASE, le.STATUS_RUNNING, run_id, started), ledger_path)
    try:
        out = fit_and_evaluate(clean, cfg, contract)
        trained, enc = out["trained"], out["encoder"]
        order = list(contract.passthrough) or list(enc.feature_names[:len(enc.numeric)])
        perf = ev.latency_stats(benchmark_sample(out["encoded"], trained.model, order), "ms", "rows")
        decision = ga.gate(out["metrics"].where(F.col("split") == "test"), perf, cfg, "split",
                           cfg.enable_model_registration).first().asDict()
        if decision["register"]:
            try:
                version = rg.register(spark, registry_root, cfg.model_name, run_id, le.utc_now())
                rg.set_alias(spark, registry_root, cfg.model_name, cfg.promotion_stage, version, le.utc_now())
                decision["version"] = version
            except Exception as exc:   # the model is trained and evaluated all the same
                decision.update(register=False, registration_error=str(exc))
        payload = {
            **lg.lineage(clean_name=sio.clean_blob_name_of(key), git_sha=git_sha, image_digest=image_digest, seed=cfg.random_seed,
                         threshold=cfg.target_income_threshold, model_name=cfg.model_name, model_version=decision.get("version"),
                         model_sha256=lg.table_digest(trained.model.table(spark)).first()["sha256"],
                         input_sha256=lg.table_digest(clean.select(*contract.output_columns)).first()["sha256"]),
            "evaluation": [r.asDict() for r in out["metrics"].collect()],
            "feature_importance": [r.asDict() for r in tr.importance(spark, trained.model, enc.feature_names).collect()],
            "best_iteration": trained.best_iteration, "trees": trained.trees, "rounds": trained.rounds,
            "feature_names": list(enc.feature_names), "class_counts": out["class_counts"],
            "performance": perf.first().asDict(), "gate": decision, "config": asdict(cfg),
        }
        le.append_runs(le.run_record(spark, key, PHASE, le.STATUS_COMPLETED, run_id, started, le.utc_now(), payload),
                       ledger_path)
        return {"status": le.STATUS_COMPLETED, **payload}
    except Exception as exc:
        try:
            le.append_runs(le.run_record(spark, key, PHASE, le.STATUS_FAILED, run_id, started, le.utc_now(),
                                         {"message": str(exc)}), ledger_path)
        finally:
            raise
