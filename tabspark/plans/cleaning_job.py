"""Cleaning job: ledger check -> validate -> clean + write -> ledger record.

Spark jobs: the validation aggregation (one shuffle), the clean write (one
shuffle for the distinct; it takes the earlier table's place only if it holds
rows), the removal counts (map-side aggregate), the count of the rows written
(from the files' footers), and a one-row ledger append. Re-running an input
whose current ledger record is COMPLETED does nothing.
"""

from __future__ import annotations

from dataclasses import asdict
from uuid import uuid4

from pyspark.sql import SparkSession

from tabspark.contract import CENSUS, DataContract
from tabspark.operators import clean as cl
from tabspark.operators import ledger as le
from tabspark.operators import validate as va
from tabspark.sources import io as sio

PHASE = "cleaning"


def run_cleaning(spark: SparkSession, raw_root: str, raw_name: str, clean_root: str, ledger_path: str,
                 contract: DataContract = CENSUS, versioned: bool = False) -> dict:
    """Clean one raw input; returns the ledger payload (or the skip notice). With ``versioned`` the clean table
    is published by a pointer (``io.publish``), for readers that may come at any time; ``io.read_clean`` reads
    both kinds."""
    key = raw_name.strip().lstrip("/")
    runs = le.read_runs(spark, ledger_path)
    current = le.latest_runs(runs.where((runs.phase == PHASE) & (runs.raw_blob_name == key))).collect()
    if current and current[0]["status"] == le.STATUS_COMPLETED:
        return {"status": "SKIPPED", "raw_blob_name": key}

    started = le.utc_now()
    raw = sio.read_raw(spark, f"{raw_root.rstrip('/')}/{key}")
    report = va.validate(raw, contract)
    clean_key = sio.clean_blob_name_of(key)
    path = f"{clean_root.rstrip('/')}/{clean_key}"
    (sio.publish if versioned else sio.write_clean)(cl.clean(raw, contract), path)
    metrics = cl.metrics_of(contract, cl.removal_counts(raw, contract).first().asDict(), spark.read.parquet(sio.current_path(spark, path)).count(), report.warnings)
    finished = le.utc_now()
    payload = {"raw_blob_name": key, "clean_blob_name": clean_key,
               "validation_report": {**asdict(report), "duplicate_rate": report.duplicate_rate,
                                     "invalid_state_rate": report.invalid_state_rate},
               "transform_metrics": metrics}
    le.append_runs(le.run_record(spark, key, PHASE, le.STATUS_COMPLETED, uuid4().hex, started, finished, payload),
                   ledger_path)
    return {"status": le.STATUS_COMPLETED, **payload}
