"""Run ledger.

The reference overwrites one JSON document per input. Here the ledger is an
append-only ``pipeline_runs`` parquet table; "the current record" of an input
is the newest row per (input, phase), found with ``max_by`` (an aggregate with
map-side partial aggregation, so a hot input costs one row per map task).
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspark.operators.ranking import top_per_group
from tabspark.sources.io import append_files, compact_files

STATUS_RUNNING = "RUNNING"
STATUS_COMPLETED = "COMPLETED"
STATUS_FAILED = "FAILED"

RUN_SCHEMA = T.StructType([
    T.StructField("raw_blob_name", T.StringType()),
    T.StructField("phase", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("written_at", T.TimestampType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("finished_at", T.TimestampType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("payload", T.StringType()),
])


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def run_record(spark: SparkSession, raw_blob_name: str, phase: str, status: str, run_id: str,
               started_at: datetime | None = None, finished_at: datetime | None = None,
               payload: dict | None = None) -> DataFrame:
    """L4: one ledger row; duration from start/finish, payload as JSON text."""
    return run_records(spark, [(raw_blob_name, phase, status, run_id, started_at, finished_at, payload)])


def run_records(spark: SparkSession, runs: Sequence[tuple]) -> DataFrame:
    """L4 for several runs at once: (raw_blob_name, phase, status, run_id, started_at, finished_at, payload)."""
    rows = []
    for name, phase, status, run_id, started, finished, payload in runs:
        dur = (finished - started).total_seconds() if started and finished else None
        rows.append((name, phase, status, run_id, utc_now(), started, finished, dur, json.dumps(payload or {}, default=str, sort_keys=True)))
    return spark.createDataFrame(rows, RUN_SCHEMA)


def append_runs(records: DataFrame, path: str) -> None:
    """L1: append run records to the ledger table; several writers may append at once."""
    append_files(records.select(*[f.name for f in RUN_SCHEMA.fields]).coalesce(1), path)   # a few rows


def compact_runs(spark: SparkSession, path: str, files: int = 1) -> int:
    """L1 upkeep: the ledger's many one-record files as ``files`` ones, every record kept (``compact_files``).
    Returns the number of files folded. ``latest_runs`` gives the same before, during and after."""
    return compact_files(spark, path, RUN_SCHEMA, files)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The ledger table; an absent ledger reads as empty."""
    try:
        return spark.read.schema(RUN_SCHEMA).parquet(path)
    except Exception as exc:  # missing path -> empty ledger
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return spark.createDataFrame([], RUN_SCHEMA)
        raise


def latest_runs(runs: DataFrame, keys=("raw_blob_name", "phase"),
                order=("written_at", "run_id")) -> DataFrame:
    """L2: newest record per key, ties broken by the later order columns."""
    keys = list(keys)
    cols = [c for c in runs.columns if c not in keys]
    newest = runs.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(c) for c in order])).alias("_r"))
    return newest.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols])


def parse_ledger_json(docs: DataFrame, column: str = "value") -> DataFrame:
    """L2 for foreign JSON ledgers: missing, empty or invalid text -> null record."""
    schema = T.StructType([f for f in RUN_SCHEMA.fields if f.name != "payload"])
    txt = F.trim(F.col(column))
    parsed = F.when(txt.startswith("{"), F.from_json(txt, schema))
    return docs.select(parsed.alias("r")).select("r.*")


# Foreign run documents: each column with the places it may stand in, the first that is there counts.
DOCUMENT_FIELDS = (
    ("raw_blob_name", ("raw_blob_name",), "string"), ("status", ("status",), "string"), ("run_id", ("run_id", "pipeline_run_id"), "string"),
    ("clean_blob_name", ("clean_blob_name",), "string"), ("started_at", ("started_at",), "timestamp_ntz"), ("finished_at", ("finished_at",), "timestamp_ntz"),
    ("duration_seconds", ("duration_seconds",), "double"), ("model_version", ("model_version",), "string"),
    ("test_roc_auc", ("metrics.test_roc_auc", "metrics.test.roc_auc"), "double"), ("output_rows", ("transform_metrics.output_rows",), "bigint"),
)


def read_documents(docs: DataFrame, column: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """L2: run documents of other tools, one row each: ``keep``, the columns of DOCUMENT_FIELDS, ``phase``
    (training where the document names a pipeline_run_id, else cleaning), the text as ``payload``, and
    ``problem``: null, or why the document can't stand for a run (nothing of a text that is no JSON object is
    read; one without an input's name keeps what it has). ``quarantined`` lists the latter two."""
    text = F.col(column)
    whole = F.try_parse_json(text)
    good = F.coalesce(F.schema_of_variant(whole).startswith("OBJECT"), F.lit(False))
    read = lambda path: F.when(good, F.get_json_object(text, f"$.{path}"))
    cols = [F.coalesce(*[read(p) for p in paths]).try_cast(kind).alias(name) for name, paths, kind in DOCUMENT_FIELDS]
    phase = F.when(good, F.when(read("pipeline_run_id").isNotNull(), F.lit("training")).otherwise(F.lit("cleaning")))
    problem = F.when(~good, F.lit("not a JSON object")).when(read("raw_blob_name").isNull(), F.lit("no raw_blob_name"))
    return docs.select(*keep, *cols, phase.alias("phase"), text.alias("payload"), problem.alias("problem"))


def quarantined(documents: DataFrame) -> DataFrame:
    """Documents of ``read_documents`` that can't stand for a run, with their text."""
    return documents.where(F.col("problem").isNotNull())


def pending_inputs(inputs: DataFrame, runs: DataFrame, phase: str, key: str = "raw_blob_name") -> DataFrame:
    """L3: inputs whose current ledger record for ``phase`` is not COMPLETED."""
    done = latest_runs(runs.where(F.col("phase") == phase)).where(F.col("status") == STATUS_COMPLETED)
    return inputs.select(key).distinct().join(done.select(key), key, "left_anti")


def latest_execution(runs: DataFrame, as_of: Column, recent: str = "10 minutes") -> DataFrame:
    """The newest run overall, its status, and whether it is recent."""
    cols = [c for c in runs.columns]
    one = runs.agg(F.max_by(F.struct(*[F.col(c) for c in cols]),
                            F.struct(F.col("written_at"), F.col("run_id"))).alias("_r"),
                   F.max("written_at").alias("_newest"))
    return one.select(F.col("_r.run_id").alias("run_id"), F.col("_r.status").alias("status"),
                      F.col("_r.raw_blob_name").alias("raw_blob_name"),
                      F.col("_newest").alias("latest_written_at"),
                      (F.col("_newest") >= as_of - F.expr(f"INTERVAL {recent}")).alias("recent"))


def retention(items: DataFrame, group: str, created: str, item_id: str, keep: int,
              protected: DataFrame | None = None) -> DataFrame:
    """Protected items leave first; of the rest those beyond the newest ``keep`` per group.

    The newest ``keep`` per group is a top-k (map-side partial limit), and the
    rest is an anti join against it, so no group is ever sorted in one task.
    """
    if protected is not None:
        items = items.join(protected.select(group, item_id), [group, item_id], "left_anti")
    newest = top_per_group(items, group, [F.col(created).desc(), F.col(item_id).desc()], keep)
    return items.join(newest.select(group, item_id), [group, item_id], "left_anti")
