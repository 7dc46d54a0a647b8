"""New-file feed (S5): every parquet file landing under the raw folder is
validated, cleaned and recorded, up to ``files_per_trigger`` files a micro-batch.

A micro-batch costs the same few jobs however many files it holds: one aggregate gives every file's verdict,
one write partitioned by file cleans those that pass (a large file is spread over tasks, small ones share
them), one aggregate each counts what was removed and what was written, and one append records all files. Each
file's folder then takes the place of its clean table by renames.

The feed is idempotent per file (an input whose ledger record is COMPLETED is skipped, the clean output is
replaced), so a replay after a failure gives the same clean tables and one COMPLETED record each. A file that
breaks the contract, of which no row is left, or whose table cannot be put in place gets a FAILED record with
the message (an earlier clean table of it stays) and the others of its batch go on. The stream's own
checkpoint tracks which files were offered.
"""

from __future__ import annotations

import re
from dataclasses import replace
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tabspark.contract import CENSUS, DataContract
from tabspark.operators import clean as cl
from tabspark.operators import ledger as le
from tabspark.operators import validate as va
from tabspark.sources import io as sio

PHASE = "cleaning"
FILES_PER_TRIGGER = 50


def _relative(path: str, root: str) -> str:
    """A file's name below the folder, whichever way scheme and authority are written."""
    bare = lambda x: re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", x)
    p, r = bare(unquote(path)), bare(root).rstrip("/") + "/"   # Spark encodes file paths
    return p[len(r):] if p.startswith(r) else p.rsplit("/", 1)[-1]


def _clean_files(batch: DataFrame, files: list[str], staged: str, contract: DataContract) -> tuple[dict, dict]:
    """Clean the files into ``staged/_part=<place in files>``: per file its removal counts and rows written."""
    spark = batch.sparkSession
    part = F.create_map(*[x for k, path in enumerate(files) for x in (F.lit(path), F.lit(k))])
    some = batch.where(F.col("_file").isin(files)).withColumn("_part", part[F.col("_file")]).drop("_file")
    tagged = replace(contract, passthrough=(*contract.passthrough, "_part"))
    cl.clean(some, tagged).hint("rebalance", "_part").write.partitionBy("_part").parquet(staged)
    removed = {r["_part"]: r.asDict() for r in cl.removal_counts(some, tagged, ["_part"]).collect()}   # one row a file
    try:
        written = {r["_part"]: r["count"] for r in spark.read.parquet(staged).groupBy("_part").count().collect()}
    except Exception as exc:   # no row of any file was left
        if "UNABLE_TO_INFER_SCHEMA" not in str(exc):
            raise
        written = {}
    return removed, written


def process_batch(batch: DataFrame, spark: SparkSession, raw_root: str, clean_root: str, ledger_path: str,
                  contract: DataContract, key_prefix: str = "raw/") -> list[dict]:
    """Clean every file of one micro-batch (at most ``files_per_trigger`` files)."""
    started, results, records = le.utc_now(), [], []

    def record(key: str, status: str, payload: dict) -> None:
        results.append({"raw_blob_name": key, "status": status, **payload})
        records.append((key, PHASE, status, uuid4().hex, started, le.utc_now(), payload))

    batch = batch.persist()  # validated, written and counted: read the files once
    try:
        missing, types, _ = va.schema_problems(batch.drop("_file"), contract)
        seen = batch.groupBy("_file").count() if missing or types else va.verdicts(batch, contract, ["_file"])
        seen = sorted(seen.collect(), key=lambda r: r["_file"])   # one row a file
        keys = {r["_file"]: f"{key_prefix}{_relative(r['_file'], raw_root)}" for r in seen}
        runs = le.read_runs(spark, ledger_path).where((F.col("phase") == PHASE) & F.col("raw_blob_name").isin(*keys.values()))
        done = {r[0] for r in le.latest_runs(runs).where(F.col("status") == le.STATUS_COMPLETED).select("raw_blob_name").collect()} if keys else set()
        good = []
        for r in seen:
            key = keys[r["_file"]]
            fatal = missing or types or r["fatal"]
            if key in done:
                results.append({"raw_blob_name": key, "status": "SKIPPED"})
            elif fatal:
                record(key, le.STATUS_FAILED, {"message": fatal})
            else:
                good.append(r)
        if good:
            staged = f"{clean_root.rstrip('/')}/_staged-{uuid4().hex}"
            removed, written = _clean_files(batch, [r["_file"] for r in good], staged, contract)
            for k, r in enumerate(good):
                key = keys[r["_file"]]
                clean_key = sio.clean_blob_name_of(key)
                try:
                    if not written.get(k):
                        raise sio.EmptyInputError("Refusing to write an empty clean frame")
                    sio.swap_in(spark, f"{staged}/_part={k}", f"{clean_root.rstrip('/')}/{clean_key}")
                except (OSError, sio.EmptyInputError) as exc:
                    record(key, le.STATUS_FAILED, {"message": str(exc)})
                    continue
                record(key, le.STATUS_COMPLETED, {"clean_blob_name": clean_key, "warnings": list(r["warnings"]),
                                                  "transform_metrics": cl.metrics_of(contract, removed[k], written[k], r["warnings"])})
        if records:
            le.append_runs(le.run_records(spark, records), ledger_path)
    finally:
        batch.unpersist()
    return results


def start_ingest(spark: SparkSession, raw_root: str, schema: T.StructType, clean_root: str, ledger_path: str,
                 checkpoint: str, contract: DataContract = CENSUS, available_now: bool = True,
                 log: list | None = None, key_prefix: str = "raw/monthly/", files_per_trigger: int = FILES_PER_TRIGGER) -> StreamingQuery:
    """Start the feed over the folder ``raw_root`` (``*.parquet`` only, folders below it too); ledger keys
    are ``key_prefix`` + the file's name below the folder."""
    stream = (spark.readStream.schema(schema)
              .option("pathGlobFilter", "*.parquet").option("maxFilesPerTrigger", files_per_trigger).option("recursiveFileLookup", "true")
              .parquet(raw_root)
              .withColumn("_file", F.col("_metadata.file_path")))

    def handle(batch: DataFrame, epoch_id: int) -> None:
        out = process_batch(batch, spark, raw_root, clean_root, ledger_path, contract, key_prefix)
        if log is not None:
            log.extend(out)

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
