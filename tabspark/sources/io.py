"""Parquet sources and sinks (S1-S4) and storage-key derivation."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class EmptyInputError(ValueError):
    """An input or output that must hold rows is empty."""


def read_raw(spark: SparkSession, path: str, check_empty: bool = True) -> DataFrame:
    """Raw parquet; fails when it holds no rows (a limit-1 probe)."""
    df = spark.read.parquet(path)
    if check_empty and df.isEmpty():
        raise EmptyInputError(f"Raw input {path} is empty")
    return df


def read_clean(spark: SparkSession, path: str, schema: T.StructType | None = None,
               check_empty: bool = True) -> DataFrame:
    """Clean parquet with an explicit schema; fails when empty. A table that ``publish`` keeps is read in
    its current version."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(current_path(spark, path))
    if check_empty and df.isEmpty():
        raise EmptyInputError(f"Clean input {path} is empty")
    return df


def write_clean(df: DataFrame, path: str, output_rows: int | None = None,
                partition_by: list[str] | None = None) -> None:
    """S3: replace the clean table. The result is written beside the table, in a
    hidden folder; only if it holds rows does it take the table's place, so an
    empty result or a failed write leaves the earlier table as it was.
    ``output_rows`` lets a caller that knows the count refuse without a write."""
    if output_rows is not None and output_rows == 0:
        raise EmptyInputError("Refusing to write an empty clean frame")
    spark = df.sparkSession
    parent, _, name = path.rstrip("/").rpartition("/")
    staged = f"{parent}/_staged-{uuid.uuid4().hex}-{name}"
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(staged)
    if spark.read.schema(df.schema).parquet(staged).isEmpty():
        _delete(spark, staged)
        raise EmptyInputError("Refusing to write an empty clean frame")
    swap_in(spark, staged, path)


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _delete(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


def swap_in(spark: SparkSession, staged: str, path: str) -> None:
    """Put the written folder ``staged`` in the place of the table ``path``, by renames."""
    parent, _, name = path.rstrip("/").rpartition("/")
    fs, target = _fs(spark, path)
    _, source = _fs(spark, staged)
    _, earlier = _fs(spark, f"{parent}/_earlier-{uuid.uuid4().hex}-{name}")
    fs.mkdirs(target.getParent())
    replaced = fs.exists(target)
    if replaced and not fs.rename(target, earlier):
        raise OSError(f"could not set the earlier table {path} aside")
    if not fs.rename(source, target):
        if replaced:
            fs.rename(earlier, target)
        raise OSError(f"could not move the new table to {path}")
    if replaced:
        fs.delete(earlier, True)


def append_files(df: DataFrame, path: str) -> None:
    """Append rows to the table ``path``, safe beside other writers: the rows are written to a hidden folder
    of their own and its files then move into the table, so no writer meets another's unfinished files (Spark's
    own append mode shares one ``_temporary`` folder per table). A reader sees each file whole or not at all."""
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}/_append-{uuid.uuid4().hex}"
    df.write.parquet(staged)
    fs, folder = _fs(spark, staged)
    _, table = _fs(spark, path)
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.endswith(".parquet") and not fs.rename(status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(table, name)):
            raise OSError(f"could not move {name} into {path}")
    fs.delete(folder, True)


def claim(spark, folder: str, start: int) -> int:
    """The first number from ``start`` on that nobody else has claimed in ``folder``: a file of that name is
    created with overwrite off, which one of several writers only can do; the others go on with the next
    number. (Hadoop's local and HDFS file systems do this as one step.) A claim whose writer dies stays, so
    its number is never given again."""
    jvm, number = spark._jvm, start
    fs = jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    while True:
        try:
            fs.create(jvm.org.apache.hadoop.fs.Path(f"{folder}/{number:012d}"), False).close()
            return number
        except Py4JJavaError as exc:
            if "FileAlreadyExistsException" not in str(exc.java_exception):
                raise
            number += 1


def versions(spark: SparkSession, path: str) -> list[int]:
    """Published versions of the table ``path``, oldest first (none: not kept by ``publish``)."""
    fs, folder = _fs(spark, f"{path.rstrip('/')}/_current")
    if not fs.exists(folder):
        return []
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(folder))


def current_path(spark: SparkSession, path: str) -> str:
    """Where the rows of the table ``path`` are: the folder of its newest published version, or ``path``
    itself if it is a plain folder."""
    known = versions(spark, path)
    return f"{path.rstrip('/')}/v{known[-1]:012d}" if known else path


def publish(df: DataFrame, path: str, keep: int = 2) -> int:
    """S3 for readers and writers at the same time: the rows go into a folder of their own under ``path``, whose
    number no other writer has, and one empty pointer file makes them the current version. ``read_clean``
    finds the earlier version until then and the new one from then on, never none; of several writers at a
    time each publishes, and the one that came last by number is current. An empty result or a failed write
    publishes nothing. Versions beyond the newest ``keep`` are removed, pointer last. Returns the number."""
    if keep < 1:
        raise ValueError(f"at least one version has to stay, not {keep}")
    spark, root = df.sparkSession, path.rstrip("/")
    known = versions(spark, root)
    number = claim(spark, f"{root}/_claims", known[-1] + 1 if known else 1)
    folder = f"{root}/v{number:012d}"
    df.write.parquet(folder)
    if spark.read.schema(df.schema).parquet(folder).isEmpty():
        _delete(spark, folder)
        raise EmptyInputError("Refusing to publish an empty clean frame")
    fs, pointer = _fs(spark, f"{root}/_current/{number:012d}")
    fs.create(pointer, False).close()
    for old in versions(spark, root)[:-keep]:
        _delete(spark, f"{root}/v{old:012d}")
        _delete(spark, f"{root}/_current/{old:012d}")
    return number


def compact_files(spark: SparkSession, path: str, schema: T.StructType, files: int = 1, stale_seconds: int = 3600) -> int:
    """Fold the many small files of an append-only table (``append_files``) into ``files`` ones; returns how many
    files were folded (0: nothing to do, or another compaction runs). Appenders may go on: only files listed at
    the start are folded. The folded rows come in before the files they stand for go, so a reader may for a
    moment see a record twice, never miss one; whole-row duplicates that a compaction left when it died in
    between leave with the next one. A reader whose file list is older than that has to list again."""
    root = path.rstrip("/")
    fs, table = _fs(spark, root)
    if not fs.exists(table):
        return 0
    names = sorted(s.getPath().getName() for s in fs.listStatus(table))
    small = [f"{root}/{n}" for n in names if n.endswith(".parquet")]
    if len(small) <= files:
        return 0
    _, lock = _fs(spark, f"{root}/_compacting")
    if fs.exists(lock) and datetime.now().timestamp() - fs.getFileStatus(lock).getModificationTime() / 1000 > stale_seconds:
        fs.delete(lock, False)   # its owner is gone
    try:
        fs.create(lock, False).close()
    except Py4JJavaError as exc:
        if "FileAlreadyExistsException" not in str(exc.java_exception):
            raise
        return 0
    try:
        append_files(spark.read.schema(schema).parquet(*small).dropDuplicates().repartition(files), root)
        for name in small:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(name), False)
    finally:
        fs.delete(lock, False)
    return len(small)


def write_batch(df: DataFrame, folder: str, n: int, order_by: list[str],
                prefix: str = "batch", compression: str = "zstd", now: datetime | None = None) -> str:
    """The first ``n`` rows (explicit order, top-k plan) as a zstd parquet
    file set under a timestamped name; returns the path written."""
    stamp = (now or datetime.now(timezone.utc)).strftime("%Y%m%dT%H%M%SZ")
    path = f"{folder.rstrip('/')}/{prefix}_{stamp}.parquet"
    df.orderBy(*order_by).limit(n).write.option("compression", compression).mode("error").parquet(path)
    return path


def _strip(name: Column) -> Column:
    trimmed = F.regexp_replace(name, r"(?U)^\s+|\s+$", "")
    return F.regexp_replace(trimmed, r"^/+", "")


def clean_blob_name(name: Column) -> Column:
    """Raw key -> clean key: first path segment replaced by ``clean``."""
    n = _strip(name)
    return F.when(n == "", F.lit(None)).otherwise(
        F.concat(F.lit("clean/"), F.regexp_replace(n, r"^[^/]*/", "")))


def clean_blob_name_of(name: str) -> str:
    """S6 for one key on the driver (same rule as ``clean_blob_name``)."""
    n = name.strip().lstrip("/")
    if not n:
        raise ValueError("raw_blob_name is required")
    head, sep, rest = n.partition("/")
    return f"clean/{rest}" if sep else f"clean/{n}"


def training_ledger_name(name: Column) -> Column:
    """Raw key -> training ledger key (``training/<key minus .parquet>.json``)."""
    n = _strip(name)
    base = F.regexp_replace(n, r"\.parquet$", "")
    return F.when(n == "", F.lit(None)).otherwise(F.concat(F.lit("training/"), base, F.lit(".json")))


def cleaning_ledger_name(name: Column) -> Column:
    """Raw key -> cleaning ledger key (``elt/<key>.json``)."""
    n = _strip(name)
    return F.when(n == "", F.lit(None)).otherwise(F.concat(F.lit("elt/"), n, F.lit(".json")))


def newest_file(spark: SparkSession, folder: str, as_of: datetime, minutes: int,
                glob: str = "*.parquet") -> DataFrame:
    """Newest modification time under ``folder`` and whether it is within
    ``minutes`` of ``as_of``. Only file metadata is read (the content column of
    the ``binaryFile`` source is pruned)."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(folder))
    newest = files.agg(F.max("modificationTime").alias("newest"), F.count(F.lit(1)).alias("files"))
    cutoff = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    return newest.withColumn("recent", F.coalesce(F.col("newest") >= cutoff, F.lit(False)))


DATE_PARTITION = "event_date"


def write_by_date(df: DataFrame, path: str, ts: str = "TimeGenerated", mode: str = "append") -> None:
    """Telemetry sink partitioned by event date, so time-window readers prune
    whole date folders (see ``operators.telemetry.recent``)."""
    df.withColumn(DATE_PARTITION, F.to_date(F.col(ts))).write.mode(mode) \
        .partitionBy(DATE_PARTITION).parquet(path)
