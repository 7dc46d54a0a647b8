"""Content digests and the lineage of a run.

``file_digest`` is the SHA-256 of one file, read as a stream through Hadoop's file systems, so the file may be
of any size and in any store that Spark reads. ``table_digest`` identifies the rows of a table, whatever files
they are in and in whatever order: every row's SHA-256 is cut into words, words are summed over all rows in
one map-side aggregate, and the sums are hashed once more. Equal rows count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_WORD = 8  # hex digits of a word: 8 words of 32 bits a row


def file_digest(spark: SparkSession, path: str) -> str:
    """SHA-256 of a file's bytes, in lower-case hex."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).open(at)
    try:
        return jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
    finally:
        stream.close()


def row_digest(columns: Sequence[str | Column]) -> Column:
    """SHA-256 of a row: each value as text with its length before it, so neither nulls nor values that
    hold a separator can be taken for others."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat_ws(",", *parts), 256)


def table_digest(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: rows, sha256 (of an empty table: of eight zero sums). Independent of files and order."""
    hashed = df.select(row_digest(columns or df.columns).alias("h"))
    words = [F.conv(F.substring("h", 1 + k * _WORD, _WORD), 16, 10).cast("decimal(20,0)") for k in range(64 // _WORD)]
    sums = hashed.agg(F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(w), F.lit(0)).cast("decimal(38,0)").alias(f"w{k}") for k, w in enumerate(words)])
    return sums.select("rows", F.sha2(F.concat_ws(",", F.col("rows").cast("string"), *[F.col(f"w{k}").cast("string") for k in range(len(words))]), 256).alias("sha256"))


def lineage(clean_name: str | None = None, git_sha: str | None = None, image_digest: str | None = None, seed: int | None = None,
            threshold: float | None = None, model_name: str | None = None, model_version: int | None = None,
            model_sha256: str | None = None, input_sha256: str | None = None) -> dict:
    """L4: where a run's result comes from; what is unknown is null."""
    return {"clean_blob_name": clean_name, "git_sha": git_sha, "container_image_digest": image_digest, "seed": seed, "target_threshold": threshold,
            "model_name": model_name, "model_version": model_version, "model_sha256": model_sha256, "input_sha256": input_sha256}
