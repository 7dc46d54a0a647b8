"""JSON log lines -> typed table (T20) and scan reports reader (T21 input)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fields written by the service's JSON log formatter and its
# request middleware.
LOG_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("level", T.StringType()),
    T.StructField("logger", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("exception", T.StringType()),
    T.StructField("request_id", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("duration_ms", T.DoubleType()),
    T.StructField("client", T.StringType()),
])

REPORT_SCHEMA = T.StructType([T.StructField("Results", T.ArrayType(T.StructType([
    T.StructField("Target", T.StringType()),
    T.StructField("Vulnerabilities", T.ArrayType(T.StructType([
        T.StructField("VulnerabilityID", T.StringType()),
        T.StructField("PkgName", T.StringType()),
        T.StructField("InstalledVersion", T.StringType()),
        T.StructField("FixedVersion", T.StringType()),
        T.StructField("Severity", T.StringType()),
        T.StructField("Title", T.StringType()),
    ]))),
])))])


def read_log_text(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines (column ``value``) from text files; splits by file and block."""
    return spark.read.text(path)


def parse_logs(lines: DataFrame, column: str = "value") -> DataFrame:
    """Typed log records; lines that are not JSON objects get ``corrupt = true``
    and keep their text in ``raw_line``. Keys beyond the schema are in ``extra``
    (map of texts; null for corrupt lines)."""
    names = [f.name for f in LOG_SCHEMA.fields]
    parsed = lines.select(F.col(column).alias("_line"),
                          F.from_json(F.col(column), LOG_SCHEMA, {"mode": "PERMISSIVE"}).alias("r"),
                          F.from_json(F.col(column), "map<string,string>", {"mode": "PERMISSIVE"}).alias("_all"))
    ok = F.col("_line").startswith("{") & F.col("r").isNotNull() & F.col("r.level").isNotNull()
    return parsed.select(
        F.try_to_timestamp(F.col("r.timestamp")).alias("timestamp"),
        *[F.col(f"r.{f.name}").alias(f.name) for f in LOG_SCHEMA.fields if f.name != "timestamp"],
        F.when(ok, F.map_filter("_all", lambda k, v: ~k.isin(*names))).alias("extra"),
        F.when(~F.coalesce(ok, F.lit(False)), F.col("_line")).alias("raw_line"),
        (~F.coalesce(ok, F.lit(False))).alias("corrupt"),
    )


def level_counts(records: DataFrame) -> DataFrame:
    """Lines per level (corrupt lines under level ``null``)."""
    lvl = F.when(F.col("corrupt"), F.lit(None).cast("string")).otherwise(F.upper("level"))
    return records.groupBy(lvl.alias("level")).agg(F.count(F.lit(1)).alias("lines"))


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """Multi-line JSON scan reports, one document per file."""
    return spark.read.schema(REPORT_SCHEMA).option("multiLine", True).json(path)
