"""Fixture views derived from the driver's tables.

No census extract or telemetry store exists in ``/root/testdata``, so the
inputs are derived, by Spark, from ``orders``/``customer`` (a raw census-shaped
frame) and from ``events`` (request telemetry, run ledger, registry, logs and
scan findings). Every derived row comes from a whole source table, so the work
grows with it.

Each view is defined twice from the same column expressions: a Spark
DataFrame and a DuckDB SQL text used by the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# acs_raw: census-shaped raw rows. ``k`` is the order key; every order whose
# key is a multiple of 17 appears twice (exact duplicates), some ages/hours/
# years are out of range, some STATE codes are lower case, padded or invalid,
# and a few AGEP/COW values are null.
# ---------------------------------------------------------------------------
_ACS_EXPRS = [
    "CASE WHEN k % 401 = 0 THEN NULL ELSE CAST(18 + k % 99 AS DOUBLE) END AS AGEP",
    "CASE WHEN k % 101 = 0 THEN NULL ELSE CAST(1 + k % 8 AS DOUBLE) END AS COW",
    "CAST(1 + k % 24 AS DOUBLE) AS SCHL",
    "CAST(1 + k % 5 AS DOUBLE) AS MAR",
    "CAST(100 + k % 4900 AS DOUBLE) AS OCCP",
    "CAST(1 + c_nationkey AS DOUBLE) AS POBP",
    "CAST(k % 18 AS DOUBLE) AS RELP",
    "CAST(k % 170 AS DOUBLE) AS WKHP",
    "CAST(1 + k % 2 AS DOUBLE) AS SEX",
    "CAST(1 + k % 9 AS DOUBLE) AS RAC1P",
    "CASE WHEN k % 211 = 0 THEN 'X1' "
    "WHEN k % 3 = 0 THEN concat(lower(substr('ABCDEFGHIJKLMNOPQRSTUVWXY', c_nationkey + 1, 1)), 'a') "
    "ELSE concat(' ', substr('ABCDEFGHIJKLMNOPQRSTUVWXY', c_nationkey + 1, 1), 'A ') END AS STATE",
    "CAST(CASE WHEN k % 503 = 0 THEN 2036 ELSE 2014 + k % 10 END AS BIGINT) AS YEAR",
    "CAST(300 * (k % 170) + 1200 * (1 + k % 24) + CAST(floor(o_totalprice) AS BIGINT) % 20000 AS DOUBLE) AS PINCP",
    "k",
]


def acs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw census-shaped frame (13 contract columns + key ``k``)."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), "o_custkey", "o_totalprice")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
    # duplicate rows by a generator (no join): one extra copy when k % 17 = 0
    copies = joined.withColumn(
        "_copy", F.explode(F.sequence(F.lit(0), F.when(F.col("k") % 17 == 0, 1).otherwise(0))))
    return copies.selectExpr(*_ACS_EXPRS)


ACS_RAW_SQL = (
    "SELECT " + ", ".join(_ACS_EXPRS) + " FROM (SELECT *, unnest(CASE WHEN k % 17 = 0 THEN [0, 1] ELSE [0] END) AS copy "
    "FROM (SELECT o_orderkey AS k, o_custkey, o_totalprice FROM orders) o "
    "JOIN customer ON o.o_custkey = customer.c_custkey) o"
)


# ---------------------------------------------------------------------------
# Telemetry views over ``events`` (request log store stand-in).
#   requests: view/purchase/error events, failed when error
#   dependencies: click events, failed when value >= 200
#   traces: signup events, severity event_id % 5
#   exceptions: every error event
#   metrics: every event, named by event_id % 4 (one name outside the panel)
# OperationId = event_id % 1000, so each operation has many rows.
# ---------------------------------------------------------------------------
AS_OF = "2024-01-31 00:00:00"
# the registered queries look back over the whole table (events start 2024-01-01)
LOOKBACK = "30 days"

_REQ = [
    "ts AS TimeGenerated", "event_id % 1000 AS OperationId", "event_type AS Name",
    "concat('GET /', event_type) AS OperationName", "event_type <> 'error' AS Success",
    "value AS DurationMs",
    "CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS ResultCode",
    "concat('/api/', event_type) AS Url", "'scoring' AS AppRoleName",
    "concat('replica-', CAST(user_id % 3 AS STRING)) AS AppRoleInstance",
    "CASE WHEN user_id % 2 = 0 THEN 'baseline' ELSE 'candidate' END AS Revision",
    "event_id",
]
_DEP = ["ts AS TimeGenerated", "event_id % 1000 AS OperationId", "value < 200 AS Success",
        "value AS DurationMs", "event_id"]
_TRC = ["ts AS TimeGenerated", "event_id % 1000 AS OperationId",
        "CAST(event_id % 5 AS INT) AS SeverityLevel",
        "concat(CASE WHEN event_id % 7 = 0 THEN 'Blob trigger fired for ' "
        "WHEN event_id % 7 = 1 THEN 'ACA job started for ' ELSE 'Processed ' END, props) AS Message",
        "event_id"]
_EXC = ["ts AS TimeGenerated", "event_id % 1000 AS OperationId", "event_id"]
_MET = ["ts AS TimeGenerated",
        "CASE event_id % 4 WHEN 0 THEN 'prediction_latency_ms' WHEN 1 THEN 'prediction_count' "
        "WHEN 2 THEN 'validation_failures' ELSE 'cpu_percent' END AS Name",
        "CAST(value AS STRING) AS Value", "event_id"]

_VIEWS = {
    "requests": (_REQ, "event_type IN ('view', 'purchase', 'error')"),
    "dependencies": (_DEP, "event_type = 'click'"),
    "traces": (_TRC, "event_type = 'signup'"),
    "exceptions": (_EXC, "event_type = 'error'"),
    "metrics": (_MET, None),
}


def telemetry(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of requests / dependencies / traces / exceptions / metrics."""
    exprs, where = _VIEWS[name]
    ev = table(spark, sf_dir, "events")
    if where:
        ev = ev.where(where)
    return ev.selectExpr(*exprs)


def view_of(events: DataFrame, name: str) -> DataFrame:
    """A telemetry view over an events table or stream."""
    exprs, where = _VIEWS[name]
    return (events.where(where) if where else events).selectExpr(*exprs)


# How events arrive in the append-mode stream: by ten days of their time, every 37th two slices later.
ARRIVAL_SLICES = 3
_OWN_SLICE = "least(2, greatest(0, CAST(floor((dayofyear(ts) - 1) / 10) AS INT)))"
ARRIVAL_SLICE = f"least(2, {_OWN_SLICE} + CASE WHEN event_id % 37 = 0 THEN 2 ELSE 0 END)"


def telemetry_sql(name: str) -> str:
    exprs, where = _VIEWS[name]
    sel = ", ".join(e.replace("AS STRING)", "AS VARCHAR)") for e in exprs)
    return f"SELECT {sel} FROM events" + (f" WHERE {where}" if where else "")


# ---------------------------------------------------------------------------
# Run ledger, registry and findings derived from ``events``.
# ---------------------------------------------------------------------------
# ledger: every event is a run record for input blob raw/monthly/u<user>.parquet
_RUNS = [
    "concat('raw/monthly/u', CAST(user_id AS STRING), '.parquet') AS raw_blob_name",
    "CASE WHEN event_id % 2 = 0 THEN 'cleaning' ELSE 'training' END AS phase",
    "CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'COMPLETED' "
    "WHEN 'signup' THEN 'COMPLETED' ELSE 'RUNNING' END AS status",
    "concat('run-', CAST(event_id AS STRING)) AS run_id",
    "ts AS written_at",
    "value AS duration_seconds",
]
# candidate inputs: one raw blob per customer
_INPUTS = [
    "concat('raw/monthly/u', CAST(c_custkey AS STRING), '.parquet') AS raw_blob_name",
]
# registry: purchase events register versions of model m<user % 7>;
# view events move an alias of that model to the newest version at that time
_VERSIONS = [
    "concat('m', CAST(user_id % 7 AS STRING)) AS model_name",
    "CASE WHEN event_id % 11 = 0 THEN '' ELSE concat('run-', CAST(event_id AS STRING)) END AS run_id",
    "ts AS created_at",
]
_ALIASES = [
    "concat('m', CAST(user_id % 7 AS STRING)) AS model_name",
    "CASE WHEN event_id % 2 = 0 THEN 'Staging' ELSE 'production' END AS alias",
    "CAST(event_id % 400 + 1 AS BIGINT) AS version",
    "ts AS set_at",
]
# scan findings: every event is a finding on image img-<user % 13>
_FINDINGS = [
    "concat('img-', CAST(user_id % 13 AS STRING)) AS Target",
    "concat('CVE-2024-', CAST(event_id AS STRING)) AS VulnerabilityID",
    "concat('pkg', CAST(event_id % 40 AS STRING)) AS PkgName",
    "concat('1.', CAST(event_id % 9 AS STRING)) AS InstalledVersion",
    "CASE WHEN event_id % 3 = 0 THEN NULL ELSE concat('1.', CAST(event_id % 9 + 1 AS STRING)) END AS FixedVersion",
    "CASE WHEN value >= 150 THEN 'CRITICAL' WHEN value >= 60 THEN 'high' "
    "WHEN value >= 20 THEN 'MEDIUM' ELSE 'LOW' END AS Severity",
    "concat(event_type, ' issue') AS Title",
]

# Scan reports, one per event: two results, the second without a target in every fifth report; a result
# holds three findings, one or none (null), in an order that is not that of their ids.
_VULN = ("named_struct('VulnerabilityID', concat('CVE-', CAST({n} AS STRING), '-', CAST(event_id AS STRING)), 'PkgName', concat('pkg', CAST(event_id % 40 AS STRING)), "
         "'InstalledVersion', CASE WHEN event_id % 4 = 0 THEN NULL ELSE '1.0' END, 'FixedVersion', CASE WHEN event_id % 3 = 0 THEN NULL ELSE '1.1' END, "
         "'Severity', {s}, 'Title', concat(event_type, ' issue'))")
_LEVEL_OF_VALUE = "CASE WHEN value >= 150 THEN 'CRITICAL' WHEN value >= 60 THEN 'high' WHEN value >= 20 THEN 'MEDIUM' ELSE 'LOW' END"
_THREE = "array(" + ", ".join(_VULN.format(n=n, s=s) for n, s in ((2026, _LEVEL_OF_VALUE), (2024, "'HIGH'"), (2025, "CASE WHEN user_id % 2 = 0 THEN 'critical' END"))) + ")"
_ONE = "array(" + _VULN.format(n=2023, s=_LEVEL_OF_VALUE) + ")"
SCAN_REPORT = ("array(named_struct('Target', concat('img-', CAST(user_id % 13 AS STRING)), 'Vulnerabilities', CASE WHEN event_id % 2 = 0 THEN " + _THREE + " END), "
               "named_struct('Target', CASE WHEN event_id % 5 = 0 THEN NULL ELSE concat('base-', CAST(event_id % 7 AS STRING)) END, 'Vulnerabilities', " + _ONE + "))")


def scan_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested scan reports (column ``Results``), as the scanner's files hold them."""
    return table(spark, sf_dir, "events").selectExpr(f"{SCAN_REPORT} AS Results")


# container console logs: job executions "Job-Exec-<n>" and service replicas
_CONTAINER_LOGS = [
    "ts AS TimeGenerated",
    "concat(CASE WHEN event_id % 2 = 0 THEN 'Job-Exec-' ELSE 'svc-' END, CAST(user_id % 20 AS STRING)) "
    "AS ContainerGroupName_s",
    "concat(event_type, ' ', props) AS Log_s",
    "event_id",
]

_DERIVED = {
    "runs": ("events", _RUNS, None),
    "inputs": ("customer", _INPUTS, None),
    "model_versions_src": ("events", _VERSIONS, "event_type = 'purchase'"),
    "model_aliases": ("events", _ALIASES, "event_type = 'view'"),
    "findings": ("events", _FINDINGS, None),
    "container_logs": ("events", _CONTAINER_LOGS, None),
}

# JSON log lines as the service's formatter writes them; every 97th line is
# a plain-text traceback line (not JSON).
_LEVEL = ("CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' "
          "WHEN 'click' THEN 'DEBUG' ELSE 'INFO' END")
LOG_LINES_SPARK = (
    "CASE WHEN event_id % 97 = 0 THEN concat('Traceback (most recent call last): ', props) ELSE "
    "to_json(named_struct('timestamp', date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'\"), "
    f"'level', {_LEVEL}, 'logger', 'serving.api', 'message', concat('request ', event_type), "
    "'request_id', CAST(event_id AS STRING), 'method', 'POST', 'path', '/predict', "
    "'status_code', CASE WHEN event_type = 'error' THEN 500 ELSE 200 END, 'duration_ms', value, "
    "'client', concat('10.0.0.', CAST(user_id % 250 AS STRING)))) END AS value"
)
LOG_LINES_SQL = (
    "SELECT CASE WHEN event_id % 97 = 0 THEN concat('Traceback (most recent call last): ', props) ELSE "
    "CAST(json_object('timestamp', strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00'), "
    f"'level', {_LEVEL}, 'logger', 'serving.api', 'message', concat('request ', event_type), "
    "'request_id', CAST(event_id AS VARCHAR), 'method', 'POST', 'path', '/predict', "
    "'status_code', CASE WHEN event_type = 'error' THEN 500 ELSE 200 END, 'duration_ms', value, "
    "'client', concat('10.0.0.', CAST(user_id % 250 AS VARCHAR))) AS VARCHAR) END AS value FROM events"
)


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines (column ``value``) as a log file would hold them."""
    return table(spark, sf_dir, "events").selectExpr(LOG_LINES_SPARK)


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    src, exprs, where = _DERIVED[name]
    df = table(spark, sf_dir, src)
    if where:
        df = df.where(where)
    return df.selectExpr(*exprs)


def derived_sql(name: str) -> str:
    src, exprs, where = _DERIVED[name]
    sel = ", ".join(e.replace("AS STRING)", "AS VARCHAR)") for e in exprs)
    return f"SELECT {sel} FROM {src}" + (f" WHERE {where}" if where else "")


# A fixed ensemble for scoring: (tree, node, feature or none, threshold, left, right, value); tree -1 is the start.
# Values are multiples of 1/1024, so sums are exact.
FIXED_TREES = (
    (-1, 0, None, 0.0, -1, -1, -0.25),
    (0, 0, "WKHP", 84.5, 1, 2, 0.0), (0, 1, "SCHL", 12.0, 3, 4, 0.0), (0, 2, "STATE__CA", 0.5, 5, 6, 0.0),
    (0, 3, None, 0.0, -1, -1, -1.375), (0, 4, None, 0.0, -1, -1, -0.125), (0, 5, None, 0.0, -1, -1, 0.5625), (0, 6, None, 0.0, -1, -1, 1.75),
    (1, 0, "AGEP", 40.0, 1, 2, 0.0), (1, 1, None, 0.0, -1, -1, -0.4375), (1, 2, "YEAR", 2018.0, 3, 4, 0.0),
    (1, 3, None, 0.0, -1, -1, 0.28125), (1, 4, None, 0.0, -1, -1, -0.09375),
    (2, 0, None, 0.0, -1, -1, 0.0625),
)


# Run documents as other tools write them: training records name their run pipeline_run_id and nest metrics
# (flat or by split), cleaning records hold their transform metrics; some are cut off, empty or no objects.
_DOC_HEAD = "'{\"status\": \"COMPLETED\", \"raw_blob_name\": \"raw/u', CAST(user_id AS STRING), '.parquet\", \"started_at\": \"2024-01-01T00:00:00\", \"finished_at\": \"2024-01-01T00:00:10\", \"duration_seconds\": 10.5'"
RUN_DOCUMENTS = [
    "event_id",
    "CASE event_id % 10 WHEN 0 THEN '' WHEN 1 THEN concat(" + _DOC_HEAD + ", ', ') WHEN 2 THEN '[1, 2]' WHEN 3 THEN '{\"status\": \"FAILED\"}' "
    "WHEN 4 THEN concat(" + _DOC_HEAD + ", ', \"pipeline_run_id\": \"p', CAST(event_id AS STRING), '\", \"model_version\": \"3\", \"metrics\": {\"test\": {\"roc_auc\": 0.75}}}') "
    "WHEN 5 THEN concat(" + _DOC_HEAD + ", ', \"pipeline_run_id\": \"p', CAST(event_id AS STRING), '\", \"metrics\": {\"test_roc_auc\": 0.5}, \"clean_blob_name\": null}') "
    "WHEN 6 THEN NULL "
    "ELSE concat(" + _DOC_HEAD + ", ', \"clean_blob_name\": \"clean/u.parquet\", \"transform_metrics\": {\"output_rows\": ', CAST(event_id AS STRING), '}, \"unknown\": [1]}') END AS doc",
]
