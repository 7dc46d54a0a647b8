"""Streaming alert rules (T13-T16): the batch rule functions on a stream.

Event time is cast to ``timestamp`` (watermarks reject ``timestamp_ntz``);
each rule is its own streaming aggregation with a watermark, writing fired
windows in append mode once the watermark passes the window end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabspark.operators import alerts as al

TS = al.TS


def with_event_time(df: DataFrame, delay: str) -> DataFrame:
    return df.withColumn(TS, F.col(TS).cast("timestamp")).withWatermark(TS, delay)


def rule_streams(requests: DataFrame, exceptions: DataFrame, metrics: DataFrame,
                 delay: str = "15 minutes", window: str = al.WINDOW, exact_p95: bool = True,
                 histogram: bool = False) -> dict[str, DataFrame]:
    """One streaming DataFrame per rule (alert, window_start, value, fired).

    ``exact_p95=False`` bounds the p95 rule's state with a sketch, ``histogram=True`` (append mode only) with
    a histogram. Each rule has the watermark of its own rows: the newest of them in earlier micro-batches less
    ``delay``. A window is written, and leaves the state, once the watermark has passed its end; a row is
    dropped if its window had ended by the watermark that the micro-batch before ran with.
    """
    r = with_event_time(requests, delay)
    streams = {
        al.RULES[0]: al.request_failures(r, window),
        al.RULES[1]: al.slow_requests(r, window, streaming=True, exact=exact_p95, histogram=histogram),
        al.RULES[2]: al.exceptions(with_event_time(exceptions, delay), window),
        al.RULES[3]: al.validation_failures(with_event_time(metrics, delay), window),
    }
    # back to wall-clock time, the type the batch rules return
    return {k: v.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")) for k, v in streams.items()}


def start_alerts(streams: dict[str, DataFrame], sink_root: str, checkpoint_root: str,
                 available_now: bool = True, output_mode: str = "append",
                 name_prefix: str = "") -> list[StreamingQuery]:
    """Write fired windows of every rule to ``<sink_root>/<rule>`` (parquet,
    append mode) or, in complete mode, to in-memory tables ``<prefix><rule>``."""
    queries = []
    for rule, df in streams.items():
        fired = df.where(F.col("fired"))
        w = (fired.writeStream.outputMode(output_mode)
             .option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/{rule}"))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
        if output_mode == "append":
            queries.append(w.format("parquet").option("path", f"{sink_root.rstrip('/')}/{rule}").start())
        else:
            queries.append(w.format("memory").queryName(f"{name_prefix}{rule}").start())
    return queries


ALERT_SCHEMA = "alert string, window_start timestamp_ntz, value double, fired boolean"


def read_alerts(spark: SparkSession, sink_root: str, rule: str) -> DataFrame:
    """What the append-mode stream of a rule has written; the sink's own log says which files count."""
    return spark.read.schema(ALERT_SCHEMA).parquet(f"{sink_root.rstrip('/')}/{rule}")
