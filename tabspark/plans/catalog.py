"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator group of the survey, each paired with its DuckDB oracle text in
``tabspark.plans.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.contract import CENSUS, CENSUS_NUMERIC_FEATURES, TrainingConfig
from tabspark.functions.columns import ts_lit
from tabspark.operators import alerts as al
from tabspark.operators import clean as cl
from tabspark.operators import evaluate as ev
from tabspark.operators import features as fe
from tabspark.operators import findings as fi
from tabspark.operators import gates as ga
from tabspark.operators import ledger as le
from tabspark.operators import lineage as ln
from tabspark.operators import registry as rg
from tabspark.operators import score as sc
from tabspark.operators import split as sp
from tabspark.operators import telemetry as te
from tabspark.operators import validate as va
from tabspark.operators.ensemble import LEAF, TABLE, Ensemble, joined_margins
from tabspark.operators.train import importance
from tabspark.plans import oracle
from tabspark.plans.training_job import fit_and_evaluate
from tabspark.session import materialize, materialize_observed, scratch_path
from tabspark.sources import fixtures as fx
from tabspark.sources import io as sio
from tabspark.sources import logs as lg
from tabspark.streaming import alerts as sa
from tabspark.streaming.ingest import start_ingest

CONTRACT = CENSUS.with_passthrough("k")
CFG = TrainingConfig()

Query = Callable[[SparkSession, str], DataFrame]


def q_clean_waterfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows removed per first failing rule, duplicates and kept rows."""
    return cl.removal_waterfall(fx.acs_raw(spark, sf_dir), CONTRACT)


def q_clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean frame (13 contract columns + key)."""
    return cl.clean(fx.acs_raw(spark, sf_dir), CONTRACT)


def q_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5-V6: null count and rate per required column against its limit."""
    return va.null_profile(va.rule_counts(fx.acs_raw(spark, sf_dir), CONTRACT), CONTRACT)


def q_duplicate_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7: whole-row duplicates over the raw frame."""
    return va.duplicate_summary(va.validation_counts(fx.acs_raw(spark, sf_dir), CONTRACT), CONTRACT)


def q_pattern_range_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invalid STATE codes and out-of-range year, age, hours."""
    return va.rule_violations(va.rule_counts(fx.acs_raw(spark, sf_dir), CONTRACT), CONTRACT)


def q_validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The validation report as columns (warnings, first fatal rule)."""
    return va.report_columns(va.validation_counts(fx.acs_raw(spark, sf_dir), CONTRACT), CONTRACT)


def q_column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2-V4: every declared or present column of a raw frame without SEX, with WKHP as text and a column more."""
    raw = fx.acs_raw(spark, sf_dir).drop("SEX").withColumns({"WKHP": F.col("WKHP").cast("string"), "note": F.nullif(F.col("k") % 5, F.lit(0))})
    return va.column_profile(raw, CONTRACT)


def q_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows at/above and below the income threshold."""
    return va.class_presence(fx.acs_raw(spark, sf_dir), "PINCP", CFG.target_income_threshold)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.label(cl.clean(fx.acs_raw(spark, sf_dir), CONTRACT), "PINCP", CFG.target_income_threshold)


def splitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, labelled, split rows. The clean frame is written once to the
    shared checkpoint folder (the split reads it three times), and so is the
    split table (downstream queries read it more than once)."""
    clean, seen = materialize_observed(labelled(spark, sf_dir), "clean", *sp.class_count_exprs("TARGET"))
    out = sp.split(clean, CFG.random_seed, CFG.fractions, "TARGET", key=["k"],
                   class_counts=sp.class_counts_from(seen))
    return materialize(out, "split")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split rows with a deterministic stand-in score (ties on purpose)."""
    return splitted(spark, sf_dir).select(
        "split", "TARGET", "k", (((F.col("k") * 7919) % 1000).cast("double") / 1000).alias("score"))


def q_label(spark, sf_dir):
    """Clean rows with the binary TARGET."""
    return labelled(spark, sf_dir)


def q_split_sizes(spark, sf_dir):
    """Rows per (split, class) of the exact stratified split."""
    return sp.split_sizes(splitted(spark, sf_dir))


def q_split_members(spark, sf_dir):
    """Split of every row."""
    return splitted(spark, sf_dir).select("k", "TARGET", "split")


def q_subset_members(spark, sf_dir):
    """The clean rows whose key is in a list of wanted keys (those of dear orders that cleaning kept)."""
    clean = materialize(labelled(spark, sf_dir), "clean")
    wanted = fx.table(spark, sf_dir, "orders").where("o_totalprice >= 200000").select(F.col("o_orderkey").alias("k"))
    return sp.subset_by_keys(clean, wanted.join(clean.select("k").distinct(), "k", "left_semi"), ["k"]).select("k", "TARGET")


def q_target_report(spark, sf_dir):
    """Class counts and the first problem of four frames: sound, with nulls, with a third class, of one class."""
    bad = (F.when((F.col("k") % 4 == 1) & (F.col("k") % 7 == 0), F.lit(None)).when((F.col("k") % 4 == 2) & (F.col("k") % 7 == 0), F.lit(2))
           .when(F.col("k") % 4 == 3, F.lit(1)).otherwise(F.col("TARGET")))
    return sp.target_report(labelled(spark, sf_dir).select((F.col("k") % 4).alias("frame"), bad.alias("TARGET")), "TARGET", ["frame"])


def q_clean_store(spark, sf_dir):
    """The raw frame with an index column as files, read, cleaned and published twice (first the rows
    of one half), and read back by the pointer with the schema stated."""
    root = scratch_path(spark, f"store-{uuid.uuid4().hex}")
    fx.acs_raw(spark, sf_dir).withColumn("__index_level_0__", F.col("k") * 2).write.parquet(f"{root}/raw/orders.parquet")
    clean = cl.clean(sio.read_raw(spark, f"{root}/raw/orders.parquet"), CONTRACT)
    sio.publish(clean.where("k % 2 = 0"), f"{root}/clean/orders.parquet")
    sio.publish(clean, f"{root}/clean/orders.parquet")
    return sio.read_clean(spark, f"{root}/clean/orders.parquet", clean.schema)


def q_head_batch(spark, sf_dir):
    """The first thousand raw rows by key as a batch file, read back."""
    path = sio.write_batch(fx.acs_raw(spark, sf_dir), scratch_path(spark, f"batch-{uuid.uuid4().hex}"), 1000, ["k"])
    return sio.read_raw(spark, path)


def q_vocabulary(spark, sf_dir):
    """STATE vocabulary of the training split."""
    train = splitted(spark, sf_dir).where(F.col("split") == "train")
    return fe.vocabulary_frame(train, "STATE")


def q_one_hot(spark, sf_dir):
    """Every encoded feature slot of every row (long form)."""
    data = splitted(spark, sf_dir)
    enc = fe.FeatureEncoder.fit(data.where(F.col("split") == "train"), CENSUS_NUMERIC_FEATURES, "STATE")
    return enc.long_form(data, keep=["k", "split"])


def q_sparse_vectors(spark, sf_dir):
    """The non-zero slots of every row's sparse vector."""
    data = splitted(spark, sf_dir)
    vocabulary = materialize(fe.vocabulary_frame(data.where(F.col("split") == "train"), "STATE"), "vocabulary")
    enc = fe.FeatureEncoder(tuple(CENSUS_NUMERIC_FEATURES), "STATE", ())
    vectors = enc.sparse(data, vocabulary, vocabulary.count(), keep=["k", "split"])
    slots = vectors.select("k", "split", F.posexplode(vector_to_array("features")).alias("feature_index", "value"))
    return slots.where(F.col("value") != 0)


def q_confusion_metrics(spark, sf_dir):
    """Confusion counts, precision, recall, F1, accuracy per split."""
    return ev.confusion(scored(spark, sf_dir), "TARGET", "score", ["split"], CFG.threshold)


def q_roc_auc_ap(spark, sf_dir):
    """Tie-aware ROC AUC and step-sum AP per split."""
    return ev.rank_metrics(scored(spark, sf_dir), "TARGET", "score", ["split"])


def _split_metrics(spark, sf_dir):
    return ev.binary_metrics(scored(spark, sf_dir), "TARGET", "score", ["split"], CFG.threshold)


def q_metrics_long(spark, sf_dir):
    """Flattened <split>_<metric> values."""
    return ev.metrics_long(_split_metrics(spark, sf_dir), "split")


def _request_perf(spark, sf_dir):
    return ev.latency_stats(fx.telemetry(spark, sf_dir, "requests"), "DurationMs")


def q_latency_percentiles(spark, sf_dir):
    """p50/p95/p99 and rows per second per request name."""
    return ev.latency_stats(fx.telemetry(spark, sf_dir, "requests"), "DurationMs", by=["Name"])


def q_gate_decision(spark, sf_dir):
    """Quality and performance gates and the skip reason."""
    return ga.gate(_split_metrics(spark, sf_dir), _request_perf(spark, sf_dir), CFG, "split",
                   registration_enabled=True)


def q_score_parity(spark, sf_dir):
    """M7: agreement of two scorers (float64 vs float32 scores)."""
    s = scored(spark, sf_dir)
    exported = s.select("k", F.col("score").cast("float").cast("double").alias("score"))
    return sc.score_parity(s.select("k", "score"), exported, "k")


AS_OF, LOOKBACK = fx.AS_OF, fx.LOOKBACK


def _tel(spark, sf_dir, name):
    return fx.telemetry(spark, sf_dir, name)


def q_request_health(spark, sf_dir):
    """Requests, failures, mean and p95 duration per hour."""
    return te.request_health(_tel(spark, sf_dir, "requests"), AS_OF, LOOKBACK)


def q_failed_requests(spark, sf_dir):
    """Failed requests per hour."""
    return te.failed_requests(_tel(spark, sf_dir, "requests"), AS_OF, LOOKBACK)


def q_slow_requests(spark, sf_dir):
    """p95 duration of successful requests per hour."""
    return te.slow_requests(_tel(spark, sf_dir, "requests"), AS_OF, LOOKBACK)


def _four(spark, sf_dir):
    return [_tel(spark, sf_dir, n) for n in ("requests", "dependencies", "traces", "exceptions")]


def q_correlated_ops(spark, sf_dir):
    """Latest request per operation with dependency, trace, exception rollups."""
    return te.correlated_operations(*_four(spark, sf_dir), AS_OF, LOOKBACK, tiebreak="event_id")


def q_failed_drilldown(spark, sf_dir):
    """T8 over failed requests only."""
    return te.failed_drilldown(*_four(spark, sf_dir), AS_OF, LOOKBACK, tiebreak="event_id")


def q_exceptions_hourly(spark, sf_dir):
    """Exceptions per hour."""
    return te.event_counts(_tel(spark, sf_dir, "exceptions"), AS_OF, "Exceptions", LOOKBACK)


def q_error_traces(spark, sf_dir):
    """Error-level traces per hour."""
    return te.event_counts(_tel(spark, sf_dir, "traces"), AS_OF, "ErrorTraces", LOOKBACK,
                           where=F.col("SeverityLevel") >= 3)


def q_custom_metrics(spark, sf_dir):
    """Mean and p95 of the panel metrics per name and hour."""
    return te.custom_metrics(_tel(spark, sf_dir, "metrics"), AS_OF, LOOKBACK)


def q_alerts_15m(spark, sf_dir):
    """Fired alert windows (batch)."""
    return al.evaluate_alerts(_tel(spark, sf_dir, "requests"), _tel(spark, sf_dir, "exceptions"),
                              _tel(spark, sf_dir, "metrics"))


def q_trace_search(spark, sf_dir):
    """Newest 10 traces mentioning the monitored messages."""
    return te.trace_search(_tel(spark, sf_dir, "traces"), AS_OF, LOOKBACK, tiebreak="event_id")


def q_run_log(spark, sf_dir):
    """Oldest 200 log lines of one job execution prefix."""
    return te.run_log(fx.derived(spark, sf_dir, "container_logs"), "job-exec-1", tiebreak="event_id")


def q_cohort_gate(spark, sf_dir):
    """Candidate vs baseline revision latency and error-rate gate."""
    return te.cohort_gate(_tel(spark, sf_dir, "requests"), "baseline", "candidate")


def q_log_levels(spark, sf_dir):
    """JSON log lines parsed and counted per level."""
    return lg.level_counts(lg.parse_logs(fx.log_lines(spark, sf_dir)))


def q_findings_rollup(spark, sf_dir):
    """HIGH/CRITICAL findings per target."""
    return fi.rollup(fx.derived(spark, sf_dir, "findings"))


def q_findings_listed(spark, sf_dir):
    """First five findings per target."""
    return fi.listed(fx.derived(spark, sf_dir, "findings"))


def q_findings_reports(spark, sf_dir):
    """Nested scan reports exploded; first five findings per target in report order."""
    return fi.listed(fi.flatten_reports(fx.scan_reports(spark, sf_dir)))


def q_latest_run(spark, sf_dir):
    """L2: current ledger record per (input, phase)."""
    return le.latest_runs(fx.derived(spark, sf_dir, "runs"))


def q_ledger_store(spark, sf_dir):
    """L1-L2: run records appended in three batches, their files compacted, the current record per (input, phase)."""
    path = scratch_path(spark, f"ledger-{uuid.uuid4().hex}")
    runs = fx.derived(spark, sf_dir, "runs")
    rows = runs.select(*[(F.col(f.name) if f.name in runs.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in le.RUN_SCHEMA.fields])
    for part in range(3):
        sio.append_files(rows.where(F.pmod(F.xxhash64("run_id"), F.lit(3)) == part), path)
    le.compact_runs(spark, path, files=1 + rows.count() // 5_000_000)
    return le.latest_runs(le.read_runs(spark, path)).select(*[F.col(f.name).cast(f.dataType) for f in runs.schema])


def q_latest_execution(spark, sf_dir):
    """Newest run, its status, and whether it is recent."""
    return le.latest_execution(fx.derived(spark, sf_dir, "runs"), ts_lit(AS_OF), "1 day")


def q_pending_inputs(spark, sf_dir):
    """L3: inputs without a COMPLETED cleaning record."""
    return le.pending_inputs(fx.derived(spark, sf_dir, "inputs"), fx.derived(spark, sf_dir, "runs"), "cleaning")


def _versions(spark, sf_dir):
    return rg.register_versions(fx.derived(spark, sf_dir, "model_versions_src"))


def q_run_documents(spark, sf_dir):
    """L2: run documents of two foreign shapes, and damaged ones, read into one table."""
    docs = fx.table(spark, sf_dir, "events").selectExpr(*fx.RUN_DOCUMENTS)
    return le.read_documents(docs, "doc", keep=["event_id"]).drop("payload")


def q_model_versions(spark, sf_dir):
    """Version numbers per model in creation order."""
    return _versions(spark, sf_dir)


def q_resolve_model(spark, sf_dir):
    """Alias resolution to a version and run id, with status."""
    aliases = fx.derived(spark, sf_dir, "model_aliases")
    requests = aliases.select("model_name", "alias").distinct().withColumn("version", F.lit(None).cast("long"))
    return rg.resolve(requests, _versions(spark, sf_dir), aliases)


def q_retention(spark, sf_dir):
    """Versions beyond the newest three per model, minus aliased ones."""
    versions = _versions(spark, sf_dir)
    protected = rg.current_aliases(fx.derived(spark, sf_dir, "model_aliases"))
    return le.retention(versions, "model_name", "created_at", "version", 3, protected)


def q_blob_keys(spark, sf_dir):
    """Clean and ledger keys derived from raw input keys."""
    names = fx.derived(spark, sf_dir, "runs").select("raw_blob_name").distinct()
    n = F.col("raw_blob_name")
    return names.select(n, sio.clean_blob_name(n).alias("clean_blob_name"),
                        sio.cleaning_ledger_name(n).alias("cleaning_ledger"),
                        sio.training_ledger_name(n).alias("training_ledger"))


def q_vector_check(spark, sf_dir):
    """M5: embedding length check against the first vector."""
    emb = fx.table(spark, sf_dir, "embeddings")
    good, bad = sc.check_vectors(emb, "embedding", key="vec_id")
    return (good.select("vec_id", "length", F.lit("ok").alias("status"))
            .unionByName(bad.select("vec_id", "length", "status")))


# larger steps and less patience than the job's own settings (0.05, 50 of 500), so that the query takes few rounds
TRAIN_EVAL_CFG = TrainingConfig(learning_rate=0.2, early_stopping_rounds=8, num_boost_round=60)


def q_train_eval(spark, sf_dir):
    """Split, encode, boost until validation AUC has not risen for eight rounds, evaluate
    (rows-only check; ``ensemble_scores`` checks encoder and scoring on fixed trees)."""
    clean, seen = materialize_observed(labelled(spark, sf_dir), "clean", *sp.class_count_exprs("TARGET"))
    out = fit_and_evaluate(clean, TRAIN_EVAL_CFG, CONTRACT, class_counts=sp.class_counts_from(seen))
    return out["metrics"]


def _encoded(spark, sf_dir):
    data = splitted(spark, sf_dir)
    enc = fe.FeatureEncoder.fit(data.where(F.col("split") == "train"), CENSUS_NUMERIC_FEATURES, "STATE")
    return enc, enc.transform(data, keep=["k", "split"], check=False)


def q_ensemble_scores(spark, sf_dir):
    """The encoder fitted on the training split applied to all splits, and a fixed ensemble's node
    table scored twice, over Arrow batches and by joins; both margins, the score and the prediction."""
    enc, encoded = _encoded(spark, sf_dir)
    rows = [(t, n, enc.feature_names.index(f) if f else LEAF, x, lo, hi, v) for t, n, f, x, lo, hi, v in fx.FIXED_TREES]
    nodes = spark.createDataFrame(rows, TABLE)
    depth = 3   # levels of the deepest fixed tree
    walked = sc.score(encoded, Ensemble.from_table(nodes), CFG.threshold, "fixed-1", keep=["k", "split", "margin"])
    joined = joined_margins(encoded.select("k", vector_to_array("features").alias("x")), nodes, ["k"], "x", depth)
    # both sides hold every row: encoded files are small for their rows, and would be broadcast by their size
    both = walked.join(joined.withColumnRenamed("margin", "joined_margin").hint("merge"), "k")
    return both.withColumn("score", F.round("score", 9))


def q_feature_importance(spark, sf_dir):
    """M8: the fifty largest gains of the ensemble trained with the job's own settings (rows-only check)."""
    clean, seen = materialize_observed(labelled(spark, sf_dir), "clean", *sp.class_count_exprs("TARGET"))
    out = fit_and_evaluate(clean, CFG, CONTRACT, class_counts=sp.class_counts_from(seen))
    return importance(spark, out["trained"].model, out["encoder"].feature_names)


def q_table_digest(spark, sf_dir):
    """Rows and content digest of the document table, independent of files and order."""
    return ln.table_digest(fx.table(spark, sf_dir, "documents"), ["doc_id", "text", "lang", "source", "n_chars"])


def q_ingest_stream(spark, sf_dir):
    """The whole raw frame lands as 24 parquet files, and one more for each million orders (by ``k``
    modulo their number: every row in exactly one file, exact copies together); the feed cleans up to ten a
    micro-batch and the ledger holds one COMPLETED record per file with its clean row count."""
    root = scratch_path(spark, f"ingest-{uuid.uuid4().hex}")
    raw = fx.acs_raw(spark, sf_dir)
    parts = 24 + fx.table(spark, sf_dir, "orders").count() // 1_000_000
    landing = f"{root}/raw/monthly"
    raw.withColumn("part", F.col("k") % parts).repartitionByRange(parts, "part").write.partitionBy("part").parquet(landing)
    q = start_ingest(spark, landing, raw.schema, f"{root}/clean", f"{root}/ledger", f"{root}/_stream",
                     contract=CONTRACT, files_per_trigger=10)
    q.awaitTermination()
    runs = le.read_runs(spark, f"{root}/ledger")
    return runs.select("status", F.get_json_object("payload", "$.transform_metrics.output_rows")
                       .cast("long").alias("output_rows"))


def q_alerts_append(spark, sf_dir):
    """T13-T16 in append mode with bounded state: the events arrive in three slices of ten days, a
    37th of them two slices late; fired windows go to files once the watermark has passed them, rows that come
    later are dropped, and the p95 is read from a histogram kept in the stream's state."""
    root = scratch_path(spark, f"alerts-{uuid.uuid4().hex}")
    landed = fx.table(spark, sf_dir, "events").withColumn("_slice", F.expr(fx.ARRIVAL_SLICE))
    kind = landed.drop("_slice").schema
    files = 8
    for k in range(fx.ARRIVAL_SLICES):   # the file source takes files in the order of their times
        landed.where(F.col("_slice") == k).drop("_slice").repartition(files).write.mode("append").parquet(f"{root}/events")
    events = spark.readStream.schema(kind).option("maxFilesPerTrigger", files).parquet(f"{root}/events")
    views = {n: fx.view_of(events, n) for n in ("requests", "exceptions", "metrics")}
    qs = sa.start_alerts(sa.rule_streams(views["requests"], views["exceptions"], views["metrics"], histogram=True), f"{root}/sink", f"{root}/_stream")
    for q in qs:
        q.awaitTermination()
    out = [sa.read_alerts(spark, f"{root}/sink", rule) for rule in sa.al.RULES]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


def q_alerts_stream(spark, sf_dir):
    """T13-T16 on a stream over the events table (complete mode, memory sink)."""
    ev_schema = fx.table(spark, sf_dir, "events").schema
    events = (spark.readStream.schema(ev_schema).option("pathGlobFilter", "events.parquet")
              .parquet(sf_dir.rstrip("/")))
    views = {n: events.where(fx._VIEWS[n][1]).selectExpr(*fx._VIEWS[n][0]) if fx._VIEWS[n][1]
             else events.selectExpr(*fx._VIEWS[n][0]) for n in ("requests", "exceptions", "metrics")}
    prefix = f"alerts_{uuid.uuid4().hex[:8]}_"
    root = scratch_path(spark, prefix.rstrip("_"))
    qs = sa.start_alerts(sa.rule_streams(views["requests"], views["exceptions"], views["metrics"]),
                         f"{root}/sink", f"{root}/_stream", output_mode="complete", name_prefix=prefix)
    for q in qs:
        q.awaitTermination()
    out = None
    for rule in sa.al.RULES:
        t = spark.table(f"{prefix}{rule}")
        out = t if out is None else out.unionByName(t)
    return out


QUERIES: dict[str, Query] = {
    "clean_waterfall": q_clean_waterfall,
    "clean_rows": q_clean_rows,
    "clean_store": q_clean_store,
    "head_batch": q_head_batch,
    "null_profile": q_null_profile,
    "duplicate_rate": q_duplicate_rate,
    "pattern_range_violations": q_pattern_range_violations,
    "class_counts": q_class_counts,
    "column_profile": q_column_profile,
    "validation_report": q_validation_report,
    "label": q_label,
    "split_sizes": q_split_sizes,
    "split_members": q_split_members,
    "subset_members": q_subset_members,
    "target_report": q_target_report,
    "vocabulary": q_vocabulary,
    "one_hot": q_one_hot,
    "sparse_vectors": q_sparse_vectors,
    "confusion_metrics": q_confusion_metrics,
    "roc_auc_ap": q_roc_auc_ap,
    "metrics_long": q_metrics_long,
    "latency_percentiles": q_latency_percentiles,
    "gate_decision": q_gate_decision,
    "score_parity": q_score_parity,
    "request_health": q_request_health,
    "failed_requests": q_failed_requests,
    "slow_requests": q_slow_requests,
    "correlated_ops": q_correlated_ops,
    "failed_drilldown": q_failed_drilldown,
    "exceptions_hourly": q_exceptions_hourly,
    "error_traces": q_error_traces,
    "custom_metrics": q_custom_metrics,
    "alerts_15m": q_alerts_15m,
    "trace_search": q_trace_search,
    "run_log": q_run_log,
    "cohort_gate": q_cohort_gate,
    "log_levels": q_log_levels,
    "findings_rollup": q_findings_rollup,
    "findings_listed": q_findings_listed,
    "findings_reports": q_findings_reports,
    "latest_run": q_latest_run,
    "ledger_store": q_ledger_store,
    "latest_execution": q_latest_execution,
    "pending_inputs": q_pending_inputs,
    "model_versions": q_model_versions,
    "run_documents": q_run_documents,
    "resolve_model": q_resolve_model,
    "retention": q_retention,
    "blob_keys": q_blob_keys,
    "vector_check": q_vector_check,
    "train_eval": q_train_eval,
    "feature_importance": q_feature_importance,
    "ensemble_scores": q_ensemble_scores,
    "table_digest": q_table_digest,
    "ingest_stream": q_ingest_stream,
    "alerts_stream": q_alerts_stream,
    "alerts_append": q_alerts_append,
}

ORACLE: dict[str, str] = {
    "clean_waterfall": oracle.clean_waterfall(),
    "clean_rows": oracle.clean_rows(),
    "clean_store": oracle.clean_store(),
    "head_batch": oracle.head_batch(),
    "null_profile": oracle.null_profile(),
    "duplicate_rate": oracle.duplicate_rate(),
    "pattern_range_violations": oracle.pattern_range_violations(),
    "class_counts": oracle.class_counts(),
    "column_profile": oracle.column_profile(),
    "validation_report": oracle.validation_report(),
    "label": oracle.label(),
    "split_sizes": oracle.split_sizes(),
    "split_members": oracle.split_members(),
    "subset_members": oracle.subset_members(),
    "target_report": oracle.target_report(),
    "vocabulary": oracle.vocabulary(),
    "one_hot": oracle.one_hot(),
    "sparse_vectors": oracle.sparse_vectors(),
    "confusion_metrics": oracle.confusion_metrics(),
    "roc_auc_ap": oracle.roc_auc_ap(),
    "metrics_long": oracle.metrics_long(),
    "latency_percentiles": oracle.latency_percentiles(),
    "gate_decision": oracle.gate_decision(),
    "score_parity": oracle.score_parity(),
    "request_health": oracle.request_health(),
    "failed_requests": oracle.failed_requests(),
    "slow_requests": oracle.slow_requests(),
    "correlated_ops": oracle.correlated_ops(),
    "failed_drilldown": oracle.failed_drilldown(),
    "exceptions_hourly": oracle.exceptions_hourly(),
    "error_traces": oracle.error_traces(),
    "custom_metrics": oracle.custom_metrics(),
    "alerts_15m": oracle.alerts_15m(),
    "alerts_stream": oracle.alerts_15m(),
    "alerts_append": oracle.alerts_append(),
    "ingest_stream": oracle.ingest_stream(),
    "trace_search": oracle.trace_search(),
    "run_log": oracle.run_log(),
    "cohort_gate": oracle.cohort_gate(),
    "log_levels": oracle.log_levels(),
    "findings_rollup": oracle.findings_rollup(),
    "findings_listed": oracle.findings_listed(),
    "findings_reports": oracle.findings_reports(),
    "latest_run": oracle.latest_run(),
    "ledger_store": oracle.ledger_store(),
    "latest_execution": oracle.latest_execution(),
    "pending_inputs": oracle.pending_inputs(),
    "model_versions": oracle.model_versions(),
    "run_documents": oracle.run_documents(),
    "resolve_model": oracle.resolve_model(),
    "retention": oracle.retention(),
    "blob_keys": oracle.blob_keys(),
    "vector_check": oracle.vector_check(),
    "ensemble_scores": oracle.ensemble_scores(),
    "table_digest": oracle.table_digest(),
}
