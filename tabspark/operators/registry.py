"""Model registry (L5-L7) as two small append-only tables.

``model_versions(model_name, version, run_id, created_at)`` and
``model_aliases(model_name, alias, version, set_at)``. Versions are numbered
per model in creation order; the current alias is the newest alias row.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspark.operators.ranking import rank_within
from tabspark.sources.io import append_files, claim


def register_versions(new: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Next version numbers per model (``max(existing) + rank``)."""
    ranked = rank_within(new, ["model_name"], ["created_at", "run_id"])
    if existing is not None:
        base = existing.groupBy("model_name").agg(F.max("version").alias("_base"))
        ranked = ranked.join(base, "model_name", "left")
    else:
        ranked = ranked.withColumn("_base", F.lit(None).cast("long"))
    return ranked.select("model_name", (F.coalesce("_base", F.lit(0)) + F.col("rank")).cast("long").alias("version"),
                         "run_id", "created_at")


def current_aliases(aliases: DataFrame) -> DataFrame:
    """The newest (model, alias) assignment."""
    last = aliases.groupBy("model_name", "alias").agg(
        F.max_by(F.struct("version", "set_at"), F.struct("set_at", "version")).alias("_a"))
    return last.select("model_name", "alias", F.col("_a.version").alias("version"), F.col("_a.set_at").alias("set_at"))


def resolve(requests: DataFrame, versions: DataFrame, aliases: DataFrame) -> DataFrame:
    """Per request ``(model_name, version?, alias)`` the resolved version,
    its run id and a status: ok, no_alias, missing_version, no_run_id.

    An explicit version wins over the alias.
    """
    cur = current_aliases(aliases).select("model_name", "alias", F.col("version").alias("_alias_version"))
    r = requests.join(cur, ["model_name", "alias"], "left")
    r = r.withColumn("_want", F.coalesce(F.col("version").cast("long"), F.col("_alias_version")))
    v = versions.select("model_name", F.col("version").alias("_want"), "run_id")
    r = r.join(v, ["model_name", "_want"], "left")
    status = (F.when(F.col("_want").isNull(), F.lit("no_alias"))
              .when(F.col("run_id").isNull(), F.lit("missing_version"))
              .when(F.length(F.trim("run_id")) == 0, F.lit("no_run_id"))
              .otherwise(F.lit("ok")))
    return r.select("model_name", "alias", F.col("_want").alias("version"), "run_id", status.alias("status"))


def register(spark, root: str, model_name: str, run_id: str, created_at) -> int:
    """L5 writer: append the next version of ``model_name`` to ``<root>/model_versions`` and return its
    number. Several writers may run at once: each claims its number before it writes the row."""
    path = f"{root.rstrip('/')}/model_versions"
    try:
        known = spark.read.parquet(path).where(F.col("model_name") == model_name).agg(F.max("version")).first()[0] or 0
    except Exception as exc:  # first registration: no table yet
        if not any(x in str(exc) for x in ("PATH_NOT_FOUND", "does not exist", "UNABLE_TO_INFER_SCHEMA")):
            raise
        known = 0
    version = claim(spark, f"{path}/_claims/{quote(model_name, safe='')}", known + 1)
    row = [(model_name, version, run_id, created_at)]
    append_files(spark.createDataFrame(row, "model_name string, version long, run_id string, created_at timestamp").coalesce(1), path)
    return version


def set_alias(spark, root: str, model_name: str, alias: str, version: int, set_at) -> None:
    """L6 writer: append an alias assignment; the newest one is current."""
    row = spark.createDataFrame([(model_name, alias, int(version), set_at)], "model_name string, alias string, version long, set_at timestamp")
    append_files(row.coalesce(1), f"{root.rstrip('/')}/model_aliases")
