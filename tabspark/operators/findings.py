"""Scan-findings rollup (T21): HIGH/CRITICAL findings per target.

Reports are nested (``Results[] -> Vulnerabilities[]``); ``flatten_reports``
explodes them, ``rollup`` counts per target and severity and lists the first
five findings per target (skew-safe top-k) with the number not listed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspark.functions.columns import count_where
from tabspark.operators.ranking import top_per_group

# Severities that fail the policy, in report order, and the
# number of findings listed per target.
POLICY = ("CRITICAL", "HIGH")
LISTED = 5


def flatten_reports(reports: DataFrame) -> DataFrame:
    """One row per vulnerability; targets without any keep one null row."""
    r = reports.select(F.posexplode_outer("Results").alias("result_position", "r"))
    r = r.select(F.coalesce(F.col("r.Target"), F.lit("unknown")).alias("Target"), "result_position",
                 F.posexplode_outer("r.Vulnerabilities").alias("position", "v"))
    return r.select("Target", "v.VulnerabilityID", "v.PkgName", "v.InstalledVersion",
                    "v.FixedVersion", "v.Severity", "v.Title", "result_position", "position")


def policy_findings(flat: DataFrame) -> DataFrame:
    sev = F.upper(F.coalesce(F.col("Severity"), F.lit("")))
    return flat.withColumn("Severity", sev).where(sev.isin(*POLICY))


def rollup(flat: DataFrame) -> DataFrame:
    """Per target: findings, critical, high, listed, remaining; ``failed`` when any."""
    f = policy_findings(flat)
    out = f.groupBy("Target").agg(
        F.count(F.lit(1)).alias("findings"),
        count_where(F.col("Severity") == "CRITICAL").alias("critical"),
        count_where(F.col("Severity") == "HIGH").alias("high"))
    return out.select("Target", "findings", "critical", "high",
                      F.least(F.col("findings"), F.lit(LISTED)).alias("listed"),
                      F.greatest(F.col("findings") - LISTED, F.lit(0)).alias("remaining"),
                      (F.col("findings") > 0).alias("failed"))


def listed(flat: DataFrame) -> DataFrame:
    """The first five findings per target: in report order where ``flat`` has positions (as
    ``flatten_reports`` gives them), else by vulnerability id."""
    order = [c for c in ("result_position", "position") if c in flat.columns] + ["VulnerabilityID"]
    f = policy_findings(flat).select(
        "Target", F.coalesce("VulnerabilityID", F.lit("unknown")).alias("VulnerabilityID"),
        F.coalesce("PkgName", F.lit("unknown")).alias("PkgName"),
        F.coalesce("InstalledVersion", F.lit("?")).alias("InstalledVersion"),
        F.coalesce("FixedVersion", F.lit("unfixed")).alias("FixedVersion"), "Severity",
        *[F.coalesce("Title", F.lit("")).alias("Title")] * ("result_position" in order), *order[:-1])
    return top_per_group(f, "Target", [F.col(c).asc() for c in order], LISTED).drop(*order[:-1])
