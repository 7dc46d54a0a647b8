"""Cleaning (C1-C11).

``normalize`` (C1-C3) is a narrow projection. ``removal_reason`` attributes
each row to the FIRST rule it fails (C4-C8) in one ``CASE`` expression, so the
waterfall (C11) is a single aggregation instead of one pass per rule.
Duplicates (C9) are removed after the row rules over all remaining columns,
extras included, then the output is projected and cast (C10).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tabspark.contract import DataContract
from tabspark.functions.columns import any_null, lenient, normalize_code, sum_where

KEPT = "kept"
DUPLICATE = "duplicate"
NULLS = "null"
INVALID_CODE = "invalid_state"


def waterfall_reasons(contract: DataContract) -> list[str]:
    """Reasons in attribution order, then duplicates, then kept rows."""
    return [NULLS, INVALID_CODE] + [r.reason for r in contract.ranges] + [DUPLICATE, KEPT]


def normalize(df: DataFrame, contract: DataContract) -> DataFrame:
    """Drop optional columns, normalise the code column, lenient casts."""
    out = df.drop(*[c for c in contract.optional_columns if c in df.columns])
    casts = {}
    for name, type_name in contract.columns:
        if name not in out.columns:
            continue
        if name == contract.code_column:
            casts[name] = normalize_code(name)
        else:
            casts[name] = lenient(name, type_name)
    return out.withColumns(casts)


def removal_reason(contract: DataContract) -> Column:
    """First failing rule of a normalised row, null when the row passes C4-C8."""
    expr = F.when(any_null(contract.required), F.lit(NULLS))
    expr = expr.when(~F.col(contract.code_column).rlike(contract.code_pattern), F.lit(INVALID_CODE))
    for rule in contract.ranges:
        c = F.col(rule.column)
        expr = expr.when((c < F.lit(rule.low)) | (c > F.lit(rule.high)), F.lit(rule.reason))
    return expr


def _project(df: DataFrame, contract: DataContract) -> DataFrame:
    cols = [c for c in contract.output_columns if c in contract.required or c in df.columns]
    return df.select(*[F.col(c).cast(contract.clean_type(c)).alias(c) if c in contract.required else F.col(c)
                       for c in cols])


def clean(df: DataFrame, contract: DataContract) -> DataFrame:
    """The clean frame (one shuffle, for the whole-row distinct)."""
    norm = normalize(df, contract)
    passing = norm.where(removal_reason(contract).isNull())
    return _project(passing.dropDuplicates(), contract)


def removal_waterfall(df: DataFrame, contract: DataContract) -> DataFrame:
    """C11: ``reason, rows`` for every rule, duplicates and kept rows.

    One grouped aggregation: failing rows collapse to one group per reason
    (their columns are blanked), passing rows group by all columns so that
    duplicates are counted exactly; then a global sum.
    """
    norm = normalize(df, contract)
    reason = removal_reason(contract)
    keyed = norm.select(
        *[F.when(reason.isNull(), F.col(c)).alias(c) for c in norm.columns],
        reason.alias("_reason"),
    )
    grouped = keyed.groupBy(*norm.columns, "_reason").agg(F.count(F.lit(1)).alias("_w"))
    w, r = F.col("_w"), F.col("_reason")
    aggs = [sum_where(r == x, w).alias(x) for x in waterfall_reasons(contract)[:-2]]
    aggs.append((sum_where(r.isNull(), w) - F.count(F.when(r.isNull(), 1))).alias(DUPLICATE))
    aggs.append(F.count(F.when(r.isNull(), 1)).alias(KEPT))
    wide = grouped.agg(*aggs)
    reasons = waterfall_reasons(contract)
    long = wide.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("step"), F.lit(x).alias("reason"), F.col(x).cast("long").alias("rows"))
        for i, x in enumerate(reasons)])).alias("s"))
    return long.select("s.step", "s.reason", "s.rows")


def _removal_aggregates(contract: DataContract) -> list[Column]:
    reason = F.col("_reason")
    aggs = [F.count(F.lit(1)).alias("input_rows"), F.count(F.when(reason.isNull(), 1)).alias("passing_rows")]
    return aggs + [F.count(F.when(reason == x, 1)).alias(x) for x in waterfall_reasons(contract)[:-2]]


def removal_counts(df: DataFrame, contract: DataContract, by: Sequence[str] = ()) -> DataFrame:
    """Per group of ``by`` (without: one row): input rows, passing rows and rows per removal reason. A map-side
    aggregate of its own, so a stage that runs twice cannot count twice, as an
    observation below the distinct's shuffle could."""
    return normalize(df, contract).withColumn("_reason", removal_reason(contract)).groupBy(*by).agg(*_removal_aggregates(contract))


def clean_observed(df: DataFrame, contract: DataContract) -> tuple[DataFrame, Observation, Observation]:
    """Clean frame plus two observations filled by whatever action writes it.

    ``before`` counts input rows and rows per removal reason, ``after`` counts
    output rows, so writing the clean table also yields the waterfall without
    a second scan (duplicates = passing - output).
    """
    before = Observation("clean_before")
    after = Observation("clean_after")
    tagged = normalize(df, contract).withColumn("_reason", removal_reason(contract))
    tagged = tagged.observe(before, *_removal_aggregates(contract))
    out = _project(tagged.where(F.col("_reason").isNull()).drop("_reason").dropDuplicates(), contract)
    out = out.observe(after, F.count(F.lit(1)).alias("output_rows"))
    return out, before, after


def transform_metrics(contract: DataContract, before: Observation, after: Observation) -> dict:
    """TransformMetrics from the two observations (after the action ran)."""
    return metrics_of(contract, before.get, int(after.get["output_rows"]))


def metrics_of(contract: DataContract, b: dict, output_rows: int, warnings: Sequence[str] = ()) -> dict:
    """TransformMetrics from the row of ``removal_counts``, the rows written and the validation's warnings."""
    m = {
        "input_rows": int(b["input_rows"]),
        "output_rows": output_rows,
        "duplicates_removed": int(b["passing_rows"]) - output_rows,
        "null_rows_removed": int(b[NULLS]),
        "invalid_state_rows_removed": int(b[INVALID_CODE]),
    }
    for rule in contract.ranges:
        m[f"{rule.reason}_rows_removed"] = int(b[rule.reason])
    m["rows_removed"] = m["input_rows"] - m["output_rows"]
    m["warnings"] = list(warnings)
    return m
