"""Rank within a group without putting a whole group in one task.

``row_number() over (partition by g order by t)`` sorts each group in one
task. ``rank_within`` uses Spark's distributed sort instead:

1. ``repartitionByRange`` on (group, order) -- a hot group is spread over
   many range partitions (boundaries come from a sample of the keys);
2. rows per (group, partition) are counted (small: groups x partitions) and
   turned into per-group offsets with a window over the partition index;
3. ``row_number`` runs per (group, partition), i.e. inside one range
   partition only, and the offset is added.

The range-partitioned rows (with their partition index) are written once to
the checkpoint folder: range bounds come from a sample seeded per execution,
so the count and the numbering must read the same partitioning.

Rows with identical (group, order) keys stay in one partition; they are
interchangeable for the numbering.

``top_per_group`` is the top-k form: a map-side partial limit per group, so
only ``k`` rows per group and task cross the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabspark.session import materialize


def rank_within(df: DataFrame, group: Sequence[str], order: Sequence[str], descending: bool = False,
                name: str = "rank", partitions: int | None = None) -> DataFrame:
    """``df`` plus a 1-based ``name`` column: position inside ``group`` by
    ``order`` (ascending, or descending when asked)."""
    group = list(group)
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    okeys = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    # range bounds come from a sample whose seed differs per execution, so the
    # partitioned rows are written once and both branches below read them
    ranged = materialize(df.repartitionByRange(n, *[F.col(c) for c in group], *okeys)
                         .withColumn("_rp", F.spark_partition_id()), "rank-ranges")
    counts = ranged.groupBy(*group, "_rp").agg(F.count(F.lit(1)).alias("_rn"))
    w = Window.partitionBy(*group).orderBy("_rp").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.withColumn("_off", F.sum("_rn").over(w) - F.col("_rn")).drop("_rn")
    inner = Window.partitionBy(*group, "_rp").orderBy(*okeys)
    out = ranged.join(offsets, on=[*group, "_rp"], how="inner")
    return out.withColumn(name, F.col("_off") + F.row_number().over(inner)).drop("_rp", "_off")


def top_per_group(df: DataFrame, group: str, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows per group with a ``rank`` column.

    ``row_number() ... <= k`` plans as a WindowGroupLimit that runs partially
    in every map task before the shuffle, so each task ships at most ``k`` rows
    per group and a hot group never reaches one task whole.
    """
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
