"""A fitted tree ensemble as a table, and its scores (M3, M4).

``Ensemble`` holds the nodes of all trees. ``table`` is its relational form, one row per node, which can be
stored, compared and scored anywhere; ``from_table`` reads it back. Two scorers give the same margins:

* ``Ensemble.transform`` walks all trees over Arrow batches. Only the features that a split asks for leave
  the JVM, so a wide vector costs no more than a narrow one.
* ``joined_margins`` walks the node table by joins, a level at a time: plain relational steps.

A row goes left where its feature is at most the threshold. The margin is the start plus the reached leaves;
the probability is its logistic function. A null vector has a null margin, probability and prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEAF = -1
TABLE = "tree int, node int, feature int, threshold double, left int, right int, value double"


@dataclass(frozen=True)
class Node:
    """A split (feature, threshold, left, right) or, with feature LEAF, a value to add."""

    feature: int = LEAF
    threshold: float = 0.0
    left: int = LEAF
    right: int = LEAF
    value: float = 0.0


@dataclass(frozen=True)
class Ensemble:
    trees: tuple[tuple[Node, ...], ...]
    start: float = 0.0
    importances: tuple[float, ...] = field(default=(), compare=False)

    @property
    def numTrees(self) -> int:  # noqa: N802  the name that Spark ML's models use
        return len(self.trees)

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802
        total = sum(self.importances)
        return DenseVector([v / total if total else 0.0 for v in self.importances])

    def first(self, trees: int) -> Ensemble:
        """The ensemble of the first trees."""
        return Ensemble(self.trees[:trees], self.start, self.importances)

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per node; tree -1 holds the start as its only leaf."""
        rows = [(-1, 0, LEAF, 0.0, LEAF, LEAF, float(self.start))]
        rows += [(t, k, n.feature, n.threshold, n.left, n.right, n.value) for t, tree in enumerate(self.trees) for k, n in enumerate(tree)]
        return spark.createDataFrame(rows, TABLE)

    @classmethod
    def from_table(cls, nodes: DataFrame) -> Ensemble:
        trees: dict[int, dict[int, Node]] = {}
        for r in nodes.select("tree", "node", "feature", "threshold", "left", "right", "value").collect():  # as large as a model
            trees.setdefault(r["tree"], {})[r["node"]] = Node(*r[2:])
        start = trees.pop(-1)[0].value if -1 in trees else 0.0
        return cls(tuple(tuple(tree[k] for k in range(len(tree))) for _, tree in sorted(trees.items())), start)

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """``df`` with margin, probability (vector of two) and prediction (0 or 1)."""
        used = sorted({n.feature for tree in self.trees for n in tree if n.feature != LEAF})
        place = {f: k for k, f in enumerate(used)}
        flat = [tuple(np.array(c) for c in zip(*[(place.get(n.feature, LEAF), n.threshold, n.left, n.right, n.value) for n in tree], strict=True)) for tree in self.trees]
        start = float(self.start)

        @F.pandas_udf("double")
        def margin(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(margins(batch, flat, start, len(used)), index=batch.index)

        kind = df.schema[features].dataType.simpleString()
        values = F.col(features).cast("array<double>") if kind.startswith("array") else vector_to_array(features)
        picked = F.transform(F.array(*[F.lit(f) for f in used]).cast("array<int>"), lambda f: F.get(values, f))
        out = df.withColumn("margin", margin(F.when(F.col(features).isNotNull(), picked)))
        p = 1.0 / (1.0 + F.exp(-F.col("margin")))
        known = F.col("margin").isNotNull()
        return out.withColumns({"probability": F.when(known, array_to_vector(F.array(1.0 - p, p))), "prediction": F.when(known, (p >= 0.5).cast("double"))})


def margins(rows: pd.Series, trees: list[tuple[np.ndarray, ...]], start: float, width: int) -> np.ndarray:
    """Margin of each row of picked features (null: NaN, which Arrow hands on as null)."""
    given = rows.notna().to_numpy()
    x = np.array([np.asarray(v, np.float64) for v in rows[given]], np.float64).reshape(int(given.sum()), width)
    if not width:  # no split anywhere
        x, width = np.zeros((len(x), 1)), 1
    total, flat, first = np.full(len(x), start), x.reshape(-1), np.arange(len(x)) * width
    for feature, threshold, left, right, value in trees:
        leaf, places = feature == LEAF, np.arange(len(feature))
        column, below = np.where(leaf, 0, feature), np.stack([np.where(leaf, places, right), np.where(leaf, places, left)], 1)
        at, there = np.zeros(len(x), np.int64), np.zeros(1, np.int64)
        below, kids = below.reshape(-1), below
        while not leaf[there].all():  # a level down; rows at a leaf stay
            at = below.take(2 * at + (flat.take(first + column.take(at)) <= threshold.take(at)))
            there = np.unique(kids[there])
        total += value.take(at)
    out = np.full(len(rows), np.nan)
    out[given] = total
    return out


def joined_margins(df: DataFrame, nodes: DataFrame, key: list[str], values: str, depth: int) -> DataFrame:
    """Per row of ``key`` its margin, by joins: every row stands at the root of every tree, and goes down one
    level a join until no split is left; ``depth`` is the deepest tree's number of levels. ``values`` is the
    array of features. The nodes, as large as a model, are broadcast: rows stay where they are until their
    leaves are summed by key. The sum is taken in fixed point, so it is the same in any order."""
    trees = nodes.select("tree").distinct().agg(F.sort_array(F.collect_list("tree")).alias("t")).first()["t"]
    at = df.select(*key, F.col(values).alias("_x"), F.explode(F.array(*map(F.lit, trees))).alias("tree"), F.lit(0).alias("node"))
    for _ in range(depth):
        here = at.join(F.broadcast(nodes.drop("value")), ["tree", "node"])
        below = F.get("_x", F.col("feature")) <= F.col("threshold")
        step = F.when(F.col("feature") == LEAF, F.col("node")).when(below, F.col("left")).otherwise(F.col("right"))
        at = here.select(*key, "_x", "tree", step.alias("node"))
    leaves = at.join(F.broadcast(nodes.select("tree", "node", "value")), ["tree", "node"])
    return leaves.groupBy(*key).agg(F.sum(F.col("value").cast("decimal(30,15)")).cast("double").alias("margin"))
