"""Boosted-tree training with patience on validation AUC (M1, M2, M8).

The booster is gradient boosting of the logistic loss over Spark ML trees. A round fits one regression tree to
the Newton targets of the rows, (label - p) / (p (1 - p)) with weight p (1 - p), so a leaf's mean is its
Newton step; the rows' margins grow by the learning rate times that step. Leaves map to the depth that holds
them, feature fraction to the features tried per node, bagging to the rows sampled per round.

Features are binned once, and trees grow over blocks of binned rows (``operators.histogram``). An input of one
task is boosted in that task; a larger one is dealt evenly, its blocks are kept by the executors with the
margins of the last round, and a level of a tree is one job.

Rounds run in blocks too. A block of rounds starts from the margins that the one before it wrote to the shared
checkpoint folder, so the plan never grows with the number of rounds and a lost executor repeats KEPT rounds
at most. After it, the validation margins of all its rounds are ranked in one job, and each round's ROC AUC goes
to ``Patience``: training ends once ``early_stopping_rounds`` rounds in a row brought no better AUC, or after
``num_boost_round`` rounds. The ensemble is cut to the best round; nothing is fitted twice.

Scores will not equal the reference's booster; the interface, the stopping rule, guards and metrics are kept.
"""

from __future__ import annotations

import math
import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabspark.contract import TrainingConfig
from tabspark.operators import histogram as hi
from tabspark.operators.ensemble import Ensemble, Node
from tabspark.operators.evaluate import binary_label
from tabspark.session import materialize

BLOCK = 20  # rounds between two writes of the margins
KEPT = 20  # rounds between two dealings of the rows into blocks
ROWS_PER_TASK = 1_000_000  # a round over them takes less than the jobs of a round's levels
RANKED_PER_TASK = 250_000  # validation rows, of each round of a block
WIDE = 64  # tasks whose sums go to the driver directly; of more, they are added by tasks first
BINNED = "_cells binary, _y tinyint, _margin double, _row long"


@dataclass(frozen=True)
class TrainedModel:
    model: Ensemble
    best_iteration: int | None
    trees: int
    rounds: int = 0
    history: tuple[float, ...] = ()


def option(cfg: TrainingConfig, *names: str, default=None):
    """First of the names that the config has as a field, or in ``extra``, with a value."""
    for name in names:
        value = getattr(cfg, name, None)
        value = cfg.extra.get(name) if value is None or name in cfg.extra else value
        if value is not None:
            return value
    return default


def depth_for_leaves(num_leaves: int) -> int:
    """Smallest depth whose full tree has at least ``num_leaves`` leaves."""
    return max(1, math.ceil(math.log2(max(num_leaves, 2))))


@dataclass(frozen=True)
class Settings:
    """M1: what the booster takes from the config; names given in ``extra`` win over the field they stand for."""

    rounds: int
    rate: float
    depth: int
    feature_fraction: float
    row_fraction: float
    min_rows: int
    min_gain: float
    seed: int
    patience: int


def settings(cfg: TrainingConfig) -> Settings:
    depth = int(option(cfg, "max_depth", default=-1))
    every = int(option(cfg, "subsample_freq", "bagging_freq", default=0))
    return Settings(
        rounds=int(option(cfg, "n_estimators", "num_boost_round", default=100)),
        rate=float(option(cfg, "learning_rate", default=0.1)),
        depth=min(x for x in (depth_for_leaves(int(option(cfg, "num_leaves", default=31))), depth) if x > 0),
        feature_fraction=float(option(cfg, "colsample_bytree", "feature_fraction", default=1.0)),
        row_fraction=float(option(cfg, "subsample", "bagging_fraction", default=1.0)) if every > 0 else 1.0,
        min_rows=int(option(cfg, "min_child_samples", "min_data_in_leaf", default=20)),
        min_gain=float(option(cfg, "min_split_gain", default=0.0)),
        seed=int(option(cfg, "random_state", "random_seed", default=42)),
        patience=int(cfg.early_stopping_rounds),
    )


class Patience:
    """Keeps the first round with the highest value; exhausted after ``rounds`` rounds without a higher one."""

    def __init__(self, rounds: int) -> None:
        self.rounds, self.seen, self.best, self.best_value = rounds, 0, 0, -math.inf

    def add(self, value: float) -> bool:
        """Takes the next round's value; whether to go on."""
        self.seen += 1
        if value > self.best_value:
            self.best, self.best_value = self.seen, value
        return self.seen - self.best < self.rounds


def build_tree(s: Settings, round_: int, features: str = "features") -> RandomForestRegressor:
    """M1: Spark's learner of one round, a single tree over (features, _target, _weight); ``histogram.grow`` makes
    the same splits."""
    return RandomForestRegressor(
        featuresCol=features, labelCol="_target", weightCol="_weight", numTrees=1, bootstrap=False, maxDepth=s.depth,
        featureSubsetStrategy=str(s.feature_fraction) if s.feature_fraction < 1 else "all", minInstancesPerNode=s.min_rows, minInfoGain=s.min_gain, seed=s.seed + round_)


_SPLIT = re.compile(r"\s*If \(feature (\d+) <= (\S+)\)")


def tree_nodes(debug: str, rate: float) -> tuple[Node, ...]:
    """Nodes of a fitted tree from its printed form, leaves scaled by the learning rate; the root is 0."""
    lines = [x for x in debug.splitlines() if re.match(r"\s*(If|Else|Predict)", x)]
    nodes: list[Node | None] = []

    def take() -> int:
        line, here = lines.pop(0), len(nodes)
        nodes.append(None)
        if "Predict:" in line:
            nodes[here] = Node(value=rate * float(line.split("Predict:")[1]))
            return here
        feature, threshold = _SPLIT.match(line).groups()
        left = take()
        lines.pop(0)  # Else
        nodes[here] = Node(int(feature), float(threshold), left, take())
        return here

    take()
    return tuple(nodes)


def _input(train_df: DataFrame, validation_df: DataFrame, features: str, label: str, patience: int) -> None:
    if patience < 1:
        raise ValueError("early_stopping_rounds must be at least 1")
    for name, df in (("train", train_df), ("validation", validation_df)):
        missing = [c for c in (features, label) if c not in df.columns]
        if missing:
            raise ValueError(f"{name} split is missing columns: {', '.join(missing)}")
        if df.isEmpty():
            raise ValueError(f"{name} split must not be empty")


def reduced(parts: RDD, add):
    """The parts added up: on the driver, or by tasks first where they are many."""
    return parts.reduce(add) if parts.getNumPartitions() <= WIDE else parts.treeReduce(add, 2)


def layout_of(df: DataFrame, features: str) -> hi.Layout:
    """Bins of every feature over all rows, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"found": [pickle.dumps(hi.values_of(batches))]})

    found = df.select(_array(df, features)).mapInArrow(run, "found binary").rdd.map(lambda r: pickle.loads(r[0]))
    return hi.Layout.of([hi.thresholds(v.counted()) for v in reduced(found, hi.merge_values)])


def _array(df: DataFrame, features: str) -> Column:
    given = df.schema[features].dataType.simpleString().startswith("array")
    return (F.col(features).cast("array<double>") if given else vector_to_array(features)).alias("_x")


def binned(df: DataFrame, features: str, y: Column, start: float, layout: hi.Layout) -> DataFrame:
    """Rows as their cells, with label, first margin and number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([hi.packed_cells(layout.cells(hi.matrix(b.column(0)))), *b.columns[1:]], ["_cells", "_y", "_margin", "_row"])

    return df.select(_array(df, features), y.cast("tinyint").alias("_y"), F.lit(start).alias("_margin"), F.monotonically_increasing_id().alias("_row")).mapInArrow(run, BINNED)


def walked(rows: DataFrame, trees: list[hi.Tree], layout: hi.Layout, rate: float) -> DataFrame:
    """Binned rows with their margins grown by the trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in hi.blocks(batches):
            for _, b.margin in margins_after(b, trees, layout, rate):
                pass
            yield pa.RecordBatch.from_arrays([hi.packed_cells(b.cells), pa.array(b.y), pa.array(b.margin), pa.array(b.row)], ["_cells", "_y", "_margin", "_row"])

    return rows.mapInArrow(run, BINNED) if trees else rows


def margins_after(b: hi.Block, trees: list[hi.Tree], layout: hi.Layout, rate: float) -> Iterator[tuple[int, np.ndarray]]:
    """The block's margins after each tree."""
    margin = b.margin
    for k, tree in enumerate(trees):
        margin = margin + rate * tree.value.take(hi.places(tree, layout, b.cells))
        yield k, margin


def in_blocks(rows: DataFrame) -> RDD:
    """Binned rows as blocks, each partition its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in hi.blocks(batches):
            yield pa.RecordBatch.from_pydict({"block": [pickle.dumps(b, protocol=5)]})

    return rows.mapInArrow(run, "block binary").rdd.map(lambda r: pickle.loads(r[0]))


def round_aucs(rows: DataFrame, trees: list[hi.Tree], layout: hi.Layout, rate: float, ranges: int) -> list[float]:
    """ROC AUC of the binned rows after each tree, ties averaged, as exact counts: scores go to ``ranges`` tasks by
    value, each ranks its own, and the positives of the ranges above are added. One class alone has AUC 0.5."""
    held = in_blocks(rows).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    cuts = [np.zeros(0)] * len(trees)
    if ranges > 1:  # any cuts are right; these, by the first block of each partition, make even ranges
        def looked(some: Iterator[hi.Block]) -> Iterator[list[np.ndarray]]:
            for b in some:
                yield [np.quantile(m, np.linspace(0, 1, 65), method="nearest") for _, m in margins_after(b, trees, layout, rate)]
                return

        seen = held.mapPartitions(looked).collect()
        cuts = [np.unique(np.quantile(np.concatenate([x[k] for x in seen]), np.arange(1, ranges) / ranges)) for k in range(len(trees))]

    def dealt(b: hi.Block) -> Iterator[tuple[int, tuple]]:
        for k, margin in margins_after(b, trees, layout, rate):
            values, positive, negative = hi.distinct(margin, b.y.astype(np.int32), 1 - b.y.astype(np.int32))
            ends = np.r_[0, np.searchsorted(values, cuts[k], side="right"), len(values)]
            for r, (i, j) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
                if j > i:
                    yield r, (k, values[i:j], positive[i:j], negative[i:j])

    def ranked(part: int, items: Iterator[tuple[int, tuple]]) -> Iterator[tuple[int, int, int, int, int]]:
        lists: dict[int, list[tuple]] = {}
        for _, (k, *arrays) in items:
            lists.setdefault(k, []).append(arrays)
        for k, parts in lists.items():
            _, p, n = hi.distinct(*(np.concatenate(x) for x in zip(*parts, strict=True)))
            p, n = p.astype(np.int64), n.astype(np.int64)
            above = p.sum() - np.cumsum(p)
            pairs = sum(int(x) for x in np.add.reduceat(n * (2 * above + p), np.arange(0, len(n), 1 << 10)))
            yield k, part, int(p.sum()), int(n.sum()), pairs

    found = held.flatMap(dealt).partitionBy(ranges, int).mapPartitionsWithIndex(ranked).collect()
    held.unpersist()
    out = []
    for k in range(len(trees)):
        positives = negatives = pairs = 0
        for _, _, p, n, own in sorted((x for x in found if x[0] == k), key=lambda x: -x[1]):
            pairs += own + 2 * positives * n
            positives, negatives = positives + p, negatives + n
        out.append(pairs / (2.0 * positives * negatives) if positives and negatives else 0.5)
    return out


class Kept:
    """The rows that executors hold: the next ones are made from the last before these are let go."""

    def __init__(self) -> None:
        self.last: DataFrame | None = None

    def hold(self, df: DataFrame) -> DataFrame:
        df.persist().count()  # all partitions at once; the learner's first look would make one alone
        self.release()
        self.last = df
        return df

    def release(self) -> None:
        if self.last is not None:
            self.last.unpersist()
        self.last = None


def train(train_df: DataFrame, validation_df: DataFrame, cfg: TrainingConfig, features: str = "features", label: str = "TARGET",
          block: int = BLOCK) -> TrainedModel:
    """M2: fit until validation AUC has not risen for ``early_stopping_rounds`` rounds."""
    kept = Kept()
    try:
        return _boost(train_df, validation_df, settings(cfg), features, label, block, kept)
    finally:
        kept.release()


def _boost(train_df: DataFrame, validation_df: DataFrame, s: Settings, features: str, label: str, block: int, kept: Kept) -> TrainedModel:
    _input(train_df, validation_df, features, label, s.patience)
    y = binary_label(label)
    positives, total = train_df.agg(F.sum(y), F.count(F.lit(1))).first()
    share = min(max(positives / total, 1e-6), 1 - 1e-6)
    start = math.log(share / (1 - share))
    layout = layout_of(train_df, features)
    given = binned(train_df, features, y, start, layout)
    few = max(1, math.ceil(total / ROWS_PER_TASK))
    dealt = given.repartition(few) if few > 1 else given  # as large partitions as the input has need not be even
    rows = materialize(dealt, "train-margins").coalesce(few)
    held = materialize(binned(validation_df, features, y, start, layout), "validation-margins")
    ranges = max(1, math.ceil(held.count() / RANKED_PER_TASK))
    held = held.coalesce(ranges)
    rounds = _Rounds(s, layout, min(hi.SHIFT, 62 - int(total).bit_length()))
    trees: list[hi.Tree] = []
    history: list[float] = []
    patience, going = Patience(s.patience), True
    while going and len(trees) < s.rounds:
        wanted, new = min(block, s.rounds - len(trees)), []
        while len(new) < wanted:
            some = min(KEPT, wanted - len(new)) if few > 1 else wanted
            if few > 1:
                rows = kept.hold(rows)
            made = (rounds.apart if few > 1 else rounds.together)(in_blocks(rows), len(trees) + len(new), some)
            rows = walked(rows, made, layout, s.rate)
            new += made
        trees += new
        for auc in round_aucs(held, new, layout, s.rate, ranges):
            history.append(auc)
            going = patience.add(auc)
            if not going:
                break
        if going and len(trees) < s.rounds:
            rows = materialize(rows, "train-margins").coalesce(few)
            held = materialize(walked(held, new, layout, s.rate), "validation-margins").coalesce(ranges)
    best = patience.best
    gains = [t.importances(len(layout.bins)) for t in trees[:best]]
    model = Ensemble(tuple(t.nodes(layout, s.rate) for t in trees[:best]), start, tuple(float(v) for v in sum(gains)) if best else ())
    return TrainedModel(model=model, best_iteration=best, trees=model.numTrees, rounds=patience.seen, history=tuple(history))


@dataclass(frozen=True)
class _Rounds:
    """Boosting rounds over blocks of rows."""

    s: Settings
    layout: hi.Layout
    shift: int

    def tree(self, round_: int, sums_of) -> hi.Tree:
        s = self.s
        return hi.grow(sums_of, self.layout, s.depth, s.min_rows, s.min_gain, s.feature_fraction, s.seed + round_)

    def begin(self, b: hi.Block, before: hi.Tree | None, round_: int) -> hi.Block:
        return hi.advanced(b, before, self.layout, self.s.rate, self.s.seed + round_, self.s.row_fraction)

    def sums(self, some, tree: hi.Tree, wanted: np.ndarray) -> np.ndarray:
        return hi.level_sums(some, tree, self.layout, wanted, self.shift)

    def together(self, data: RDD, first: int, rounds: int) -> list[hi.Tree]:
        """The rounds of an input of one task, in that task."""

        def run(some: Iterator[hi.Block]) -> Iterator[hi.Tree]:
            held, tree = list(some), None
            for k in range(first, first + rounds):
                held = [self.begin(b, tree, k) for b in held]
                tree = self.tree(k, lambda t, wanted: self.sums(held, t, wanted))  # noqa: B023  called at once
                yield tree

        return data.mapPartitions(run).collect()

    def apart(self, data: RDD, first: int, rounds: int) -> list[hi.Tree]:
        """The rounds of a larger input, a job for each level: the executors keep the blocks of this round, and
        those of the round before until they are made."""
        trees: list[hi.Tree] = []
        last = None
        try:
            for k in range(first, first + rounds):
                before = trees[-1] if trees else None
                now = data.map(lambda b, before=before, k=k: self.begin(b, before, k)).persist(StorageLevel.MEMORY_AND_DISK_DESER)

                def sums_of(t: hi.Tree, wanted: np.ndarray, now=now) -> np.ndarray:
                    return reduced(now.mapPartitions(lambda some: [self.sums(some, t, wanted)]), np.add)

                data, last, old = now, now, last
                tree = self.tree(k, sums_of)
                if old is not None:
                    old.unpersist()
                trees.append(tree)
        finally:
            if last is not None:
                last.unpersist()
        return trees


def importance(spark, model: Ensemble, names: tuple[str, ...], top: int = 50) -> DataFrame:
    """M8: (feature, gain) sorted by gain descending, first ``top``.

    Gains are normalised per tree and summed to 1; the list is as long as the feature vector, so it is built
    on the driver.
    """
    values = model.featureImportances.toArray()
    if len(values) != len(names):
        raise ValueError(f"{len(names)} feature names were given for a model of {len(values)} features")
    rows = sorted(((n, float(v)) for n, v in zip(names, values, strict=True)), key=lambda r: -r[1])
    return spark.createDataFrame(rows[:top], "feature string, gain double")
