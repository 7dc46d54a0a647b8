import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabspark.contract import TrainingConfig
from tabspark.operators import histogram as hi
from tabspark.operators import train as tr
from tabspark.operators.ensemble import Ensemble
from tabspark.operators.evaluate import rank_metrics


def _rows(n, seed):
    """Four features of few values and one of many; labels that lean on three of them."""
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 7, n), rng.integers(0, 2, n), rng.integers(0, 20, n), rng.normal(size=n), np.full(n, 4.0)], 1).astype(float)
    return x, (x[:, 0] + 3 * x[:, 1] + 2 * x[:, 3] + rng.normal(size=n) > 5).astype(int)


def _frame(spark, x, y):
    return spark.createDataFrame([([float(v) for v in r], int(t)) for r, t in zip(x, y, strict=True)], "f array<double>, TARGET long").select(
        array_to_vector("f").alias("features"), "TARGET")


def _layout(x):
    return hi.Layout.of([hi.thresholds(hi.distinct(x[:, f], np.ones(len(x), np.int64))) for f in range(x.shape[1])])


def _tree(blocks, layout, **over):
    kw = dict(depth=4, min_rows=5, min_gain=0.0, feature_share=1.0, seed=1) | over
    return hi.grow(lambda t, wanted: hi.level_sums(blocks, t, layout, wanted, 30), layout, **kw)


def _block(layout, x, y, margin=0.0):
    return hi.Block(layout.cells(x), y.astype(np.int8), np.full(len(y), margin), np.arange(len(y)), np.ones(len(y), bool))


def test_thresholds():
    few = hi.thresholds((np.array([1.0, 2.0, 4.0]), np.array([5, 1, 1])))
    assert few.tolist() == [1.5, 3.0]
    assert hi.thresholds((np.array([3.0]), np.array([9]))).size == 0 and hi.thresholds((np.zeros(0), np.zeros(0, np.int64))).size == 0
    even = hi.thresholds((np.arange(64.0), np.ones(64, np.int64)))
    assert len(even) == 31 and even.tolist() == [2 * k + 1.5 for k in range(31)]


def test_long_value_lists_keep_their_ranks():
    """Many more values than are counted one by one, in batches and by several tasks: ranks within 1 %, rows all there."""
    rng = np.random.default_rng(2)
    x = rng.lognormal(size=400_000)
    batches = [pa.RecordBatch.from_pydict({"x": pa.FixedSizeListArray.from_arrays(pa.array(part), 1).cast(pa.list_(pa.float64()))}) for part in np.array_split(x, 40)]
    a, b = hi.values_of(batches[:13]), hi.values_of(batches[13:])
    values, rows = hi.merge_values(a, b)[0].counted()
    assert rows.sum() == len(x) and len(values) < 60_000
    cuts = hi.thresholds((values, rows))
    shares = np.searchsorted(np.sort(x), cuts) / len(x)
    assert len(cuts) == 31 and np.abs(shares - np.arange(1, 32) / 32).max() < 0.01


def test_odd_values_and_vectors():
    col = lambda rows: pa.RecordBatch.from_pydict({"x": pa.array(rows, pa.list_(pa.float64()))})
    found = hi.values_of([col([[1.0, 0.0], [math.nan, -0.0]]), col([]), col([[math.inf, 2.0], [-math.inf, 2.0], [3.0, 0.0]])])
    assert [v.counted()[0].tolist() for v in found] == [[1.0, 3.0], [0.0, 2.0]] and found[1].counted()[1].tolist() == [3, 2]
    layout = hi.Layout.of([hi.thresholds(v.counted()) for v in found])
    cells = layout.cells(np.array([[math.nan, 1.0], [math.inf, 0.0], [-math.inf, 1.5], [2.0, 0.0], [2.1, math.nan]]))
    bins = [(cells[layout.cell[f]] // layout.stride[f] % layout.bins[f]).tolist() for f in range(2)]
    assert bins == [[1, 1, 0, 0, 1], [0, 0, 1, 0, 1]]  # a value at the threshold goes left, NaN right
    for bad in ([[1.0], None], [[1.0, 2.0], [1.0]]):
        with pytest.raises(ValueError, match="feature vectors must"):
            hi.values_of([col(bad)])


def test_cells_hold_every_bin_and_travel_whole():
    x, _ = _rows(3000, 1)
    many = np.hstack([x] + [(x[:, :1] == k).astype(float) for k in range(12)])
    layout = _layout(many)
    cells = layout.cells(many)
    assert max(layout.widths) <= hi.CELL and len(layout.widths) < many.shape[1]
    for f, t in enumerate(layout.thresholds):
        assert (cells[layout.cell[f]] // layout.stride[f] % layout.bins[f] == (many[:, f][:, None] > t).sum(1)).all()
    whole = pa.RecordBatch.from_pydict({"_cells": hi.packed_cells(cells), "_y": np.arange(3000) % 2, "_margin": np.arange(3000.0), "_row": np.arange(3000)})
    made = list(hi.blocks(iter([whole.slice(0, 700), whole.slice(700, 0), whole.slice(700)]), 1000))
    assert [len(b.y) for b in made] == [1000] * 3
    assert (np.hstack([b.cells for b in made]) == cells).all() and (np.concatenate([b.row for b in made]) == np.arange(3000)).all()


def test_a_tree_splits_as_sparks_does(spark):
    """The first round's tree against Spark's learner on the same targets: the same nodes."""
    x, y = _rows(2000, 3)
    x[:, 3] = np.round(x[:, 3] * 4) / 4  # few values: the same candidates
    layout = _layout(x)
    p = 0.5
    mine = _tree([_block(layout, x, y)], layout).nodes(layout, 1.0)
    given = _frame(spark, x, y).select("features", F.lit(p * (1 - p)).alias("_weight"), ((F.col("TARGET") - p) / (p * (1 - p))).alias("_target"))
    s = tr.settings(TrainingConfig(min_data_in_leaf=5, feature_fraction=1.0, extra={"max_depth": 4}))
    model = tr.build_tree(s, 0).fit(given)
    theirs = tr.tree_nodes(model.trees[0].toDebugString, 1.0)
    assert len(mine) == len(theirs) > 15
    for a, b in zip(mine, theirs, strict=True):
        assert (a.feature, a.left, a.right) == (b.feature, b.left, b.right)
        assert a.threshold == pytest.approx(b.threshold, abs=1e-12) and a.value == pytest.approx(b.value, abs=1e-7)
    gains = _tree([_block(layout, x, y)], layout).importances(5)
    assert gains.tolist() == pytest.approx(model.featureImportances.toArray().tolist(), abs=1e-6)


def test_blocks_do_not_change_a_tree():
    x, y = _rows(3000, 4)
    layout = _layout(x)
    order = np.random.default_rng(5).permutation(3000)
    whole = _tree([_block(layout, x, y)], layout, feature_share=0.6)
    parts = _tree([_block(layout, x[i], y[i]) for i in np.array_split(order, 7)], layout, feature_share=0.6)
    assert all((getattr(whole, k) == getattr(parts, k)).all() for k in ("feature", "bin", "value", "gain"))
    assert (whole.feature != hi.LEAF).sum() > 5
    # the sums that are taken from a parent are those of the rows
    at = hi.places(whole, layout, layout.cells(x))
    for place in np.unique(at):
        assert whole.value[place] == pytest.approx((y[at == place] - 0.5).sum() / (0.25 * (at == place).sum()), abs=1e-8)
        assert (at == place).sum() >= 5
    flat = [Ensemble((whole.nodes(layout, 0.5),)).trees[0]]
    for row, place in zip(x[:200], at[:200], strict=True):
        n = flat[0][0]
        while n.feature != hi.LEAF:
            n = flat[0][n.left if row[n.feature] <= n.threshold else n.right]
        assert n.value == pytest.approx(0.5 * whole.value[place])


def test_draws():
    row = np.arange(100_000) + (3 << 33)
    a, b = hi.drawn(row, 42, 0.8), hi.drawn(row, 43, 0.8)
    assert abs(a.mean() - 0.8) < 0.01 and abs((a & b).mean() - 0.64) < 0.01 and (a == hi.drawn(row, 42, 0.8)).all()
    assert hi.drawn(row, -1, 1.0).all()


def test_round_aucs_are_exact(spark, monkeypatch):
    """Scores with ties, ranked by one task and by several, against the operator for evaluations."""
    x, y = _rows(1500, 6)
    layout = _layout(x)
    trees = [_tree([_block(layout, x, y)], layout, depth=d) for d in (1, 3, 4)]
    rows = tr.binned(_frame(spark, x, y).repartition(3), "features", F.col("TARGET"), 0.25, layout)
    margin, cells = np.full(1500, 0.25), layout.cells(x)
    for k, (one, many) in enumerate(zip(tr.round_aucs(rows, trees, layout, 0.3, 1), tr.round_aucs(rows, trees, layout, 0.3, 5), strict=True)):
        margin = margin + 0.3 * trees[k].value[hi.places(trees[k], layout, cells)]
        scored = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, margin, strict=True)], "y long, s double")
        assert one == many == pytest.approx(rank_metrics(scored, "y", "s").first()["roc_auc"], abs=1e-12)
    assert tr.round_aucs(rows.where("_y = 1"), trees, layout, 0.3, 2) == [0.5] * 3
    walked = {r["_row"]: r["_margin"] for r in tr.walked(rows, trees, layout, 0.3).collect()}
    assert len(walked) == 1500 and sorted(walked.values()) == pytest.approx(sorted(margin.tolist()), abs=1e-12)


def test_rounds_of_a_small_table_take_few_jobs(spark):
    """rounds used to be a dozen jobs each; those of a table of one task are one job for a block of rounds."""
    x, y = _rows(600, 7)
    sc = spark.sparkContext
    sc.setJobGroup("few-jobs", "rounds of a small table")
    try:
        out = tr.train(_frame(spark, x, y), _frame(spark, *_rows(200, 8)), TrainingConfig(num_boost_round=40, learning_rate=0.01, min_data_in_leaf=5))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert out.rounds == 40 and len(sc.statusTracker().getJobIdsForGroup("few-jobs")) < 80


def test_rounds_apart_fit_as_rounds_together(spark, monkeypatch):
    """A job for each level over dealt rows makes the very trees that one task makes, and leaves nothing kept."""
    train, val = _frame(spark, *_rows(900, 9)).coalesce(1), _frame(spark, *_rows(300, 10))
    cfg = TrainingConfig(num_boost_round=6, min_data_in_leaf=5, learning_rate=0.3)
    one = tr.train(train, val, cfg)
    monkeypatch.setattr(tr, "ROWS_PER_TASK", 250)
    monkeypatch.setattr(tr, "RANKED_PER_TASK", 100)
    monkeypatch.setattr(tr, "WIDE", 2)
    many = tr.train(train, val, cfg)
    assert many.model == one.model and many.history == one.history and many.model.importances == one.model.importances
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_feature_importance_trains_with_the_jobs_own_settings(spark, tmp_dir, monkeypatch):
    """the gains are those of the whole training: 500 rounds, or until 50 brought nothing; it used to end after ten."""
    from tabspark.plans import catalog

    spark.range(800).selectExpr("id * 7 AS o_orderkey", "id % 40 AS o_custkey", "CAST(id * 37 % 20000 AS DOUBLE) AS o_totalprice").write.parquet(f"{tmp_dir}/orders.parquet")
    spark.range(40).selectExpr("id AS c_custkey", "CAST(id % 25 AS INT) AS c_nationkey").write.parquet(f"{tmp_dir}/customer.parquet")
    seen = {}

    def watched(clean, cfg, *args, **kw):
        seen.update(cfg=cfg, **fit(clean, cfg, *args, **kw))
        return seen

    fit = catalog.fit_and_evaluate
    monkeypatch.setattr(catalog, "fit_and_evaluate", watched)
    got = [r["gain"] for r in catalog.q_feature_importance(spark, tmp_dir).collect()]
    assert seen["cfg"] == TrainingConfig() and seen["cfg"].num_boost_round == 500
    out = seen["trained"]
    assert out.rounds == min(500, out.best_iteration + 50)
    assert got == sorted(got, reverse=True) and sum(got) == pytest.approx(1.0) and len(got) == min(50, len(seen["encoder"].feature_names))
