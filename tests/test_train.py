import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tabspark.contract import TrainingConfig
from tabspark.operators import train as tr
from tabspark.operators.ensemble import LEAF, Ensemble, Node, joined_margins
from tabspark.operators.evaluate import rank_metrics


def _dense(spark, n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    rows = [([float(v) for v in r], int(r[0] > 0)) for r in x]
    return spark.createDataFrame(rows, "f array<double>, TARGET long").select(
        array_to_vector("f").alias("features"), "TARGET")


def _noisy(spark, n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = x[:, 0] + x[:, 1] ** 2 + rng.normal(size=n) > 1
    return spark.createDataFrame([([float(v) for v in r], int(t)) for r, t in zip(x, y)], "f array<double>, TARGET long").select(
        array_to_vector("f").alias("features"), "TARGET")


def test_dense_train_and_best_iteration(spark):
    cfg = TrainingConfig(num_boost_round=20, min_data_in_leaf=5, learning_rate=0.3)
    out = tr.train(_dense(spark, 100, 42), _dense(spark, 30, 43), cfg)
    assert out.best_iteration is not None and 1 <= out.best_iteration <= 20
    assert out.trees == out.best_iteration  # the model predicts with the best iteration
    auc_input = out.model.transform(_dense(spark, 200, 44))
    acc = auc_input.where(F.col("prediction") == F.col("TARGET")).count() / 200
    assert acc > 0.8
    imp = tr.importance(spark, out.model, ("a", "b", "c")).collect()
    assert imp[0]["feature"] == "a" and imp[0]["gain"] >= imp[-1]["gain"]
    assert abs(sum(r["gain"] for r in imp) - 1) < 1e-9
    with pytest.raises(ValueError, match="2 feature names"):
        tr.importance(spark, out.model, ("a", "b"))


def test_guards(spark):
    with pytest.raises(ValueError, match="early_stopping_rounds must be at least 1"):
        tr.train(_dense(spark, 10, 1), _dense(spark, 10, 2), TrainingConfig(early_stopping_rounds=0))
    with pytest.raises(ValueError, match="validation split must not be empty"):
        tr.train(_dense(spark, 10, 1), _dense(spark, 10, 2).limit(0), TrainingConfig(num_boost_round=2))
    with pytest.raises(ValueError, match="train split is missing columns: TARGET"):
        tr.train(_dense(spark, 10, 1).drop("TARGET"), _dense(spark, 10, 2), TrainingConfig(num_boost_round=2))
    assert tr.depth_for_leaves(63) == 6 and tr.depth_for_leaves(64) == 6 and tr.depth_for_leaves(65) == 7


def test_patience_counts_rounds_without_a_better_value():
    def run(rounds, values):
        p = tr.Patience(rounds)
        for v in values:
            if not p.add(v):
                break
        return p.seen, p.best

    dip = [0.6, 0.7, 0.65, 0.64, 0.69, 0.8, 0.79]
    assert run(2, dip) == (4, 2)  # ends before the later rise
    assert run(4, dip) == (7, 6)  # waits for it
    assert run(3, [0.5, 0.5, 0.5, 0.5, 0.5]) == (4, 1)  # a tie is no gain, the first best counts
    assert run(50, [0.1]) == (1, 1)


def test_early_stopping_rounds_decides_where_fitting_ends(spark):
    train, val = _noisy(spark, 300, 5), _noisy(spark, 150, 6)
    made = {}
    for patience in (2, 8):
        cfg = TrainingConfig(num_boost_round=30, min_data_in_leaf=5, learning_rate=0.3, early_stopping_rounds=patience, extra={"max_depth": 2})
        out = made[patience] = tr.train(train, val, cfg, block=4)
        want = tr.Patience(patience)
        for auc in out.history:
            going = want.add(auc)
        assert (out.rounds, out.best_iteration) == (want.seen, want.best) and (not going or out.rounds == 30)
        assert out.rounds == 30 or out.rounds - out.best_iteration == patience
        assert out.history[out.best_iteration - 1] == max(out.history)
    assert made[8].rounds > made[2].rounds
    assert made[8].history[:made[2].rounds] == pytest.approx(made[2].history, abs=1e-9)  # the same rounds, whatever the patience
    # the kept trees score as the round that was best
    scored = made[8].model.transform(val).select("TARGET", vector_to_array("probability")[1].alias("p"))
    assert rank_metrics(scored, "TARGET", "p").first()["roc_auc"] == pytest.approx(max(made[8].history), abs=1e-12)
    # blocks do not change the fit
    again = tr.train(train, val, TrainingConfig(num_boost_round=6, min_data_in_leaf=5, learning_rate=0.3, extra={"max_depth": 2}), block=6)
    assert again.history == pytest.approx(made[8].history[:6], abs=1e-9)


def test_large_inputs_are_dealt_evenly_and_kept(spark, monkeypatch):
    """Inputs of more than one task: the same fit, from even partitions kept by the executors, and none kept after it."""
    train, val = _noisy(spark, 300, 5).coalesce(1), _noisy(spark, 150, 6)
    cfg = TrainingConfig(num_boost_round=7, min_data_in_leaf=5, learning_rate=0.3, extra={"max_depth": 2})
    whole = tr.train(train, val, cfg, block=7)
    held, hold = [], tr.Kept.hold

    def watched(self, df):
        out = hold(self, df)
        held.append((out.storageLevel.useMemory and out.storageLevel.useDisk, sorted(out.rdd.mapPartitions(lambda x: [sum(1 for _ in x)]).collect())))
        return out

    monkeypatch.setattr(tr.Kept, "hold", watched)
    monkeypatch.setattr(tr, "ROWS_PER_TASK", 100)
    monkeypatch.setattr(tr, "KEPT", 3)
    again = tr.train(train, val, cfg, block=4)
    assert again.history == pytest.approx(whole.history, abs=1e-9) and again.trees == whole.trees
    assert len(held) == 3 and all(kept for kept, _ in held)  # rounds 1 and 4 of the first block, 1 (and no more) of the second
    assert all(sum(rows) == 300 and min(rows) >= 90 for _, rows in held)
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_first_round_is_the_newton_step(spark):
    """One round on one feature against the closed form: leaf = sum(y - p) / sum(p (1 - p))."""
    rows = [([0.0], 0)] * 30 + [([0.0], 1)] * 10 + [([1.0], 1)] * 35 + [([1.0], 0)] * 5
    df = spark.createDataFrame(rows, "f array<double>, TARGET long").select(array_to_vector("f").alias("features"), "TARGET")
    out = tr.train(df, df, TrainingConfig(num_boost_round=1, min_data_in_leaf=1, learning_rate=0.5, num_leaves=2, bagging_freq=0, feature_fraction=1.0))
    p = 45 / 80
    leaf = {x: 0.5 * (n1 - p * n) / (p * (1 - p) * n) for x, n, n1 in ((0.0, 40, 10), (1.0, 40, 35))}
    got = {r["x"]: r["margin"] for r in out.model.transform(df).select(vector_to_array("features")[0].alias("x"), "margin").distinct().collect()}
    assert got.keys() == leaf.keys()
    for x, v in leaf.items():
        assert got[x] == pytest.approx(math.log(p / (1 - p)) + v, abs=1e-9)


def test_option_names():
    base = TrainingConfig()
    assert tr.settings(base) == tr.Settings(500, 0.05, 6, 0.8, 0.8, 50, 0.0, 42, 50)
    extra = {"n_estimators": 7, "min_child_samples": 3, "subsample": 0.5, "colsample_bytree": 0.25, "random_state": 9, "max_depth": 4, "min_split_gain": 0.1}
    assert tr.settings(TrainingConfig(extra=extra)) == tr.Settings(7, 0.05, 4, 0.25, 0.5, 3, 0.1, 9, 50)
    assert tr.settings(TrainingConfig(extra={"subsample_freq": 0, "max_depth": -1})).row_fraction == 1.0
    assert tr.option(TrainingConfig(), "no_such", default=3) == 3


ENSEMBLE = Ensemble(
    ((Node(0, 0.5, 1, 2), Node(value=0.25), Node(2, -1.0, 3, 4), Node(value=-0.5), Node(value=1.5)), (Node(value=0.125),), (Node(1, 0.0, 1, 2), Node(value=-2.0), Node(value=2.0))),
    start=0.5)


def _walk(x):
    total = ENSEMBLE.start
    for tree in ENSEMBLE.trees:
        n = tree[0]
        while n.feature != LEAF:
            n = tree[n.left if x[n.feature] <= n.threshold else n.right]
        total += n.value
    return total


def test_table_and_both_scorers_agree(spark):
    rng = np.random.default_rng(1)
    x = [[float(v) for v in r] for r in rng.normal(size=(200, 4))] + [[0.5, 0.0, -1.0, 0.0], [0.6, 0.1, -1.0, 9.0]]
    df = spark.createDataFrame(list(enumerate(x)), "k long, f array<double>").repartition(3)
    nodes = ENSEMBLE.table(spark)
    assert Ensemble.from_table(nodes) == ENSEMBLE and nodes.count() == 10
    want = {k: _walk(v) for k, v in enumerate(x)}
    assert {r["k"]: r["margin"] for r in ENSEMBLE.transform(df, "f").collect()} == want
    vec = ENSEMBLE.transform(df.select("k", array_to_vector("f").alias("features")))
    for r in vec.collect():
        p = 1 / (1 + math.exp(-want[r["k"]]))
        assert r["probability"][1] == pytest.approx(p, abs=1e-12) and r["prediction"] == float(r["probability"][1] >= 0.5)
    assert {r["k"]: r["margin"] for r in joined_margins(df, nodes, ["k"], "f", 3).collect()} == want
    none = ENSEMBLE.transform(spark.createDataFrame([(1, None), (2, x[0])], "k long, f array<double>"), "f").collect()
    assert none[0]["margin"] is None and none[0]["prediction"] is None and none[1]["margin"] == want[0]


def _broadcast_inputs(df):
    """The operators below each broadcast of a plan."""
    lines, found = df._jdf.queryExecution().executedPlan().toString().splitlines(), []
    place = [len(x) - len(x.lstrip(" :+-*")) for x in lines]
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((j for j in range(i + 1, len(lines)) if place[j] <= place[i]), len(lines))
            found.append("\n".join(lines[i + 1 : end]))
    return found


def test_rows_are_not_broadcast(spark, tmp_dir):
    """Tables small on disk for their rows: only nodes are broadcast, and no row is sent to the task of its node."""
    spark.range(3000).selectExpr("id AS k", "array(0.4D, -0.5D, 2.0D, 0.0D) AS f").write.parquet(f"{tmp_dir}/rows")
    got = joined_margins(spark.read.parquet(f"{tmp_dir}/rows"), ENSEMBLE.table(spark), ["k"], "f", 3)
    assert "hashpartitioning(tree" not in got._jdf.queryExecution().executedPlan().toString()
    inputs = _broadcast_inputs(got)
    assert len(inputs) == 4 and not any("Generate" in x or "FileScan" in x for x in inputs)
    assert got.count() == 3000 and {r["margin"] for r in got.collect()} == {_walk([0.4, -0.5, 2.0, 0.0])}


def test_ensemble_scores_broadcasts_no_rows(spark):
    from tabspark.plans import catalog
    inputs = _broadcast_inputs(catalog.q_ensemble_scores(spark, "/root/testdata/sf0.001"))
    assert inputs and not any("Generate" in x or "FileScan" in x or "ArrowEvalPython" in x for x in inputs)


def test_fitted_trees_score_as_spark_does(spark):
    df = _noisy(spark, 200, 3)
    rows = df.select("features", F.col("TARGET").cast("double").alias("_target"), F.lit(1.0).alias("_weight"))
    model = tr.build_tree(tr.settings(TrainingConfig(min_data_in_leaf=5)), 0).fit(rows)
    nodes = tr.tree_nodes(model.trees[0].toDebugString, 1.0)
    assert len(nodes) == model.trees[0].numNodes
    both = Ensemble((nodes,)).transform(model.transform(df).withColumnRenamed("prediction", "theirs"))
    assert both.where(F.abs(F.col("margin") - F.col("theirs")) > 1e-12).count() == 0
