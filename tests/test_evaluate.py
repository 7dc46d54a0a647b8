import numpy as np
import pytest

from tabspark.functions.quantiles import exact_percentiles
from tabspark.operators import evaluate as ev


def _brute_auc(y, s):
    pos = [b for a, b in zip(y, s) if a == 1]
    neg = [b for a, b in zip(y, s) if a == 0]
    tot = sum((1.0 if p > n else 0.5 if p == n else 0.0) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def _brute_ap(y, s):
    order = sorted(set(s), reverse=True)
    P = sum(y)
    ap, prev_r = 0.0, 0.0
    for t in order:
        tp = sum(1 for a, b in zip(y, s) if a == 1 and b >= t)
        fp = sum(1 for a, b in zip(y, s) if a == 0 and b >= t)
        r = tp / P
        ap += (r - prev_r) * (tp / (tp + fp))
        prev_r = r
    return ap


def _frame(spark, y, s, split="test"):
    return spark.createDataFrame([(split, int(a), float(b)) for a, b in zip(y, s)], "split string, y long, s double")


def test_scores4(spark):
    m = ev.binary_metrics(_frame(spark, [1, 0, 1, 1], [0.8] * 4), "y", "s").first()
    assert (m["tn"], m["fp"], m["fn"], m["tp"]) == (0, 1, 0, 3)
    assert m["precision"] == 0.75 and m["recall"] == 1.0 and m["accuracy"] == 0.75
    assert m["roc_auc"] == 0.5


def test_one_class_fallback(spark):
    m = ev.binary_metrics(_frame(spark, [1, 1, 1], [0.1] * 3), "y", "s").first()
    assert m["roc_auc"] == 0.5 and m["average_precision"] == 1.0
    assert m["precision"] == 0.0 and m["f1"] == 0.0  # zero predicted positives


@pytest.mark.parametrize("small_group", [100_000, 1])   # sorted fold / two-level path
def test_against_brute_force_with_ties(spark, small_group):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400).tolist()
    s = (np.round(rng.random(400) * 20) / 20 + np.array(y) * 0.1).tolist()  # many ties
    m = ev.rank_metrics(_frame(spark, y, s), "y", "s", ["split"], small_group=small_group).first()
    assert m["roc_auc"] == pytest.approx(_brute_auc(y, s), abs=1e-12)
    assert m["average_precision"] == pytest.approx(_brute_ap(y, s), abs=1e-12)


@pytest.mark.parametrize("small_group", [100_000, 1])
def test_negative_and_wide_scores(spark, small_group):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 300).tolist()
    s = (rng.normal(size=300) * 1000).tolist()
    s[:5] = [0.0] * 5
    m = ev.rank_metrics(_frame(spark, y, s), "y", "s", ["split"], small_group=small_group).first()
    assert m["roc_auc"] == pytest.approx(_brute_auc(y, s), abs=1e-12)


def test_metrics_long(spark):
    m = ev.binary_metrics(_frame(spark, [1, 0, 1, 0], [0.9, 0.1, 0.4, 0.6]), "y", "s")
    long = {r["metric"]: r["value"] for r in ev.metrics_long(m).collect()}
    assert long["test_tp"] == 1.0 and "test_roc_auc" in long


def test_exact_percentiles_vs_numpy_with_hot_group(spark):
    rng = np.random.default_rng(11)
    vals = [("hot", float(v)) for v in np.round(rng.exponential(50, 5000), 2)]
    vals += [("cold", float(v)) for v in np.round(rng.normal(10, 3, 37), 2)]
    vals += [("one", 4.25)]
    df = spark.createDataFrame(vals, "g string, v double")
    got = {r["g"]: r for r in exact_percentiles(df, ["g"], "v", {"p50": 0.5, "p95": 0.95, "p99": 0.99}).collect()}
    for g in ("hot", "cold", "one"):
        arr = np.array([v for k, v in vals if k == g])
        for name, p in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
            assert got[g][name] == pytest.approx(float(np.percentile(arr, p * 100)), abs=1e-8)


def test_latency_stats(spark):
    df = spark.createDataFrame([(float(i), 512) for i in range(1, 101)], "ms double, rows long")
    r = ev.latency_stats(df, "ms", "rows").first()
    assert r["p50_latency_ms"] == 50.5 and r["runs"] == 100
    assert r["throughput_rows_per_sec"] == pytest.approx(512 * 100 / (5050 / 1000))


def test_fixed_point_fallbacks(spark):
    from tabspark.functions.quantiles import exact_mean, exact_sum
    df = spark.createDataFrame([("a", float("-inf")), ("a", 1.0), ("a", float("inf")), ("a", 2.0),
                                ("b", 1e20), ("b", 1.0), ("c", 0.125), ("c", 0.25)], "g string, v double")
    p = {r["g"]: r for r in exact_percentiles(df, ["g"], "v", {"p0": 0.0, "p50": 0.5, "p100": 1.0}).collect()}
    assert p["a"]["p0"] == float("-inf") and p["a"]["p50"] == 1.5 and p["a"]["p100"] == float("inf")
    assert p["b"]["p50"] == 5e19
    m = {r["g"]: r for r in df.groupBy("g").agg(exact_mean("v").alias("m"), exact_sum("v").alias("s")).collect()}
    assert m["b"]["s"] == 1e20 and m["c"]["m"] == 0.1875 and m["c"]["s"] == 0.375


def test_null_group_key_kept(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, v double")
    got = {r["g"]: r["p"] for r in exact_percentiles(df, ["g"], "v", {"p": 0.5}).collect()}
    assert got == {None: 2.0, "a": 5.0}


def test_metrics_keep_null_group(spark):
    df = spark.createDataFrame([(None, 1, 0.9), (None, 0, 0.1), ("x", 1, 0.4), ("x", 0, 0.6)],
                               "split string, y long, s double")
    m = {r["split"]: r for r in ev.binary_metrics(df, "y", "s", ["split"]).collect()}
    assert m[None]["roc_auc"] == 1.0 and m["x"]["roc_auc"] == 0.0
    lat = {r["split"]: r for r in ev.latency_stats(df, "s", by=["split"]).collect()}
    assert lat[None]["p50_latency_ms"] == 0.5


@pytest.mark.parametrize("bad", [2, None])
def test_labels_other_than_0_and_1_end_the_job(spark, bad):
    df = spark.createDataFrame([(0, 0.2), (1, 0.9), (bad, 0.4)], "y int, s double")
    for metrics in (ev.confusion, ev.rank_metrics):
        with pytest.raises(Exception, match="must be 0 or 1; found " + ("null" if bad is None else "2")):
            metrics(df, "y", "s").collect()


def test_pair_counts_beyond_64_bits(spark):
    from pyspark.sql import functions as F
    row = spark.range(1).select(ev._pairs(F.lit(3_000_000_000), F.lit(9_000_000_000)).alias("p")).first()
    assert int(row["p"]) == 27 * 10**18


def test_average_precision_is_the_same_by_both_paths(spark):
    rng = np.random.default_rng(17)
    y = rng.integers(0, 2, 3000).tolist()
    s = rng.random(3000).tolist()
    df = _frame(spark, y, s).repartition(7)
    small, large = (ev.rank_metrics(df, "y", "s", ["split"], small_group=n).first() for n in (100_000, 1))
    assert small["average_precision"] == large["average_precision"] and small["roc_auc"] == large["roc_auc"]
    assert small["average_precision"] == pytest.approx(_brute_ap(y, s), abs=1e-12)


def test_percentiles_and_sums_from_one_read(spark, tmp_dir):
    from pyspark.sql import functions as F

    from tabspark.functions.quantiles import exact_mean, exact_sum
    rng = np.random.default_rng(2)
    rows = [("hot", float(v), int(k % 3)) for k, v in enumerate(np.round(rng.exponential(50, 3000), 2))]
    rows += [("cold", 1.5, 1), ("cold", None, 5), ("none", None, 7), ("nan", float("nan"), 1), ("nan", 2.0, 1), (None, -4.0, 2)]
    spark.createDataFrame(rows, "g string, v double, w int").repartition(3).write.parquet(f"{tmp_dir}/t")
    df = spark.read.parquet(f"{tmp_dir}/t")
    out = exact_percentiles(df, ["g"], "v", {"p95": 0.95}, sums={"w": F.col("w"), "n": F.lit(1)}, mean=("m", 2), total="t")
    plan = out._jdf.queryExecution().executedPlan().toString()
    got = {r["g"]: r for r in out.collect()}
    want = {r["g"]: r for r in df.groupBy("g").agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n"), exact_mean("v", 2).alias("m"), exact_sum("v").alias("t")).collect()}
    assert got.keys() == want.keys() == {"hot", "cold", "none", "nan", None}
    for g, r in want.items():
        for c in ("w", "n", "m", "t"):
            assert got[g][c] == r[c] or (got[g][c] != got[g][c] and r[c] != r[c]), (g, c)
    assert got["hot"]["p95"] == pytest.approx(float(np.percentile([v for g, v, _ in rows if g == "hot"], 95)), abs=1e-8)
    assert got["none"]["p95"] is None and got["cold"]["p95"] == 1.5 and got[None]["p95"] == -4.0
    final = out._jdf.queryExecution().executedPlan().toString()
    final = final.split("== Initial Plan ==")[0]
    assert "AdaptiveSparkPlan" in plan and final.count("FileScan") + final.count("Scan parquet") <= 1 + final.count("ReusedExchange")
