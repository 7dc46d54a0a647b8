from pyspark.sql import functions as F

from tabspark.operators import score as sc


def test_vector_check(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [4.0, 5.0, 6.0]), (3, [1.0]), (4, [])],
                               "id long, f array<float>")
    good, bad = sc.check_vectors(df, "f", key="id")
    assert sorted(r["id"] for r in good.collect()) == [1, 2]
    msgs = {r["id"]: r["message"] for r in bad.collect()}
    assert msgs[3] == "Row has 1 features, expected 3"
    assert msgs[4] == "features list must not be empty"


def test_score_parity(spark):
    a = spark.createDataFrame([(1, 0.5), (2, 0.25), (3, 0.1)], "k long, score double")
    b = spark.createDataFrame([(1, 0.5004), (2, 0.25)], "k long, score double")
    r = sc.score_parity(a, b, "k").first()
    assert (r["matched"], r["missing_in_b"], r["passed"]) == (2, 1, False)
    r2 = sc.score_parity(a.where(F.col("k") < 3), b, "k").first()
    assert r2["passed"] is True and abs(r2["max_abs_diff"] - 0.0004) < 1e-12


def test_positive_probability(spark):
    df = spark.createDataFrame([([0.3, 0.7],), ([0.9],)], "p array<double>")
    out = [r[0] for r in df.select(sc.positive_probability(F.col("p"))).collect()]
    assert out == [0.7, 0.9]
