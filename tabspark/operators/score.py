"""Scoring (M3-M7).

``score`` applies a fitted Spark ML model and keeps the positive-class
probability; ``score_onnx`` runs an exported model file with onnxruntime inside
``mapInPandas`` (one session per task, Arrow batches). ``check_vectors`` splits
a batch of feature arrays into good rows and a quarantine; ``score_parity``
compares two scorers row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspark.functions.columns import count_where


def positive_probability(prob: str | Column) -> Column:
    """M3: positive-class probability from a vector / array of 1 or k entries."""
    arr = vector_to_array(F.col(prob)) if isinstance(prob, str) else prob
    return F.when(F.size(arr) == 1, arr[0]).otherwise(arr[1])


def score(df: DataFrame, model, threshold: float = 0.5, version: str | None = None,
          keep: list[str] | None = None, prob_col: str = "probability") -> DataFrame:
    """M3-M4: probability, thresholded prediction and model version."""
    out = model.transform(df)
    p = positive_probability(prob_col).cast("double")
    cols = [F.col(c) for c in (keep or [])]
    return out.select(*cols, p.alias("score"),
                      (p >= F.lit(float(threshold))).cast("long").alias("prediction"),
                      F.lit(version).cast("string").alias("model_version"))


def score_onnx(df: DataFrame, model_bytes: bytes, features: str = "features",
               keep: list[str] | None = None, threshold: float = 0.5) -> DataFrame:
    """M3 for a foreign model file: one onnxruntime session per task.

    The model bytes travel to executors once as a broadcast variable.
    """
    keep = keep or []
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast(model_bytes)
    schema = T.StructType([df.schema[c] for c in keep] + [
        T.StructField("score", T.DoubleType()), T.StructField("prediction", T.LongType())])

    def run(batches):
        import numpy as np
        import onnxruntime as ort
        sess = ort.InferenceSession(bc.value, providers=["CPUExecutionProvider"])
        name = sess.get_inputs()[0].name
        outputs = [o.name for o in sess.get_outputs()]
        pick = next((o for o in outputs if "prob" in o.lower()), outputs[-1])
        for pdf in batches:
            x = np.stack(pdf[features].to_numpy()).astype(np.float32)
            raw = sess.run([pick], {name: x})[0]
            if isinstance(raw, list):  # zipmap output: list of {label: prob}
                p = np.asarray([r.get(1, r.get("1", 0.0)) for r in raw], dtype=np.float64)
            else:
                raw = np.asarray(raw)
                p = raw if raw.ndim == 1 else (raw[:, 0] if raw.shape[1] == 1 else raw[:, 1])
            out = pdf[keep].copy()
            out["score"] = p.astype(np.float64)
            out["prediction"] = (p >= threshold).astype(np.int64)
            yield out

    return df.select(*keep, features).mapInPandas(run, schema)


def check_vectors(df: DataFrame, column: str, expected: int | None = None,
                  key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """M5: (good, quarantine). Without ``expected`` the reference length is the
    length of the first row by ``key`` order (the batch's first vector).

    Finding the first row is a global min over the key (partial aggregation),
    not a sort.
    """
    n = F.size(F.col(column))
    if expected is None:
        if key is None:
            raise ValueError("key is required when expected length is not given")
        first = df.where(F.col(column).isNotNull()).agg(
            F.min_by(n, F.col(key)).alias("_expected"))
        tagged = df.withColumn("_g", F.lit(0)).join(F.broadcast(first.withColumn("_g", F.lit(0))), "_g").drop("_g")
    else:
        tagged = df.withColumn("_expected", F.lit(int(expected)))
    status = (F.when(F.col(column).isNull() | (n == 0), F.lit("empty"))
              .when(n != F.col("_expected"), F.lit("length_mismatch"))
              .otherwise(F.lit("ok")))
    tagged = tagged.withColumn("length", n).withColumn("status", status)
    good = tagged.where(F.col("status") == "ok").drop("_expected", "status")
    bad = tagged.where(F.col("status") != "ok").withColumn(
        "message", F.when(F.col("status") == "empty", F.lit("features list must not be empty"))
        .otherwise(F.format_string("Row has %d features, expected %d", F.col("length"), F.col("_expected"))))
    return good, bad.drop("_expected")


def score_parity(a: DataFrame, b: DataFrame, key: str, score_a: str = "score",
                 score_b: str = "score", tol: float = 1e-3) -> DataFrame:
    """M7: one row -- row counts, unmatched rows, non-finite scores, largest
    absolute difference and whether the two scorers agree within ``tol``."""
    x = a.select(F.col(key).alias("_k"), F.col(score_a).cast("double").alias("_pa"), F.lit(1).alias("_ina"))
    y = b.select(F.col(key).alias("_k"), F.col(score_b).cast("double").alias("_pb"), F.lit(1).alias("_inb"))
    j = x.join(y, on="_k", how="full_outer")
    both = F.col("_ina").isNotNull() & F.col("_inb").isNotNull()

    def bad(c):
        return c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))

    nonfinite = both & (bad(F.col("_pa")) | bad(F.col("_pb")))
    out = j.agg(
        F.count("_ina").alias("rows_a"), F.count("_inb").alias("rows_b"),
        count_where(both).alias("matched"),
        count_where(F.col("_ina").isNull()).alias("missing_in_a"),
        count_where(F.col("_inb").isNull()).alias("missing_in_b"),
        count_where(nonfinite).alias("nonfinite"),
        F.max(F.abs(F.col("_pa") - F.col("_pb"))).alias("max_abs_diff"),
    )
    ok = ((F.col("missing_in_a") + F.col("missing_in_b") == 0) & (F.col("nonfinite") == 0)
          & (F.coalesce(F.col("max_abs_diff"), F.lit(0.0)) <= F.lit(tol)))
    return out.withColumn("passed", ok)


def first_rows(df: DataFrame, order_by: str | Sequence[str], limit: int = 512) -> DataFrame:
    """M6: the first ``limit`` rows by an explicit order (top-k, not a sort)."""
    return df.orderBy(*([order_by] if isinstance(order_by, str) else order_by)).limit(limit)

