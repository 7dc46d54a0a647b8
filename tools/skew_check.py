"""Skew check: one OperationId holds a third of the rows (continuous values).

Times the exact per-group p95 (tabspark) against Spark's built-in
``percentile`` and checks the hot group's value against numpy. Synthetic
input from ``spark.range`` -- a measurement tool, not a registered query.

Usage: python tools/skew_check.py [rows] [cpus]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 6_000_000
    cpus = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    import numpy as np
    from pyspark.sql import functions as F

    from tabspark.functions.quantiles import exact_percentiles
    from tabspark.session import checkpoint_dir, get_session, materialize
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus * 2)
    checkpoint_dir(spark)
    df = spark.range(rows, numPartitions=cpus * 4).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50_000 + 1).alias("OperationId"),
        (F.rand(7) * 1000 + F.col("id") % 97 / 1000.0).alias("DurationMs"))
    df = materialize(df, "skew-input")

    def run(label, frame):
        t0 = time.perf_counter()
        frame.write.format("noop").mode("overwrite").save()
        print(f"{label}: {time.perf_counter() - t0:.2f}s", flush=True)

    exact = exact_percentiles(df, ["OperationId"], "DurationMs", {"p95": 0.95})
    builtin = df.groupBy("OperationId").agg(F.percentile("DurationMs", 0.95).alias("p95"))
    run("tabspark exact_percentiles (skew-safe)", exact)
    run("built-in percentile (hot group merged in one task)", builtin)
    hot = exact.where("OperationId = 0").first()["p95"]
    vals = np.array([r[0] for r in df.where("OperationId = 0").select("DurationMs").collect()])
    print(f"hot group rows={len(vals)} p95={hot:.9f} numpy={np.percentile(vals, 95):.9f}")


if __name__ == "__main__":
    main()
