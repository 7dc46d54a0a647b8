"""Property tests (Hypothesis) for the allocation rule and exact percentiles."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tabspark.functions.quantiles import exact_percentiles
from tabspark.operators.split import allocate_counts

fractions = st.tuples(st.integers(0, 100), st.integers(0, 100), st.integers(0, 100)).filter(
    lambda t: sum(t) > 0).map(lambda t: tuple(x / sum(t) for x in t))


@given(st.integers(0, 10**7), fractions)
def test_allocation_is_exact_and_close(total, fr):
    counts = allocate_counts(total, fr)
    assert sum(counts) == total
    for c, f in zip(counts, fr):
        assert abs(c - f * total) < 1.0 + 1e-9 and c >= 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-5000, 5000), min_size=1, max_size=60), st.sampled_from([0.0, 0.25, 0.5, 0.95, 0.99, 1.0]))
def test_exact_percentile_matches_numpy(spark, values, p):
    vals = [v / 100 for v in values]   # two decimals, negatives, ties
    df = spark.createDataFrame([("g", v) for v in vals], "g string, v double")
    got = exact_percentiles(df, ["g"], "v", {"q": p}).first()["q"]
    assert abs(got - float(np.percentile(np.array(vals), p * 100))) < 1e-9
