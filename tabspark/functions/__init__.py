"""Column-expression helpers shared by the operators (all JVM-side)."""

from tabspark.functions.columns import (
    any_null,
    count_where,
    join_null_safe,
    lenient,
    normalize_code,
    order_key,
    safe_ratio,
    sum_where,
    ts_lit,
)
from tabspark.functions.quantiles import exact_mean, exact_percentiles, exact_sum, percentile_expr, value_bucket

__all__ = [
    "any_null", "count_where", "join_null_safe", "lenient", "normalize_code", "order_key",
    "safe_ratio", "sum_where", "ts_lit", "exact_mean", "exact_percentiles", "exact_sum",
    "percentile_expr", "value_bucket",
]
