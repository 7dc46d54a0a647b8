"""Scalar column expressions.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
it stays inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Unicode-aware whitespace trim: Spark's ``trim`` strips only U+0020.
_WS_TRIM = r"(?U)^\s+|\s+$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_code(c: str | Column) -> Column:
    """Cast to string, strip surrounding whitespace, upper-case."""
    return F.upper(F.regexp_replace(_col(c).cast("string"), _WS_TRIM, ""))


def lenient(c: str | Column, type_name: str) -> Column:
    """Cast that yields null instead of failing (ANSI-safe)."""
    return _col(c).try_cast(type_name)


def any_null(cols: Iterable[str | Column]) -> Column:
    """True when any of the columns is null (NaN is not null)."""
    return reduce(lambda a, b: a | b, [_col(c).isNull() for c in cols])


def count_where(cond: Column) -> Column:
    """Number of rows where ``cond`` is true (null counts as false)."""
    return F.count(F.when(cond, F.lit(1)))


def sum_where(cond: Column, weight: str | Column) -> Column:
    """Sum of ``weight`` over rows where ``cond`` is true; 0 when none."""
    return F.coalesce(F.sum(F.when(cond, _col(weight))), F.lit(0)).cast("long")


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as double, 0.0 when the denominator is 0 or null."""
    d = _col(den).cast("double")
    return F.when(d.isNull() | (d == 0), F.lit(0.0)).otherwise(_col(num).cast("double") / d)


def order_key(seed: int, keys: Iterable[str | Column]) -> Column:
    """Seeded, engine-independent row order: md5 hex of ``seed|key...``."""
    parts = [F.lit(str(seed))] + [_col(k).cast("string") for k in keys]
    return F.md5(F.concat_ws("|", *parts))


def ts_lit(value: str | datetime, ntz: bool = True) -> Column:
    """Timestamp literal; NTZ by default so it compares without zone shifts."""
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(value).cast("timestamp_ntz" if ntz else "timestamp")


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` that treats null keys as equal, like ``groupBy``
    does, so joining two per-group results never loses the null group."""
    if not keys:
        raise ValueError("join keys are required")
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys]
    out = left.join(r, cond, how)
    if how in ("left_semi", "left_anti"):
        return out
    return out.drop(*[f"__r_{k}" for k in keys])
