"""Helpers the corpus operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.session import scratch_path

ASCII_SPACE = " \t\n\x0b\x0c\r"
_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read back: cuts lineage,
    survives lost executors and lets several consumers share one computation."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold_of(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds`` (null key: null)."""
    return F.crc32(key.cast("string").cast("binary")) % folds


def text_slices(texts: list, limit: int = 4_000_000) -> Iterator[slice]:
    """Consecutive slices of ``texts`` with about ``limit`` characters each; a longer text is alone.
    Bounds what one step holds; nothing is cut or skipped."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if i > start and held + len(t) > limit:
            yield slice(start, i)
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) over an array of uint64."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
