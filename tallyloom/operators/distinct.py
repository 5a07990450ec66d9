"""Distinct counts that add up: mergeable sketches per group, unioned for any coarser grouping. Exact counts stay the default elsewhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Registers are 2 ** BITS; the relative standard error of an estimate is 1.04 / 2 ** (BITS / 2). A sketch takes at most 2 ** BITS bytes.
BITS = 12


def sketches(df: DataFrame, keys: Sequence[str], column: str, bits: int = BITS) -> DataFrame:
    """One sketch of a column's values per group; NULL is no value. Rows are reduced to sketches before the shuffle, so a group of any size sends one per task."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(column), F.lit(bits)).alias("sketch"))


def union(found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches of finer groups put together."""
    return found.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimate(found: DataFrame, out: str = "distinct_values") -> DataFrame:
    return found.withColumn(out, F.hll_sketch_estimate("sketch")).drop("sketch")


def error(bits: int = BITS, deviations: int = 4) -> float:
    """The relative error that an estimate stays within, but for a few cases in 100,000."""
    return deviations * 1.04 / 2 ** (bits / 2)


def within(estimated: str | Column, exact: str | Column, bits: int = BITS) -> Column:
    """Whether an estimate lies within the stated error of the exact number."""
    estimated, exact = (F.col(c) if isinstance(c, str) else c for c in (estimated, exact))
    return F.abs(estimated - exact) <= F.greatest(F.lit(1.0), exact * F.lit(error(bits)))
