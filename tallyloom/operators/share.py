"""Shares of a total within groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tallyloom.functions.exprs import percent

# fixed values: last year with observed figures; later years are projections
LAST_OBSERVED_YEAR = 2022


def channel_share_by_year(df: DataFrame, last_observed: int = LAST_OBSERVED_YEAR) -> DataFrame:
    """Spend per channel and year, its share of the year and whether the year is a projection.

    The window runs over one row per channel and year.
    """
    totals = df.groupBy("year", "channel").agg(F.sum("spend").alias("spend"))
    of_year = F.sum("spend").over(Window.partitionBy("year"))
    return totals.select(
        "year", "channel", "spend", percent(F.col("spend"), of_year, 2).alias("share_pct"), (F.col("year") > last_observed).alias("projected")
    )


def digital_share_by_year(df: DataFrame, digital: Sequence[str], last_observed: int = LAST_OBSERVED_YEAR) -> DataFrame:
    """The same with channels grouped into digital and traditional."""
    kind = F.when(F.col("channel").isin(*digital), "digital").otherwise("traditional")
    return channel_share_by_year(df.withColumn("channel", kind), last_observed)
