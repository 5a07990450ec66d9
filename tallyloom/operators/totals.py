"""Totals per month that are kept up to date by batches, without reading old rows again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.functions.exprs import month_start
from tallyloom.operators.calendar import monthly_revenue
from tallyloom.sources.writers import append_batch, read_batches

MONTH, TOTAL, ROWS = "month", "total", "rows"


def month_state(df: DataFrame, ts: str = "invoice_date", measure: str = "revenue") -> DataFrame:
    """Sum and number of rows per month: the state of a batch, with one row per month, reduced before the shuffle."""
    return df.groupBy(month_start(ts).alias(MONTH)).agg(F.sum(measure).alias(TOTAL), F.count(F.lit(1)).alias(ROWS))


def merge_states(states: DataFrame) -> DataFrame:
    """States of any rows and batches put together; the order does not matter."""
    return states.groupBy(MONTH).agg(F.sum(TOTAL).alias(TOTAL), F.sum(ROWS).alias(ROWS))


def add_batch(df: DataFrame, path: str, batch: str, ts: str = "invoice_date", measure: str = "revenue") -> None:
    """Reduce a batch and store its state; sent again, it replaces itself."""
    append_batch(month_state(df, ts, measure), path, batch)


def current_months(spark: SparkSession, path: str, measure: str = "revenue") -> DataFrame:
    """Totals per month end from all stored states, months without rows as 0: what `monthly_revenue` gives over all rows."""
    merged = merge_states(read_batches(spark, path))
    return monthly_revenue(merged.withColumnsRenamed({MONTH: "_day", TOTAL: measure}), "_day", measure)
