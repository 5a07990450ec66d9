"""Cohorts by first month and their retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyloom.functions.exprs import month_gap, month_start
from tallyloom.session import cut_lineage


def cohort_counts(transactions: DataFrame, customer: str = "customer_id", ts: str = "invoice_date") -> DataFrame:
    """Distinct customers per first month and months elapsed since.

    Lines are reduced to distinct (customer, month) pairs first: a window group is then at most the number
    of months, and counting pairs counts customers.
    """
    active = transactions.filter(F.col(customer).isNotNull()).select(customer, month_start(ts).alias("month")).distinct()
    first = F.min("month").over(Window.partitionBy(customer))
    cohorts = active.withColumn("cohort_month", first)
    elapsed = month_gap("cohort_month", "month").alias("months_elapsed")
    return cohorts.groupBy("cohort_month", elapsed).agg(F.count(F.lit(1)).alias("customers"))


def cohort_retention(counts: DataFrame) -> DataFrame:
    """The counts with their percentage of the cohort's first month."""
    base = F.max(F.when(F.col("months_elapsed") == 0, F.col("customers"))).over(Window.partitionBy("cohort_month"))
    share = F.bround(F.col("customers").cast("double") / base.cast("double"), 3) * 100
    return counts.withColumn("retention_pct", F.round(share, 1))


def cohort_matrix(retention: DataFrame, value: str = "retention_pct") -> DataFrame:
    """One row per cohort with an array of its values for every elapsed month, from 0 to the last that any cohort has; NULL where a month has none.

    The schema does not depend on the data. A cohort's cells are one aggregate, bounded by the number of months; the last month is a scalar of the same counts,
    which are written once, as both read them.
    """
    counted = cut_lineage(retention.select("cohort_month", "months_elapsed", value))
    last = counted.agg(F.coalesce(F.max("months_elapsed"), F.lit(0))).scalar()
    cells = counted.groupBy("cohort_month").agg(F.map_from_entries(F.collect_list(F.struct("months_elapsed", value))).alias("_cells"))
    spine = cells.withColumn("_months", F.sequence(F.lit(0), last.cast("int")))
    return spine.select("cohort_month", F.transform("_months", lambda m: F.try_element_at("_cells", m)).alias("cells"))


def shown_cells(matrix: DataFrame, gap: str = "-") -> DataFrame:
    """The matrix as lines of text, one per cohort."""
    text = F.transform("cells", lambda c: F.coalesce(c.cast("string"), F.lit(gap)))
    return matrix.select("cohort_month", F.size("cells").alias("months"), F.array_join(text, " ").alias("cells"))
