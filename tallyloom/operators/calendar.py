"""Counts by hour, weekday, week and month, and gap-free monthly series."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.exprs import month_start, ratio, week_number, weekday_label


def volume_by_hour(df: DataFrame, ts: str = "order_time", out: str = "pizzas_ordered") -> DataFrame:
    return df.groupBy(F.hour(ts).alias("hour_of_day")).agg(F.count(F.lit(1)).alias(out))


def volume_by_weekday(df: DataFrame, ts: str = "order_time", out: str = "pizzas_ordered") -> DataFrame:
    return df.groupBy(weekday_label(ts).alias("day_of_week")).agg(F.count(F.lit(1)).alias(out))


def volume_by_week(df: DataFrame, day: str, first_day: str, out: str) -> DataFrame:
    """Rows per seven-day week counted from a given first day."""
    return df.groupBy(week_number(day, first_day).alias("week_no")).agg(F.count(F.lit(1)).alias(out))


def volume_by_month(df: DataFrame, day: str, out: str) -> DataFrame:
    return df.groupBy(month_start(day).alias("month_start")).agg(F.count(F.lit(1)).alias(out))


def monthly_revenue(df: DataFrame, ts: str = "invoice_date", measure: str = "revenue") -> DataFrame:
    """Sum per calendar month from the first to the last month; months without rows are 0. Labelled by month end.

    The monthly totals, of which there are as many as months, become one map; the months are spelled out beside it. So the table is read in one pass.
    """
    totals = df.groupBy(month_start(ts).alias("month")).agg(F.sum(measure).alias(measure)).filter(F.col("month").isNotNull())
    known = F.map_from_entries(F.collect_list(F.struct("month", measure)))
    months = F.sequence(F.min("month"), F.max("month"), F.expr("interval 1 month"))
    spine = totals.agg(known.alias("known"), months.alias("months")).select("known", F.explode("months").alias("month"))
    return spine.select(F.last_day("month").alias("month_end"), F.coalesce(F.try_element_at("known", "month"), F.lit(0)).alias(measure))


def with_overall_mean(series: DataFrame, measure: str = "revenue", out: str = "mean_revenue") -> DataFrame:
    """The series with its mean as a reference line."""
    mean = series.agg(ratio(F.sum(measure), F.count(F.lit(1))).alias(out)).scalar()
    return series.withColumn(out, mean)
