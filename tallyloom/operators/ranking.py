"""Top lists by product, customer, country and other dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.exprs import differs_or_null, ratio
from tallyloom.operators.binning import TIER_LABELS, quantile_tiers
from tallyloom.session import cut_lineage


def top_k(df: DataFrame, by: str, k: int = 10, tie: str | None = None) -> DataFrame:
    """The k rows with the largest value; ties are broken by a second column."""
    keys = [F.col(by).desc_nulls_last()] + ([F.col(tie).asc_nulls_last()] if tie else [])
    return df.orderBy(*keys).limit(k)


def total_by(df: DataFrame, key: str, measure: str) -> DataFrame:
    """Sum of a measure per known key; rows without a key are left out."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum(measure).alias(measure))


def top_products(df: DataFrame, measure: str = "revenue", k: int = 10) -> DataFrame:
    return top_k(total_by(df, "description", measure), measure, k, "description")


def top_customers_by_revenue(df: DataFrame, k: int = 10) -> DataFrame:
    return top_k(total_by(df, "customer_id", "revenue"), "revenue", k, "customer_id")


def top_customers_by_invoices(df: DataFrame, k: int = 10) -> DataFrame:
    known = df.filter(F.col("customer_id").isNotNull())
    counted = known.groupBy("customer_id").agg(F.count_distinct("invoice").alias("number_of_invoices"))
    return top_k(counted, "number_of_invoices", k, "customer_id")


def top_customers_by_mean(df: DataFrame, k: int = 10, per: str = "line") -> DataFrame:
    """Mean revenue per line, or per invoice with `per="invoice"`."""
    units = {"line": F.count("revenue"), "invoice": F.count_distinct("invoice")}[per]
    known = df.filter(F.col("customer_id").isNotNull())
    spend = known.groupBy("customer_id").agg(ratio(F.sum("revenue"), units).alias("average_spend"))
    return top_k(spend, "average_spend", k, "customer_id")


def account_drilldown(df: DataFrame, customer: int | Column | DataFrame, n: int = 20) -> DataFrame:
    """The first lines of one customer, in time order; `customer` is an id or a table that holds it.

    A table found from the same lines is joined, so that both read one shuffle of them.
    """
    columns = ["invoice", "description", "quantity", "price", "revenue"]
    lines = df.join(customer, "customer_id") if isinstance(customer, DataFrame) else df.filter(F.col("customer_id") == customer)
    order = ["invoice_date", "invoice", F.col("description").asc_nulls_last(), "quantity", "price"]
    return lines.orderBy(*order).limit(n).select(*columns)


def kth_customer(df: DataFrame, k: int) -> DataFrame:
    """One row with the customer at place k of the revenue list; NULL if the list is shorter."""
    top = top_customers_by_revenue(df, k).agg(F.array_sort(F.collect_list(F.struct((-F.col("revenue")).alias("r"), "customer_id"))).alias("top"))
    return top.select(F.try_element_at("top", F.lit(k))["customer_id"].alias("customer_id"))


def kth_customer_by_revenue(df: DataFrame, k: int) -> Column:
    """The same as a scalar."""
    return kth_customer(df, k).scalar()


def country_revenue(df: DataFrame) -> DataFrame:
    return total_by(df, "country", "revenue")


def country_revenue_tiers(df: DataFrame) -> DataFrame:
    return quantile_tiers(country_revenue(df), "revenue", TIER_LABELS, "revenue_tier")


def country_customers(df: DataFrame) -> DataFrame:
    """Distinct known customers per country."""
    known = df.filter(F.col("customer_id").isNotNull() & F.col("country").isNotNull())
    return known.groupBy("country").agg(F.count_distinct("customer_id").alias("number_of_customers"))


def country_customer_tiers(df: DataFrame) -> DataFrame:
    """A single customer is the lowest tier; the other countries fall into four quantile bins."""
    alone = (F.col("number_of_customers") == 1, TIER_LABELS[0])
    return quantile_tiers(country_customers(df), "number_of_customers", TIER_LABELS[1:], "customer_tier", alone)


def revenue_per_customer(df: DataFrame) -> DataFrame:
    """Revenue, customers and their ratio per country; no customer gives a NULL ratio.

    Lines are summed per (country, customer) first, so the home market is spread over all tasks.
    """
    lines = df.filter(F.col("country").isNotNull())
    per_customer = lines.groupBy("country", "customer_id").agg(F.sum("revenue").alias("revenue"))
    totals = per_customer.groupBy("country").agg(
        F.sum("revenue").alias("total_revenue"), F.count("customer_id").alias("unique_customers")
    )
    return totals.withColumn("avg_revenue_per_customer", ratio("total_revenue", "unique_customers"))


def revenue_per_customer_tiers(df: DataFrame) -> DataFrame:
    """The lowest ratio is the lowest tier; the others fall into four quantile bins; a NULL ratio has no tier."""
    ratios = cut_lineage(revenue_per_customer(df))  # read for the lowest ratio and for the tiers
    value = F.col("avg_revenue_per_customer")
    lowest = ratios.agg(F.min("avg_revenue_per_customer")).scalar()
    is_lowest = F.coalesce(value == lowest, F.lit(False))
    return quantile_tiers(ratios, "avg_revenue_per_customer", TIER_LABELS[1:], "revenue_tier", (is_lowest, TIER_LABELS[0]))


def top_revenue_per_customer(df: DataFrame, k: int = 10) -> DataFrame:
    with_customers = revenue_per_customer(df).filter(F.col("unique_customers") > 0)
    return top_k(with_customers, "avg_revenue_per_customer", k, "country")


def without(df: DataFrame, column: str, value) -> DataFrame:
    """Rows that differ from a value; rows without a value stay."""
    return df.filter(differs_or_null(column, value))


def profit_by(df: DataFrame, dimension: str | Column, name: str, measure: str = "profit") -> DataFrame:
    """Total profit per value of a dimension."""
    return df.groupBy((F.col(dimension) if isinstance(dimension, str) else dimension).alias(name)).agg(F.sum(measure).alias(measure))


def extremes(totals: DataFrame, name: str, measure: str = "profit", k: int = 10) -> DataFrame:
    """The k largest and the k smallest totals."""
    most = totals.orderBy(F.col(measure).desc(), name).limit(k).withColumn("end", F.lit("most"))
    least = totals.orderBy(F.col(measure).asc(), name).limit(k).withColumn("end", F.lit("least"))
    return most.unionByName(least)


