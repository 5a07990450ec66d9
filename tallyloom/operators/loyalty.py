"""Spend, visits, favourites, membership anchors and points.

Facts are counted per (customer, product) before the menu join, so a customer or product with a large
share of the rows is reduced on the map side and the join moves counts, not rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.functions.exprs import flag
from tallyloom.operators.sequence import top_ranked

# fixed values: points per unit of price, and length of the bonus period in days
BASE_POINTS = 10
DOUBLE_POINTS = 20
BONUS_DAYS = 7


def count_rows(df: DataFrame, *keys: str | Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def spend_by_entity(sales: DataFrame, menu: DataFrame, key: str = "customer_id") -> DataFrame:
    """Total price of everything a key bought."""
    counted = count_rows(sales, key, "product_id").join(menu.select("product_id", "price"), "product_id")
    return counted.groupBy(key).agg(F.sum(F.col("price") * F.col("n")).alias("total_amount_spent"))


def visit_days(sales: DataFrame, key: str = "customer_id", day: str = "order_date") -> DataFrame:
    return sales.groupBy(key).agg(F.count_distinct(day).alias("days_visited"))


def first_event_items(sales: DataFrame, menu: DataFrame, key: str = "customer_id", day: str = "order_date") -> DataFrame:
    """Distinct items of a known key's first day; sales without a day are left out."""
    first_bought = sales.filter(F.col(key).isNotNull() & F.col(day).isNotNull()).groupBy(key, "product_id").agg(F.min(day).alias(day))
    first = top_ranked(first_bought, key, F.col(day).asc_nulls_last())
    return first.join(menu.select("product_id", "product_name"), "product_id").select(key, "product_name").distinct()


def item_counts(sales: DataFrame, menu: DataFrame, top: int | None = None) -> DataFrame:
    """How often each item was ordered; `top` cuts the list."""
    counted = count_rows(sales, "product_id").join(menu.select("product_id", "product_name"), "product_id")
    counted = counted.groupBy("product_name").agg(F.sum("n").alias("times_ordered"))
    ordered = counted.orderBy(F.col("times_ordered").desc(), F.col("product_name"))
    return ordered.limit(top) if top else ordered


def favorite_item(sales: DataFrame, menu: DataFrame, key: str = "customer_id") -> DataFrame:
    """The item a key ordered most often, ties kept."""
    counted = count_rows(sales, key, "product_id").join(menu.select("product_id", "product_name"), "product_id")
    counted = counted.groupBy(key, "product_name").agg(F.sum("n").alias("times_ordered"))
    return top_ranked(counted, key, F.col("times_ordered").desc_nulls_first())


def nearest_event(
    sales: DataFrame,
    anchors: DataFrame,
    direction: str = "after",
    inclusive: bool | None = None,
    key: str = "customer_id",
    day: str = "order_date",
    anchor: str = "join_date",
) -> DataFrame:
    """Rows on the first day after, or the last day before, a key's anchor date; ties kept.

    By default the anchor day itself belongs to "after". The day is found on distinct (key, day) pairs and the
    rows are joined on both, so neither step gathers all rows of a large key.
    """
    inclusive = direction == "after" if inclusive is None else inclusive
    d, a = F.col(day), F.col(anchor)
    if direction == "after":
        on_side, nearest = (d >= a) if inclusive else (d > a), F.min(day)
    elif direction == "before":
        on_side, nearest = (d <= a) if inclusive else (d < a), F.max(day)
    else:
        raise ValueError(direction)
    days = sales.select(key, day).distinct().join(anchors.select(key, anchor), key).filter(on_side)
    return sales.join(days.groupBy(key).agg(nearest.alias(day)), [key, day])


def pre_anchor_totals(sales: DataFrame, menu: DataFrame, members: DataFrame, key: str = "customer_id") -> DataFrame:
    """Items and spend of each member before joining."""
    before = sales.join(members, key).filter(F.col("order_date") < F.col("join_date"))
    counted = count_rows(before, key, "product_id").join(menu.select("product_id", "price"), "product_id")
    return counted.groupBy(key).agg(
        F.sum("n").alias("total_items_ordered"), F.sum(F.col("price") * F.col("n")).alias("total_amount_spent")
    )


@dataclass(frozen=True)
class PointRules:
    """`special_id` or `special_name` earns double; so does everything in the bonus period, if there is one."""

    special_id: int | None = None
    special_name: str | None = None
    bonus_days: int = 0
    last_day: str | None = None
    base: int = BASE_POINTS
    double: int = DOUBLE_POINTS


def loyalty_points(
    sales: DataFrame, menu: DataFrame, rules: PointRules, members: DataFrame | None = None, key: str = "customer_id"
) -> DataFrame:
    """Points per key. With `members`, only members count and the bonus period starts on the joining day."""
    in_bonus: Column = F.lit(False)
    if rules.last_day:
        sales = sales.filter(F.col("order_date") <= F.lit(rules.last_day).cast("date"))
    if members is not None:
        sales = sales.join(members, key)
        in_bonus = F.col("order_date").between(F.col("join_date"), F.date_add("join_date", rules.bonus_days - 1))
    counted = count_rows(sales, key, "product_id", in_bonus.alias("in_bonus"))
    special = F.lit(False)
    if rules.special_id is not None:
        special = special | (F.col("product_id") == rules.special_id)
    if rules.special_name is not None:
        special = special | (F.col("product_name") == rules.special_name)
    rate = F.when(F.col("in_bonus") | special, rules.double).otherwise(rules.base)
    return (
        counted.join(menu, "product_id")
        .groupBy(key)
        .agg(F.sum(F.col("price") * rate * F.col("n")).alias("customer_points"))
    )


def _member_on(day: str, anchor: str) -> Column:
    return flag(F.col(day) >= F.col(anchor))


def membership_flag(sales: DataFrame, menu: DataFrame, members: DataFrame, key: str = "customer_id") -> DataFrame:
    """Every sale with its item and whether the customer was a member that day."""
    return (
        sales.join(menu, "product_id")
        .join(members, key, "left")
        .select(key, "order_date", "product_name", "price", _member_on("order_date", "join_date").alias("member"))
    )


def member_rank(sales: DataFrame, menu: DataFrame, members: DataFrame, key: str = "customer_id") -> DataFrame:
    """The flagged sales with a dense rank by day among a member's own days; NULL outside membership.

    The rank depends on the day only, so it is computed on distinct (customer, day) pairs: no window group
    is larger than the calendar. Sales without a customer or a day stay, outside membership.
    """
    days = sales.select(key, "order_date").distinct().join(members, key, "left")
    days = days.select(key, "order_date", _member_on("order_date", "join_date").alias("member"))
    w = Window.partitionBy(key, "member").orderBy(F.col("order_date").asc_nulls_last())
    ranked = days.withColumn("ranking", F.when(F.col("member") == "N", F.lit(None)).otherwise(F.dense_rank().over(w)))
    ranked = ranked.withColumnsRenamed({key: "_key", "order_date": "_day"})
    return (
        sales.join(ranked, F.col(key).eqNullSafe(F.col("_key")) & F.col("order_date").eqNullSafe(F.col("_day")))
        .join(menu, "product_id")
        .select(key, "order_date", "product_name", "price", "member", "ranking")
    )
