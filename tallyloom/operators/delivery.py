"""Order volumes, delivery metrics, revenue and cost of a delivery service.

Pizzas are counted per order before the join with deliveries, so an order of any size is one small row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.exprs import minutes_between, percent, rounded_ratio, seconds_between
from tallyloom.operators.lists import list_size

# fixed values: price by pizza id, fee per extra topping, runner pay per kilometre
PIZZA_PRICES = {1: 12, 2: 10}
EXTRA_FEE = 1
COST_PER_KM = "0.30"


def delivered(runner_orders: DataFrame) -> DataFrame:
    """Orders that were not cancelled (after cleaning)."""
    return runner_orders.filter(F.col("cancellation").isNull())


def deliveries_per_runner(runner_orders: DataFrame) -> DataFrame:
    return delivered(runner_orders).groupBy("runner_id").agg(F.count_distinct("order_id").alias("successful_orders"))


def pizzas_per_order(customer_orders: DataFrame, *keys: str | Column, rows: bool = False) -> DataFrame:
    """Known pizzas per order; with `rows`, lines without a pizza id count too."""
    return customer_orders.groupBy("order_id", *keys).agg(F.count(F.lit(1) if rows else "pizza_id").alias("pizzas"))


def deliveries_by_type(customer_orders: DataFrame, runner_orders: DataFrame, names: DataFrame) -> DataFrame:
    done = delivered(runner_orders).select("order_id")
    counted = pizzas_per_order(customer_orders, "pizza_id").join(done, "order_id").groupBy("pizza_id").agg(F.sum("pizzas").alias("total_deliveries"))
    return counted.join(names, "pizza_id").select("pizza_id", "pizza_name", "total_deliveries")


def orders_by_customer_and_type(customer_orders: DataFrame, names: DataFrame) -> DataFrame:
    counted = customer_orders.groupBy("customer_id", "pizza_id").agg(F.count("pizza_id").alias("n"))
    return counted.join(names, "pizza_id").groupBy("customer_id", "pizza_name").agg(F.sum("n").alias("total_orders"))


def largest_order(customer_orders: DataFrame, runner_orders: DataFrame | None = None) -> DataFrame:
    """Most pizzas in one order; with `runner_orders`, among delivered orders only."""
    sizes = pizzas_per_order(customer_orders)
    if runner_orders is not None:
        sizes = sizes.join(delivered(runner_orders).select("order_id"), "order_id")
    return sizes.agg(F.max("pizzas").alias("most_pizzas_ordered"))


def changes_by_customer(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    """Delivered pizzas with and without a change, per customer."""
    changed = F.col("exclusions").isNotNull() | F.col("extras").isNotNull()
    counted = pizzas_per_order(customer_orders, "customer_id", F.when(changed, "YES").otherwise("NO").alias("changes"), rows=True)
    done = delivered(runner_orders).select("order_id")
    return counted.join(done, "order_id").groupBy("customer_id", "changes").agg(F.sum("pizzas").alias("total"))


def both_changes(customer_orders: DataFrame, runner_orders: DataFrame, delivered_only: bool = False) -> DataFrame:
    """Pizzas with exclusions and extras. As written it counts cancelled orders; `delivered_only` counts delivered ones."""
    both = customer_orders.filter(F.col("exclusions").isNotNull() & F.col("extras").isNotNull())
    state = F.col("cancellation")
    done = runner_orders.filter(state.isNull() if delivered_only else state.isNotNull()).select("order_id")
    return pizzas_per_order(both, rows=True).join(done, "order_id").agg(F.coalesce(F.sum("pizzas"), F.lit(0)).alias("count"))


def minutes_to_arrive(customer_orders: DataFrame, runner_orders: DataFrame, per_order: bool = False) -> DataFrame:
    """Mean minutes from order to pickup per runner.

    As written every pizza row counts, so large orders weigh more; `per_order` weighs orders equally.
    """
    orders = pizzas_per_order(customer_orders, "order_time", rows=True).join(runner_orders.select("order_id", "runner_id", "pickup_time"), "order_id")
    wait = seconds_between("order_time", "pickup_time")
    weight = F.lit(1) if per_order else F.col("pizzas")
    seconds = F.sum(wait * weight)
    counted = F.sum(F.when(wait.isNotNull(), weight))
    return orders.groupBy("runner_id").agg(rounded_ratio(seconds, counted * 60, 2).alias("avg_minutes_to_arrive"))


def prep_time(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    """Pizzas and minutes to pickup per delivered order."""
    orders = pizzas_per_order(customer_orders, "order_time").join(delivered(runner_orders), "order_id")
    seconds = seconds_between("order_time", "pickup_time")
    return orders.select(
        "order_id",
        F.col("pizzas").alias("pizzas_ordered"),
        minutes_between("order_time", "pickup_time").alias("prep_time_minutes"),
        rounded_ratio(seconds, F.col("pizzas") * 60, 2).alias("prep_time_per_pizza"),
    )


def distance_per_customer(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    """Mean distance per customer over delivered orders, each order once."""
    orders = customer_orders.select("customer_id", "order_id").distinct()
    done = delivered(runner_orders).select("order_id", "distance")
    mean = rounded_ratio(F.sum("distance"), F.count("distance"), 2)
    return orders.join(done, "order_id").groupBy("customer_id").agg(mean.alias("avg_distance_km"))


def delivery_spread(runner_orders: DataFrame) -> DataFrame:
    return delivered(runner_orders).agg((F.max("duration") - F.min("duration")).alias("delivery_time_difference_minutes"))


def speed() -> Column:
    """Kilometres per hour from kilometres and minutes."""
    return rounded_ratio(F.col("distance") * 60, F.col("duration"), 2)


def delivery_speeds(runner_orders: DataFrame) -> DataFrame:
    return delivered(runner_orders).select("order_id", "runner_id", speed().alias("avg_speed_kmh"))


def success_rate(runner_orders: DataFrame) -> DataFrame:
    done = F.count(F.when(F.col("cancellation").isNull(), 1))
    return runner_orders.groupBy("runner_id").agg(percent(done, F.count(F.lit(1)), 2).alias("successful_delivery_pct"))


def price_of(prices: Mapping[int, int], pizza_id: str = "pizza_id") -> Column:
    """Price by id; an id without a price gives NULL, which sums ignore."""
    priced = F.when(F.lit(False), F.lit(None).cast("int"))
    for pizza, price in prices.items():
        priced = priced.when(F.col(pizza_id) == pizza, price)
    return priced


def revenue(customer_orders: DataFrame, runner_orders: DataFrame, prices: Mapping[int, int] = PIZZA_PRICES, extra_fee: int = 0) -> DataFrame:
    """Income from delivered pizzas, plus a fee per extra topping."""
    done = delivered(runner_orders).select("order_id")
    orders = customer_orders.groupBy("order_id").agg(
        F.sum(price_of(prices)).alias("base"), F.sum(list_size("extras")).alias("extras")
    )
    total = F.sum("base") + F.coalesce(F.sum(F.col("extras") * extra_fee), F.lit(0))
    return orders.join(done, "order_id").agg(total.alias("revenue"))


def net_money(customer_orders: DataFrame, runner_orders: DataFrame, cost_per_km: str = COST_PER_KM) -> DataFrame:
    """Revenue, runner cost and what is left. Both totals are single values."""
    income = revenue(customer_orders, runner_orders).scalar()
    cost = F.sum(F.col("distance") * F.lit(cost_per_km).cast("decimal(6,2)"))
    totals = delivered(runner_orders).agg(cost.alias("total_runner_cost")).withColumn("total_revenue", income)
    return totals.select("total_revenue", "total_runner_cost", F.round(F.col("total_revenue") - F.col("total_runner_cost"), 2).alias("money_left_over"))


def delivery_summary(customer_orders: DataFrame, runner_orders: DataFrame, ratings: DataFrame) -> DataFrame:
    """One row per delivered and rated order."""
    orders = customer_orders.groupBy("order_id", "customer_id").agg(
        F.min("order_time").alias("order_time"), F.count(F.lit(1)).alias("total_pizzas")
    )
    return (
        orders.join(delivered(runner_orders), "order_id")
        .join(ratings.select("order_id", "rating"), "order_id")
        .select(
            "customer_id",
            "order_id",
            "runner_id",
            "rating",
            "order_time",
            "pickup_time",
            minutes_between("order_time", "pickup_time").alias("minutes_between_order_and_pickup"),
            F.col("duration").alias("delivery_duration_minutes"),
            speed().alias("avg_speed_kmh"),
            "total_pizzas",
        )
    )
