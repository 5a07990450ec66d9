"""Subscription events: journeys, transitions, state at a date, churn and time to an event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tallyloom.functions.exprs import concat_skip_null, month_start, percent, rounded_ratio
from tallyloom.operators.sequence import nth_rows, with_neighbors

# fixed values: plan ids
TRIAL, BASIC_MONTHLY, PRO_MONTHLY, PRO_ANNUAL, CHURN = range(5)

# Order of a customer's events; the id breaks ties between events of one day.
EVENT_ORDER = ("start_date", "event_id")


def customer_total(events: DataFrame):
    """Number of distinct customers, as a scalar."""
    return events.agg(F.count_distinct("customer_id")).scalar()


def customer_journey(events: DataFrame, plans: DataFrame, customers: Sequence[int] | None = None) -> DataFrame:
    """Plan history per customer; `customers` limits it to a sample."""
    if customers is not None:
        events = events.filter(F.col("customer_id").isin(*customers))
    return events.join(plans, "plan_id").select("customer_id", "plan_name", "start_date", "event_id")


def plan_sequence(events: DataFrame, plans: DataFrame) -> DataFrame:
    """Every event with its plan, the next plan and its place in the customer's history."""
    priced = events.join(plans, "plan_id").select("event_id", "customer_id", "plan_id", "plan_name", "price", "start_date")
    return with_neighbors(
        priced,
        "customer_id",
        EVENT_ORDER,
        following={"next_plan_id": "plan_id", "next_plan_name": "plan_name", "next_start_date": "start_date"},
        position="plan_order",
    )


def customers(events: DataFrame) -> DataFrame:
    return events.agg(F.count_distinct("customer_id").alias("total_customers"))


def trial_starts_by_month(events: DataFrame) -> DataFrame:
    trials = events.filter(F.col("plan_id") == TRIAL)
    return trials.groupBy(month_start("start_date").alias("month_start")).agg(F.count(F.lit(1)).alias("trial_starts"))


def events_after(events: DataFrame, plans: DataFrame, first_day: str) -> DataFrame:
    """Events per plan from a day on."""
    later = events.filter(F.col("start_date") >= F.lit(first_day).cast("date"))
    counted = later.groupBy("plan_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(plans, "plan_id").groupBy("plan_name").agg(F.sum("n").alias("event_count"))


def churn_rate(events: DataFrame, plan: int = CHURN) -> DataFrame:
    """Known customers who ever reached a plan, as count and percent. One row per customer, then one total."""
    per_customer = events.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(F.max((F.col("plan_id") == plan).cast("int")).alias("hit"))
    hits = F.coalesce(F.sum("hit"), F.lit(0))
    return per_customer.agg(hits.alias("churned_customers"), percent(hits, F.count("customer_id"), 1).alias("churn_pct"))


def transitions(events: DataFrame) -> DataFrame:
    """Each event with the plan that follows it directly."""
    narrow = events.select("event_id", "customer_id", "plan_id", "start_date")
    following = {"next_plan_id": "plan_id", "next_start_date": "start_date"}
    return with_neighbors(narrow, "customer_id", EVENT_ORDER, following=following)


def transition_rate(events: DataFrame, from_plan: int, to_plan: int) -> DataFrame:
    """Customers who moved directly from one plan to another, and their share of all customers."""
    moved = transitions(events).filter((F.col("plan_id") == from_plan) & (F.col("next_plan_id") == to_plan))
    total = customer_total(events)
    return (
        moved.agg(F.count_distinct("customer_id").alias("customers"))
        .withColumn("pct_of_customers", percent(F.col("customers"), total, 1))
    )


def _plan_mix(rows: DataFrame, events: DataFrame, plans: DataFrame) -> DataFrame:
    """Rows per plan (one row per customer) and percent of all customers."""
    counted = rows.groupBy("plan_id").agg(F.count(F.lit(1)).alias("n"))
    mix = counted.join(plans, "plan_id").groupBy("plan_name").agg(F.sum("n").alias("customer_count"))
    return mix.withColumn("pct_of_customers", percent(F.col("customer_count"), customer_total(events), 1))


def nth_plan_mix(events: DataFrame, plans: DataFrame, n: int = 2) -> DataFrame:
    """Which plan customers had as their n-th."""
    return _plan_mix(nth_rows(events, "customer_id", EVENT_ORDER, n), events, plans)


def plan_mix_as_of(events: DataFrame, plans: DataFrame, day: str) -> DataFrame:
    """Active plan per known customer at a date.

    The active event is the latest one started by then, so one aggregate per customer finds it.
    """
    started = events.filter(F.col("customer_id").isNotNull() & (F.col("start_date") <= F.lit(day).cast("date")))
    active = started.groupBy("customer_id").agg(F.max_by("plan_id", F.struct(*EVENT_ORDER)).alias("plan_id"))
    return _plan_mix(active, events, plans)


def plan_mix_by_day(events: DataFrame, plans: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Active customers per plan on every day of a period, with their share of all that are known; what `plan_mix_as_of` gives for one day.

    A sweep over interval ends: a customer is added to a plan on its first day and taken off on the day the next event starts. Ends of one day are summed
    before the running sums, so customers are read once and the windows run over days and plans only. What started before the period counts from its first day.
    """
    first, last = F.lit(first_day).cast("date"), F.lit(last_day).cast("date")
    dated = _dated(events).select("event_id", "customer_id", "plan_id", "start_date")
    # Of events on one day the last one holds, so the earlier ones need not be ordered among days.
    held = dated.groupBy("customer_id", "start_date").agg(F.max_by("plan_id", F.struct("start_date", "event_id")).alias("plan_id"))
    spans = with_neighbors(held, "customer_id", ("start_date",), following={"_until": "start_date"})
    end = lambda c, step: F.struct(F.when(F.col(c).isNotNull(), F.greatest(c, first)).alias("day"), F.lit(step).alias("step"))
    ends = F.array(end("start_date", 1), end("_until", -1))
    steps = spans.select("plan_id", F.explode(ends).alias("end")).select("plan_id", "end.*").filter(F.col("day").isNotNull() & (F.col("day") <= last))
    change = steps.groupBy("plan_id", "day").agg(F.sum("step").alias("change"))
    days = plans.select(F.col("plan_id").alias("_plan"), "plan_name").withColumn("day", F.explode(F.sequence(first, last, F.expr("interval 1 day"))))
    spine = days.join(change.withColumnRenamed("day", "_day"), (F.col("_plan") == F.col("plan_id")) & (F.col("day") == F.col("_day")), "left")
    running = F.sum(F.coalesce("change", F.lit(0))).over(Window.partitionBy("_plan").orderBy("day"))
    active = spine.select("day", F.col("_plan").alias("plan_id"), "plan_name", running.alias("customer_count"))
    return active.withColumn("pct_of_customers", percent(F.col("customer_count"), customer_total(events), 1))


def upgrades_in(events: DataFrame, plan: int, first_day: str, end_day: str) -> DataFrame:
    """Distinct customers whose `plan` started in the half-open period."""
    day = F.col("start_date")
    started = events.filter((F.col("plan_id") == plan) & (day >= F.lit(first_day).cast("date")) & (day < F.lit(end_day).cast("date")))
    return started.agg(F.count_distinct("customer_id").alias("upgraded_customers"))


def downgrades_in(events: DataFrame, from_plan: int, to_plan: int, first_day: str, end_day: str) -> DataFrame:
    """Distinct customers who moved directly between two plans in the half-open period."""
    day = F.col("next_start_date")
    moved = transitions(events).filter(
        (F.col("plan_id") == from_plan)
        & (F.col("next_plan_id") == to_plan)
        & (day >= F.lit(first_day).cast("date"))
        & (day < F.lit(end_day).cast("date"))
    )
    return moved.agg(F.count_distinct("customer_id").alias("downgraded_customers"))


def _dated(events: DataFrame) -> DataFrame:
    """Events that can be paired: those of a customer, on a day."""
    return events.filter(F.col("customer_id").isNotNull() & F.col("start_date").isNotNull())


def mean_days_between(events: DataFrame, from_plan: int, to_plan: int) -> DataFrame:
    """Mean days over all (from, to) event pairs of a known customer and known dates, without making the pairs.

    Per customer the sum over pairs is n_from * sum(to) - n_to * sum(from).
    """
    day = F.unix_date("start_date").cast("long")
    is_from, is_to = F.col("plan_id") == from_plan, F.col("plan_id") == to_plan
    sums = _dated(events).filter(is_from | is_to).groupBy("customer_id").agg(
        F.count_if(is_from).alias("n_from"),
        F.count_if(is_to).alias("n_to"),
        F.coalesce(F.sum(F.when(is_from, day)), F.lit(0)).alias("sum_from"),
        F.coalesce(F.sum(F.when(is_to, day)), F.lit(0)).alias("sum_to"),
    )

    def wide(c):
        return F.col(c).cast("decimal(19,0)")

    days = F.sum(wide("n_from") * wide("sum_to") - wide("n_to") * wide("sum_from"))
    pairs = F.sum(wide("n_from") * wide("n_to"))
    return sums.agg(rounded_ratio(days, pairs, 2).alias("avg_days"))


def days_histogram(events: DataFrame, from_plan: int, to_plan: int, low: int = 0, high: int = 360, buckets: int = 12) -> DataFrame:
    """Equal-width histogram of days over all (from, to) pairs of a known customer and known dates, without making the pairs.

    For every from-event and bucket edge, a running count tells how many to-events lie before that edge;
    differences of neighbouring edges are the buckets. Buckets 0 and n + 1 hold what lies outside. Events
    are first counted per day, so a window group is bounded by the calendar.
    """
    days = (
        _dated(events).filter(F.col("plan_id").isin(from_plan, to_plan))
        .groupBy("customer_id", "plan_id", F.unix_date("start_date").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    is_probe = F.col("plan_id") == from_plan
    # One probe per edge; the last one lies after every event and so counts all of them.
    edges = F.when(is_probe, F.sequence(F.lit(0), F.lit(buckets + 1))).otherwise(F.array(F.lit(None).cast("int")))
    edge = F.col("edge")
    # The first whole day at or above each edge of the range.
    first_days = F.array(*[F.lit(low + -(-k * (high - low) // buckets)) for k in range(buckets + 1)])
    at = F.when(edge.isNull(), F.col("day")).when(edge > buckets, 2**31 - 1).otherwise(F.col("day") + F.try_element_at(first_days, edge + 1))
    marks = days.withColumn("edge", F.explode(edges)).select(
        "customer_id",
        at.alias("day"),
        "edge",
        F.when(edge.isNotNull(), F.col("n")).alias("weight"),
        F.when(edge.isNull(), F.col("n")).otherwise(0).alias("hits"),
    )
    # Probes come before events of the same day: an edge counts what is strictly before it.
    order = [F.col("day"), F.col("edge").asc_nulls_last()]
    w = Window.partitionBy("customer_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    running = marks.withColumn("before", F.sum("hits").over(w))
    per_edge = running.filter(F.col("edge").isNotNull()).groupBy("edge").agg(F.sum(F.col("weight") * F.col("before")).alias("pairs"))
    # buckets + 2 rows from here on
    counts = per_edge.agg(F.array_sort(F.collect_list(F.struct("edge", "pairs"))).alias("edges")).select(F.posexplode("edges").alias("i", "edge"), "edges")
    earlier = F.when(F.col("i") == 0, 0).otherwise(F.try_element_at("edges", F.greatest(F.col("i"), F.lit(1)))["pairs"])
    number = F.col("edge.edge")
    below, above = (F.floor(F.lit(low) + k * F.lit(high - low) / F.lit(buckets)) for k in (number - 1, number))
    label = concat_skip_null(below, F.lit("-"), above, F.lit(" days"))
    return counts.select(
        number.alias("bucket_no"), label.alias("day_range"), (F.col("edge.pairs") - earlier).alias("customer_count")
    ).filter(F.col("customer_count") > 0)
