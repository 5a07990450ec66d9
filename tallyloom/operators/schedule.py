"""Payment dates and amounts generated from plan history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.exprs import month_gap
from tallyloom.operators.events import BASIC_MONTHLY, EVENT_ORDER, PRO_ANNUAL, PRO_MONTHLY
from tallyloom.operators.sequence import with_neighbors

MONTHLY_PLANS = (BASIC_MONTHLY, PRO_MONTHLY)


def monthly_dates(start: Column, months: Column) -> Column:
    """`start` and the next `months` dates, each one month after the one before.

    A date that falls beyond a month's end moves to that end and stays there, as repeated addition does.
    Only starts after the 28th can move, so all others are added in one step.
    """
    steps = F.sequence(F.lit(0), months)
    direct = F.transform(steps, lambda k: F.add_months(start, k))
    drifting = F.aggregate(
        F.sequence(F.lit(1), F.greatest(months, F.lit(1))),
        F.array(start),
        lambda dates, _: F.concat(dates, F.array(F.add_months(F.element_at(dates, -1), 1))),
    )
    return F.when((F.dayofmonth(start) <= 28) | (months == 0), direct).otherwise(drifting)


def payment_schedule(
    events: DataFrame, plans: DataFrame, horizon: str, credit: str = "same_day"
) -> DataFrame:
    """Payments per plan event up to a last day.

    A paid plan is paid on its start. Monthly plans repeat until the day before the next plan or until the
    horizon; the annual plan pays once. Neighbours are taken over the whole history, before unpaid plans
    are removed. `credit="same_day"` takes the previous price off a monthly plan after the basic one only
    if the next plan starts on the same day; `credit="upgrade"` does so for every such upgrade to another
    plan; `credit="none"` never does.
    """
    if credit not in ("same_day", "upgrade", "none"):
        raise ValueError(credit)
    priced = events.join(plans, "plan_id").select("event_id", "customer_id", "plan_id", "plan_name", "price", "start_date")
    ordered = with_neighbors(
        priced,
        "customer_id",
        EVENT_ORDER,
        following={"next_start_date": "start_date"},
        preceding={"prev_plan_id": "plan_id", "prev_price": "price"},
    )
    last_day = F.lit(horizon).cast("date")
    start = F.col("start_date")
    paid = ordered.filter(F.col("plan_id").isin(*MONTHLY_PLANS, PRO_ANNUAL) & (start <= last_day))
    after_basic = F.col("prev_plan_id") == BASIC_MONTHLY
    credited = {
        "same_day": F.col("plan_id").isin(*MONTHLY_PLANS) & after_basic & (start == F.col("next_start_date")),
        "upgrade": after_basic & F.col("plan_id").isin(PRO_MONTHLY, PRO_ANNUAL),
        "none": F.lit(False),
    }[credit]
    amount = F.when(credited, F.col("price") - F.coalesce("prev_price", F.lit(0))).otherwise(F.col("price"))
    until = F.least(F.coalesce(F.date_sub("next_start_date", 1), last_day), last_day)
    months = F.when(F.col("plan_id").isin(*MONTHLY_PLANS), F.greatest(month_gap(start, until), F.lit(0))).otherwise(0)
    dates = paid.withColumn("amount", amount.cast("decimal(10,2)")).withColumn("until", until).withColumn("dates", monthly_dates(start, months))
    return (
        dates.select("event_id", "customer_id", "plan_id", "plan_name", "amount", "until", F.posexplode("dates").alias("i", "payment_date"))
        .filter((F.col("i") == 0) | (F.col("payment_date") <= F.col("until")))
        .select("event_id", "customer_id", "plan_id", "plan_name", "payment_date", "amount", (F.col("i") + 1).alias("payment_order"))
    )
