"""Subscription questions: journeys, churn, plan mix, time to upgrade, payments."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import events as E, schedule as S
from tallyloom.plans.check_tables import check, half_up
from tallyloom.sources.fixtures import Fixtures
from tallyloom.sources.readers import preview

LATER_THAN = "2000-01-01"
AS_OF = "1998-12-31"
YEAR = ("1998-01-01", "1999-01-01")
SWEEP = ("1996-01-01", "1998-12-31")
HORIZON = "2000-12-31"


def journey(fx: Fixtures):
    rows = E.customer_journey(fx.subscriptions(), fx.plans()).orderBy("customer_id", "start_date", "event_id")
    return rows.select("customer_id", "plan_name", "start_date")


def sequence(fx: Fixtures):
    return E.plan_sequence(fx.subscriptions(), fx.plans()).withColumn("next_plan_id", F.col("next_plan_id").cast("double"))


def sequence_preview(fx: Fixtures):
    return preview(sequence(fx), 5, F.col("customer_id").asc_nulls_last(), "plan_order").drop("event_id")


def customers(fx: Fixtures):
    return E.customers(fx.subscriptions())


def trials(fx: Fixtures):
    return E.trial_starts_by_month(fx.subscriptions()).orderBy("month_start")


def later_events(fx: Fixtures):
    return E.events_after(fx.subscriptions(), fx.plans(), LATER_THAN).orderBy(F.col("event_count").desc(), "plan_name")


def churn(fx: Fixtures):
    return E.churn_rate(fx.subscriptions())


def churn_after_trial(fx: Fixtures):
    return E.transition_rate(fx.subscriptions(), E.TRIAL, E.CHURN)


def second_plan(fx: Fixtures):
    return E.nth_plan_mix(fx.subscriptions(), fx.plans(), 2).orderBy(F.col("customer_count").desc(), "plan_name")


def mix_as_of(fx: Fixtures):
    return E.plan_mix_as_of(fx.subscriptions(), fx.plans(), AS_OF).orderBy(F.col("customer_count").desc(), "plan_name")


def mix_by_day(fx: Fixtures):
    return E.plan_mix_by_day(fx.subscriptions(), fx.plans(), *SWEEP).orderBy("day", "plan_id").drop("plan_id")


def annual_upgrades(fx: Fixtures):
    return E.upgrades_in(fx.subscriptions(), E.PRO_ANNUAL, *YEAR).withColumnRenamed("upgraded_customers", "annual_upgrades")


def days_to_annual(fx: Fixtures):
    return E.mean_days_between(fx.subscriptions(), E.TRIAL, E.PRO_ANNUAL).withColumnRenamed("avg_days", "avg_days_to_annual")


def day_buckets(fx: Fixtures):
    return E.days_histogram(fx.subscriptions(), E.TRIAL, E.PRO_ANNUAL).orderBy("bucket_no").select("day_range", "customer_count")


def downgrades(fx: Fixtures):
    return E.downgrades_in(fx.subscriptions(), E.PRO_MONTHLY, E.BASIC_MONTHLY, *YEAR)


def _payments(fx: Fixtures, credit: str):
    paid = S.payment_schedule(fx.subscriptions(), fx.plans(), HORIZON, credit)
    return paid.orderBy("customer_id", "payment_date", "event_id").drop("event_id")


def payments(fx: Fixtures):
    return _payments(fx, "same_day")


def payments_credited(fx: Fixtures):
    return _payments(fx, "upgrade")


QUERIES = {
    "subs_a_journey": journey,
    "subs_helper_sequence": sequence,
    "subs_helper_preview": sequence_preview,
    "subs_b01_customers": customers,
    "subs_b02_monthly_trials": trials,
    "subs_b03_events_after": later_events,
    "subs_b04_churn": churn,
    "subs_b05_churn_after_trial": churn_after_trial,
    "subs_b06_second_plan": second_plan,
    "subs_b07_mix_as_of": mix_as_of,
    "subs_b07_mix_by_day": mix_by_day,
    "subs_b08_annual_upgrades": annual_upgrades,
    "subs_b09_days_to_annual": days_to_annual,
    "subs_b10_buckets": day_buckets,
    "subs_b11_downgrades": downgrades,
    "subs_bonus_payments": payments,
    "subs_bonus_payments_corrected": payments_credited,
}

_ORDER = "OVER (PARTITION BY customer_id ORDER BY start_date, event_id)"
_STEPS = f"""
    , steps AS (
        SELECT *, lead(plan_id) {_ORDER} AS next_plan_id, lead(plan_name) {_ORDER} AS next_plan_name, lead(start_date) {_ORDER} AS next_start_date,
               lag(plan_id) {_ORDER} AS prev_plan_id, lag(price) {_ORDER} AS prev_price, row_number() {_ORDER} AS plan_order
        FROM subs JOIN plans USING (plan_id))"""
_ALL = "(SELECT count(DISTINCT customer_id) FROM subs)"
_SEQUENCE = """customer_id, plan_id, plan_name, CAST(price AS DOUBLE) AS price, strftime(start_date, '%Y-%m-%d') AS start_date,
               CAST(next_plan_id AS DOUBLE) AS next_plan_id, next_plan_name, strftime(next_start_date, '%Y-%m-%d') AS next_start_date, plan_order"""
_MIX = f"count(*) AS customer_count, {half_up('count(*) * 100', _ALL, 1)} AS pct_of_customers"
_KNOWN = "count(DISTINCT customer_id)"
_KNOWN_MIX = f"{_KNOWN} AS customer_count, {half_up(f'{_KNOWN} * 100', _ALL, 1)} AS pct_of_customers"
_CREDITED = {
    "same_day": "plan_id IN (1, 2) AND prev_plan_id = 1 AND start_date = next_start_date",
    "upgrade": "prev_plan_id = 1 AND plan_id IN (2, 3)",
}


def _payment_check(credit: str) -> str:
    return check(
        "subs plans",
        _STEPS
        + f""", bill AS (
            SELECT event_id, customer_id, plan_id, plan_name, start_date AS payment_date, 1 AS payment_order,
                   CASE WHEN {_CREDITED[credit]} THEN price - coalesce(prev_price, 0) ELSE price END AS amount,
                   least(coalesce(next_start_date - 1, DATE '{HORIZON}'), DATE '{HORIZON}') AS stop
            FROM steps WHERE plan_id BETWEEN 1 AND 3
            UNION ALL
            SELECT event_id, customer_id, plan_id, plan_name, CAST(payment_date + INTERVAL 1 MONTH AS DATE), payment_order + 1, amount, stop
            FROM bill WHERE plan_id < 3 AND payment_date + INTERVAL 1 MONTH <= stop)
        SELECT customer_id, plan_id, plan_name, strftime(payment_date, '%Y-%m-%d') AS payment_date, CAST(amount AS DOUBLE) AS amount, payment_order
        FROM bill WHERE payment_date <= DATE '{HORIZON}'""",
    )


_PAIRS = """
    , pair AS (
        SELECT a.start_date - t.start_date AS days FROM subs t JOIN subs a ON t.customer_id = a.customer_id WHERE t.plan_id = 0 AND a.plan_id = 3)"""

ORACLE = {
    "subs_a_journey": check(
        "subs plans", "SELECT customer_id, plan_name, strftime(start_date, '%Y-%m-%d') AS start_date FROM plans JOIN subs USING (plan_id)"
    ),
    "subs_helper_sequence": check("subs plans", _STEPS + f"SELECT event_id, {_SEQUENCE} FROM steps"),
    "subs_helper_preview": check(
        "subs plans", _STEPS + f", top AS (SELECT * FROM steps ORDER BY customer_id, plan_order LIMIT 5) SELECT {_SEQUENCE} FROM top"
    ),
    "subs_b01_customers": check("subs", "SELECT count(DISTINCT customer_id) AS total_customers FROM subs"),
    "subs_b02_monthly_trials": check(
        "subs", "SELECT strftime(start_date, '%Y-%m-01') AS month_start, count(*) AS trial_starts FROM subs WHERE plan_id = 0 GROUP BY 1"
    ),
    "subs_b03_events_after": check(
        "subs plans", f"SELECT plan_name, count(*) AS event_count FROM plans JOIN subs USING (plan_id) WHERE start_date >= DATE '{LATER_THAN}' GROUP BY 1"
    ),
    "subs_b04_churn": check(
        "subs",
        f""", left_us AS (SELECT count(DISTINCT customer_id) AS n FROM subs WHERE plan_id = 4)
        SELECT n AS churned_customers, {half_up("n * 100", _ALL, 1)} AS churn_pct FROM left_us""",
    ),
    "subs_b05_churn_after_trial": check(
        "subs plans",
        _STEPS
        + f""", moved AS (SELECT count(DISTINCT customer_id) AS n FROM steps WHERE (plan_id, next_plan_id) = (0, 4))
        SELECT n AS customers, {half_up("n * 100", _ALL, 1)} AS pct_of_customers FROM moved""",
    ),
    "subs_b06_second_plan": check("subs plans", _STEPS + f"SELECT plan_name, {_MIX} FROM steps WHERE plan_order = 2 GROUP BY 1"),
    "subs_b07_mix_as_of": check(
        "subs plans",
        _STEPS
        + f"""SELECT plan_name, {_KNOWN_MIX} FROM steps
        WHERE start_date <= DATE '{AS_OF}' AND coalesce(next_start_date, DATE '9999-12-31') > DATE '{AS_OF}' GROUP BY 1""",
    ),
    "subs_b07_mix_by_day": check(
        "subs plans",
        _STEPS
        + f""", days AS (SELECT CAST(unnest(generate_series(DATE '{SWEEP[0]}', DATE '{SWEEP[1]}', INTERVAL 1 DAY)) AS DATE) AS day)
        , active AS (SELECT day, steps.plan_name, count(DISTINCT customer_id) AS n FROM days JOIN steps
            ON customer_id IS NOT NULL AND start_date <= day AND coalesce(next_start_date, DATE '9999-12-31') > day GROUP BY ALL)
        SELECT strftime(day, '%Y-%m-%d') AS day, plan_name, coalesce(n, 0) AS customer_count, {half_up("coalesce(n, 0) * 100", _ALL, 1)} AS pct_of_customers
        FROM days CROSS JOIN (SELECT plan_name FROM plans) p LEFT JOIN active USING (day, plan_name)""",
    ),
    "subs_b08_annual_upgrades": check(
        "subs",
        f"""SELECT count(DISTINCT customer_id) AS annual_upgrades FROM subs
        WHERE plan_id = 3 AND year(start_date) = year(DATE '{YEAR[0]}')""",
    ),
    "subs_b09_days_to_annual": check("subs", _PAIRS + f"SELECT {half_up('sum(days)', 'count(days)', 2)} AS avg_days_to_annual FROM pair"),
    "subs_b10_buckets": check(
        "subs",
        _PAIRS
        + """, numbered AS (SELECT least(days // 30, 12) AS b FROM pair WHERE days IS NOT NULL)
        SELECT (b * 30) || '-' || ((b + 1) * 30) || ' days' AS day_range, count(*) AS customer_count FROM numbered GROUP BY 1""",
    ),
    "subs_b11_downgrades": check(
        "subs plans",
        _STEPS
        + f"""SELECT count(DISTINCT customer_id) AS downgraded_customers FROM steps
        WHERE (plan_id, next_plan_id) = (2, 1) AND year(next_start_date) = year(DATE '{YEAR[0]}')""",
    ),
    "subs_bonus_payments": _payment_check("same_day"),
    "subs_bonus_payments_corrected": _payment_check("upgrade"),
}
