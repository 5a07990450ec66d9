"""Restaurant questions: spend, visits, favourites, membership."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import loyalty as L
from tallyloom.plans.check_tables import check
from tallyloom.sources.fixtures import Fixtures

SPECIAL_ID = 1
SPECIAL_NAME = "small ring"
LAST_DAY = "1999-01-31"


def _renamed(df, names):
    return df.select(*[F.col(c).alias(n) for c, n in names.items()])


CUSTOMER_ITEM = {"customer_id": "customer", "product_name": "dish_name"}


def spend(fx: Fixtures):
    return _renamed(L.spend_by_entity(fx.sales(), fx.menu()), {"customer_id": "customer", "total_amount_spent": "total_amount_spent"}).orderBy("customer")


def visit_days(fx: Fixtures):
    return _renamed(L.visit_days(fx.sales()), {"customer_id": "customer", "days_visited": "days_visited"})


def first_items(fx: Fixtures):
    first = L.first_event_items(fx.sales(), fx.menu())
    return _renamed(first, {"customer_id": "customer", "product_name": "first_items_bought"}).orderBy("customer", "first_items_bought")


def item_counts(fx: Fixtures):
    return L.item_counts(fx.sales(), fx.menu()).withColumnRenamed("product_name", "dish_name")


def most_purchased(fx: Fixtures):
    return L.item_counts(fx.sales(), fx.menu(), top=1).withColumnRenamed("product_name", "dish_name")


def favourites(fx: Fixtures):
    return _renamed(L.favorite_item(fx.sales(), fx.menu()), CUSTOMER_ITEM).orderBy("customer", "dish_name")


def _nearest(fx: Fixtures, direction: str):
    near = L.nearest_event(fx.sales(), fx.members(), direction).join(fx.menu(), "product_id")
    return _renamed(near, CUSTOMER_ITEM).orderBy("customer", "dish_name")


def first_after_joining(fx: Fixtures):
    return _nearest(fx, "after")


def last_before_joining(fx: Fixtures):
    return _nearest(fx, "before")


def totals_before_joining(fx: Fixtures):
    return L.pre_anchor_totals(fx.sales(), fx.menu(), fx.members()).withColumnRenamed("customer_id", "customer").orderBy("customer")


def points(fx: Fixtures):
    rules = L.PointRules(special_id=SPECIAL_ID)
    return L.loyalty_points(fx.sales(), fx.menu(), rules).withColumnRenamed("customer_id", "customer").orderBy("customer")


def points_with_bonus_week(fx: Fixtures):
    rules = L.PointRules(special_name=SPECIAL_NAME, bonus_days=L.BONUS_DAYS, last_day=LAST_DAY)
    return L.loyalty_points(fx.sales(), fx.menu(), rules, fx.members()).withColumnRenamed("customer_id", "customer")


def membership_flag(fx: Fixtures):
    return L.membership_flag(fx.sales(), fx.menu(), fx.members()).withColumnRenamed("customer_id", "customer").orderBy("customer", "order_date", "product_name")


def membership_rank(fx: Fixtures):
    ranked = L.member_rank(fx.sales(), fx.menu(), fx.members()).withColumn("ranking", F.col("ranking").cast("double"))
    return ranked.withColumnsRenamed({"customer_id": "customer", "price": "product_price"})


QUERIES = {
    "diner_q01_spend": spend,
    "diner_q02_visit_days": visit_days,
    "diner_q03_first_items": first_items,
    "diner_q04_item_counts": item_counts,
    "diner_q04_most_purchased_corrected": most_purchased,
    "diner_q05_favourites": favourites,
    "diner_q06_first_after_joining": first_after_joining,
    "diner_q07_last_before_joining": last_before_joining,
    "diner_q08_totals_before_joining": totals_before_joining,
    "diner_q09_points": points,
    "diner_q10_points_bonus_week": points_with_bonus_week,
    "diner_bonus1_membership_flag": membership_flag,
    "diner_bonus2_membership_rank": membership_rank,
}

_RANKED_NEAR = """
    , near AS (
        SELECT sales.customer_id, product_id,
               rank() OVER (PARTITION BY sales.customer_id ORDER BY order_date {dir}) AS place
        FROM sales, members WHERE sales.customer_id = members.customer_id AND order_date {op} join_date)
    SELECT customer_id AS customer, product_name AS dish_name FROM near, menu WHERE place = 1 AND near.product_id = menu.product_id"""

ORACLE = {
    "diner_q01_spend": check(
        "sales menu",
        "SELECT customer_id AS customer, CAST(sum(price) AS DOUBLE) AS total_amount_spent FROM menu, sales WHERE menu.product_id = sales.product_id GROUP BY 1",
    ),
    "diner_q02_visit_days": check(
        "sales", "SELECT customer_id AS customer, count(DISTINCT order_date) AS days_visited FROM sales GROUP BY 1"
    ),
    "diner_q03_first_items": check(
        "sales menu",
        """, opened AS (SELECT customer_id, min(order_date) AS opening FROM sales GROUP BY customer_id)
        SELECT DISTINCT sales.customer_id AS customer, product_name AS first_items_bought
        FROM opened JOIN sales ON opened.customer_id = sales.customer_id JOIN menu ON sales.product_id = menu.product_id WHERE order_date = opening""",
    ),
    "diner_q04_item_counts": check(
        "sales menu", "SELECT product_name AS dish_name, count(*) AS times_ordered FROM menu, sales WHERE menu.product_id = sales.product_id GROUP BY 1"
    ),
    "diner_q04_most_purchased_corrected": check(
        "sales menu",
        """SELECT product_name AS dish_name, count(*) AS times_ordered FROM menu, sales WHERE menu.product_id = sales.product_id
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
    ),
    "diner_q05_favourites": check(
        "sales menu",
        """, tally AS (SELECT customer_id, product_name, count(*) AS n FROM sales, menu WHERE sales.product_id = menu.product_id GROUP BY ALL)
        SELECT customer_id AS customer, product_name AS dish_name FROM tally
        QUALIFY n = max(n) OVER (PARTITION BY customer_id)""",
    ),
    "diner_q06_first_after_joining": check("sales menu members", _RANKED_NEAR.format(dir="ASC", op=">=")),
    "diner_q07_last_before_joining": check("sales menu members", _RANKED_NEAR.format(dir="DESC", op="<")),
    "diner_q08_totals_before_joining": check(
        "sales menu members",
        """SELECT sales.customer_id AS customer, count(*) AS total_items_ordered, CAST(sum(price) AS DOUBLE) AS total_amount_spent
        FROM sales, members, menu
        WHERE sales.customer_id = members.customer_id AND sales.product_id = menu.product_id AND join_date > order_date GROUP BY 1""",
    ),
    "diner_q09_points": check(
        "sales menu",
        f"""SELECT customer_id AS customer, CAST(sum(price * if(menu.product_id = {SPECIAL_ID}, 20, 10)) AS DOUBLE) AS customer_points
        FROM sales, menu WHERE sales.product_id = menu.product_id GROUP BY 1""",
    ),
    "diner_q10_points_bonus_week": check(
        "sales menu members",
        f"""SELECT sales.customer_id AS customer,
               CAST(sum(price * if(product_name = '{SPECIAL_NAME}' OR order_date - join_date BETWEEN 0 AND 6, 20, 10)) AS DOUBLE) AS customer_points
        FROM sales, members, menu
        WHERE sales.customer_id = members.customer_id AND sales.product_id = menu.product_id AND order_date <= DATE '{LAST_DAY}' GROUP BY 1""",
    ),
    "diner_bonus1_membership_flag": check(
        "sales menu members",
        """SELECT sales.customer_id AS customer, strftime(order_date, '%Y-%m-%d') AS order_date, product_name, CAST(price AS DOUBLE) AS price,
               if(coalesce(join_date <= order_date, false), 'Y', 'N') AS member
        FROM menu JOIN sales ON menu.product_id = sales.product_id LEFT JOIN members ON members.customer_id = sales.customer_id""",
    ),
    "diner_bonus2_membership_rank": check(
        "sales menu members",
        """, flagged AS (
            SELECT sales.customer_id, order_date, product_name, price, if(coalesce(join_date <= order_date, false), 'Y', 'N') AS member
            FROM menu JOIN sales ON menu.product_id = sales.product_id LEFT JOIN members ON members.customer_id = sales.customer_id)
        SELECT customer_id AS customer, strftime(order_date, '%Y-%m-%d') AS order_date, product_name, CAST(price AS DOUBLE) AS product_price, member,
               CAST(if(member = 'Y', dense_rank() OVER (PARTITION BY customer_id, member ORDER BY order_date), NULL) AS DOUBLE) AS ranking
        FROM flagged""",
    ),
}
