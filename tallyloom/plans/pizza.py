"""Delivery service questions: cleaning, volumes, delivery metrics, ingredients, pricing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import calendar as C, delivery as D, lists as L, quality as Q
from tallyloom.plans.check_tables import check, half_up
from tallyloom.sources.fixtures import SUPREME_NAME, SUPREME_RECIPE, Fixtures
from tallyloom.sources.readers import append_rows, inline
from tallyloom.sources.writers import append_batch, read_batches, replace_partitions, replace_table

FIRST_WEEK = "2021-01-01"
DEFAULT_RATING_TIME = "2002-01-01 00:00:00"


def orders(fx: Fixtures):
    return Q.clean_customer_orders(fx.customer_orders_raw())


def runs(fx: Fixtures):
    return Q.clean_runner_orders(fx.runner_orders_raw())


# ---- cleaning -----------------------------------------------------------------------------------


def profile_exclusions(fx: Fixtures):
    return Q.value_profile(fx.customer_orders_raw(), "exclusions").orderBy(F.col("count").desc(), "exclusions")


def profile_extras(fx: Fixtures):
    return Q.value_profile(fx.customer_orders_raw(), "extras").orderBy(F.col("count").desc(), "extras")


def cleaned_orders(fx: Fixtures):
    return orders(fx)


def pair_profile(fx: Fixtures):
    order = [F.col(c).asc_nulls_last() for c in ("exclusions", "extras")]
    return Q.value_profile(orders(fx), "exclusions", "extras").orderBy(*order)


def raw_columns(fx: Fixtures):
    return fx.runner_orders_raw().orderBy("order_id").select("pickup_time", "distance", "duration", "cancellation")


def profile_of(column: str, cleaned: bool):
    def run(fx: Fixtures):
        raw = fx.runner_orders_raw()
        return Q.value_profile(Q.clean_runner_orders(raw, typed=False) if cleaned else raw, column)

    return run


def duration_with_fractions(fx: Fixtures):
    """Durations that keep a decimal point."""
    return Q.value_profile(Q.clean_runner_orders(fx.runner_orders_raw(), duration_keep="0-9."), "duration")


def cleaned_runs(fx: Fixtures):
    return Q.clean_runner_orders(fx.runner_orders_raw(), typed=False)


def typed_runs(fx: Fixtures):
    return runs(fx)


def rejected_durations(fx: Fixtures):
    """Delivered rows whose raw duration text is no number as it stands."""
    raw = fx.runner_orders_raw()
    return Q.rejected_rows(raw, "duration", F.col("duration").try_cast("decimal(10,2)")).select("order_id", "duration")


def preview_orders(fx: Fixtures):
    """The whole raw table once more."""
    return fx.customer_orders_raw()


# ---- A: volumes ---------------------------------------------------------------------------------


def pizzas(fx: Fixtures):
    return fx.customer_orders_raw().agg(F.count("pizza_id").alias("count"))


def distinct_orders(fx: Fixtures):
    return fx.customer_orders_raw().agg(F.count_distinct("order_id").alias("count"))


def per_runner(fx: Fixtures):
    return D.deliveries_per_runner(runs(fx)).withColumnsRenamed({"runner_id": "runner", "successful_orders": "succesful_orders"})


def by_type(fx: Fixtures):
    return D.deliveries_by_type(orders(fx), runs(fx), fx.pizza_names()).select(F.col("pizza_name").alias("pizza"), "total_deliveries")


def by_customer_and_type(fx: Fixtures):
    counted = D.orders_by_customer_and_type(orders(fx), fx.pizza_names())
    return counted.withColumnsRenamed({"customer_id": "customer", "pizza_name": "pizza"}).orderBy("customer")


def largest_order(fx: Fixtures):
    return D.largest_order(orders(fx))


def largest_delivered_order(fx: Fixtures):
    return D.largest_order(orders(fx), runs(fx))


def changes(fx: Fixtures):
    return D.changes_by_customer(orders(fx), runs(fx)).withColumnRenamed("customer_id", "customer").orderBy("customer", "changes")


def both_changes(fx: Fixtures):
    return D.both_changes(orders(fx), runs(fx))


def both_changes_delivered(fx: Fixtures):
    return D.both_changes(orders(fx), runs(fx), delivered_only=True)


def by_hour(fx: Fixtures):
    return C.volume_by_hour(fx.customer_orders_raw()).orderBy("hour_of_day")


def by_weekday(fx: Fixtures):
    return C.volume_by_weekday(fx.customer_orders_raw())


# ---- B: deliveries ------------------------------------------------------------------------------


def signups(fx: Fixtures):
    return C.volume_by_week(fx.runners(), "registration_date", FIRST_WEEK, "runners_signed_up").orderBy("week_no")


def arrival(fx: Fixtures):
    return D.minutes_to_arrive(orders(fx), runs(fx)).withColumnRenamed("runner_id", "runner")


def arrival_per_order(fx: Fixtures):
    return D.minutes_to_arrive(orders(fx), runs(fx), per_order=True).withColumnRenamed("runner_id", "runner")


def prep_time(fx: Fixtures):
    return D.prep_time(orders(fx), runs(fx)).withColumnRenamed("order_id", "order_no").orderBy(F.col("pizzas_ordered").desc(), "order_no")


def distance(fx: Fixtures):
    return D.distance_per_customer(orders(fx), runs(fx)).withColumnRenamed("customer_id", "customer").orderBy("customer")


def spread(fx: Fixtures):
    return D.delivery_spread(runs(fx))


def speeds(fx: Fixtures):
    return D.delivery_speeds(runs(fx)).withColumnsRenamed({"order_id": "order_no", "runner_id": "runner"}).orderBy("runner", "order_no")


def success(fx: Fixtures):
    return D.success_rate(runs(fx)).withColumnRenamed("runner_id", "runner").orderBy("runner")


# ---- C: ingredients -----------------------------------------------------------------------------


def _standard(menu, recipes, toppings):
    listed = L.explode_list_lookup(menu.join(recipes, "pizza_id"), ["pizza_name"], "toppings", toppings, out="standard_ingredients")
    return listed.withColumnRenamed("pizza_name", "pizza").orderBy("pizza")


def recipes(fx: Fixtures):
    return _standard(fx.part_menu(), fx.part_recipes(), fx.supplier_toppings())


def common_extra(fx: Fixtures):
    top = L.most_common_list_item(orders(fx), "extras", fx.toppings())
    return top.withColumnsRenamed({"topping_name": "most_common_extra", "times": "times_added"})


def common_exclusion(fx: Fixtures):
    top = L.most_common_list_item(orders(fx), "exclusions", fx.toppings())
    return top.withColumnsRenamed({"topping_name": "most_common_exclusion", "times": "times_excluded"})


ORDER_NAMES = {"order_id": "order_no", "customer_id": "customer"}


def order_items(fx: Fixtures):
    return L.order_item_label(orders(fx), fx.pizza_names(), fx.toppings()).withColumnsRenamed(ORDER_NAMES).orderBy("order_no", "customer", "order_item")


def order_items_large_dictionary(fx: Fixtures):
    """The same labels from a dictionary that grows with the data."""
    labels = L.order_item_label(orders(fx), fx.pizza_names(), fx.supplier_toppings())
    return labels.withColumnsRenamed(ORDER_NAMES).orderBy("order_no", "customer", "order_item")


def ingredient_lists(fx: Fixtures):
    texts = L.effective_ingredients(orders(fx), fx.pizza_names(), fx.pizza_recipes(), fx.toppings())
    return texts.withColumnsRenamed(ORDER_NAMES).orderBy("order_no", "customer", "ingredient_list")


def ingredient_lists_large_dictionary(fx: Fixtures):
    """The same with ingredients from a dictionary that grows with the data."""
    texts = L.effective_ingredients(orders(fx), fx.pizza_names(), fx.pizza_recipes(), fx.supplier_toppings())
    return texts.withColumnsRenamed(ORDER_NAMES).orderBy("order_no", "customer", "ingredient_list")


def ingredient_lists_per_pizza(fx: Fixtures):
    texts = L.effective_ingredients_per_pizza(orders(fx), fx.pizza_names(), fx.pizza_recipes(), fx.toppings())
    return texts.withColumnsRenamed(ORDER_NAMES).orderBy("order_no", "customer", "ingredient_list")


def _delivered_pizzas(fx: Fixtures):
    return orders(fx).join(D.delivered(runs(fx)).select("order_id"), "order_id")


def ingredient_usage(fx: Fixtures):
    used = L.ingredient_usage(_delivered_pizzas(fx), fx.pizza_recipes(), fx.toppings())
    return used.orderBy(F.col("total_quantity_used").desc(), "ingredient")


# ---- D: money and ratings -----------------------------------------------------------------------


def revenue(fx: Fixtures):
    return D.revenue(orders(fx), runs(fx))


def revenue_with_extras(fx: Fixtures):
    return D.revenue(orders(fx), runs(fx), extra_fee=D.EXTRA_FEE).withColumnRenamed("revenue", "revenue_with_extras")


def ratings(fx: Fixtures):
    return Q.with_default_time(fx.ratings(), "rating_time", F.lit(DEFAULT_RATING_TIME).cast("timestamp_ntz"))


def changed_ratings(fx: Fixtures):
    """The stored ratings after one runner's partition was written again with low ratings raised, and one batch of late ratings was sent twice."""
    table, late = fx.scratch("ratings"), fx.scratch("late")
    rated = fx.ratings().select("order_id", "customer_id", "runner_id", "rating")
    replace_table(rated.filter(F.col("order_id") % 10 != 0), table, ["runner_id"])
    one = fx.spark.read.parquet(table).filter(F.col("runner_id") == 3)
    replace_partitions(one.withColumn("rating", F.greatest("rating", F.lit(3))), table, ["runner_id"])
    for _ in range(2):
        append_batch(rated.filter(F.col("order_id") % 10 == 0), late, "late")
    return fx.spark.read.parquet(table).unionByName(read_batches(fx.spark, late))


def rating_violations(fx: Fixtures):
    return Q.violations(fx.ratings_dirty(), "order_id", Q.rating_rules())


def summary(fx: Fixtures):
    return D.delivery_summary(orders(fx), runs(fx), fx.ratings()).orderBy("order_id")


def net_money(fx: Fixtures):
    return D.net_money(orders(fx), runs(fx))


# ---- E: a new dish ------------------------------------------------------------------------------


def new_item(fx: Fixtures):
    """The large menu with one more dish, and its standard ingredients."""
    spark = fx.spark
    new_id = 10**9 + SUPREME_NAME[0]
    menu = append_rows(fx.part_menu(), inline(spark, [(new_id, SUPREME_NAME[1])], "pizza_id long, pizza_name string"))
    recipe = inline(spark, [(new_id, SUPREME_RECIPE[1])], "pizza_id long, toppings string")
    return _standard(menu, append_rows(fx.part_recipes(), recipe), fx.supplier_toppings())


QUERIES = {
    "pizza_clean_profile_exclusions": profile_exclusions,
    "pizza_clean_profile_extras": profile_extras,
    "pizza_clean_orders": cleaned_orders,
    "pizza_clean_pair_profile": pair_profile,
    "pizza_clean_raw_columns": raw_columns,
    "pizza_clean_pickup_profile": profile_of("pickup_time", cleaned=False),
    "pizza_clean_pickup_fixed": profile_of("pickup_time", cleaned=True),
    "pizza_clean_distance_profile": profile_of("distance", cleaned=False),
    "pizza_clean_distance_fixed": profile_of("distance", cleaned=True),
    "pizza_clean_duration_profile": profile_of("duration", cleaned=False),
    "pizza_clean_duration_fixed": profile_of("duration", cleaned=True),
    "pizza_clean_duration_fixed_corrected": duration_with_fractions,
    "pizza_clean_cancellation_profile": profile_of("cancellation", cleaned=False),
    "pizza_clean_cancellation_fixed": profile_of("cancellation", cleaned=True),
    "pizza_clean_runs": cleaned_runs,
    "pizza_clean_runs_typed": typed_runs,
    "pizza_clean_rejected_durations": rejected_durations,
    "pizza_clean_preview": preview_orders,
    "pizza_a01_pizzas": pizzas,
    "pizza_a02_orders": distinct_orders,
    "pizza_a03_deliveries_per_runner": per_runner,
    "pizza_a04_deliveries_by_type": by_type,
    "pizza_a05_customer_by_type": by_customer_and_type,
    "pizza_a06_largest_order": largest_order,
    "pizza_a06_largest_order_corrected": largest_delivered_order,
    "pizza_a07_changes": changes,
    "pizza_a08_both_changes": both_changes,
    "pizza_a08_both_changes_corrected": both_changes_delivered,
    "pizza_a09_by_hour": by_hour,
    "pizza_a10_by_weekday": by_weekday,
    "pizza_b1_signups_per_week": signups,
    "pizza_b2_minutes_to_arrive": arrival,
    "pizza_b2_minutes_to_arrive_corrected": arrival_per_order,
    "pizza_b3_prep_time": prep_time,
    "pizza_b4_distance_per_customer": distance,
    "pizza_b5_delivery_spread": spread,
    "pizza_b6_speed": speeds,
    "pizza_b7_success_rate": success,
    "pizza_c1_recipes": recipes,
    "pizza_c2_common_extra": common_extra,
    "pizza_c3_common_exclusion": common_exclusion,
    "pizza_c4_order_items": order_items,
    "pizza_c4_order_items_large_dictionary": order_items_large_dictionary,
    "pizza_c5_ingredient_lists": ingredient_lists,
    "pizza_c5_ingredient_lists_large_dictionary": ingredient_lists_large_dictionary,
    "pizza_c5_ingredient_lists_corrected": ingredient_lists_per_pizza,
    "pizza_c6_ingredient_usage": ingredient_usage,
    "pizza_d1_revenue": revenue,
    "pizza_d2_revenue_with_extras": revenue_with_extras,
    "pizza_d3_ratings": ratings,
    "pizza_d3_changed_ratings": changed_ratings,
    "pizza_d3_rating_violations": rating_violations,
    "pizza_d4_delivery_summary": summary,
    "pizza_d5_net_money": net_money,
    "pizza_e1_new_item": new_item,
}


def _profile_check(table: str, column: str) -> str:
    return check(table, f"SELECT {column}, count(*) AS count FROM {table} GROUP BY {column}")


_KM = half_up("distance * 100 * 60", "CAST(duration * 100 AS BIGINT)", 2)
_WAIT = "date_diff('second', order_time, pickup_time)"
_ITEM_LABEL = """
    , label AS (
        SELECT list_text, string_agg(topping_name, ', ' ORDER BY topping_name) AS names
        FROM (SELECT DISTINCT list_text FROM (SELECT exclusions AS list_text FROM co UNION ALL SELECT extras FROM co) b) u
             , unnest(string_split(list_text, ', ')) e(id), {dictionary} d
        WHERE e.id = CAST(topping_id AS VARCHAR) GROUP BY 1)
    SELECT order_id AS order_no, customer_id AS customer,
           pizza_name || coalesce(' - Exclude ' || x.names, '') || coalesce(' - Extra ' || e.names, '') AS order_item
    FROM co JOIN pizza_names USING (pizza_id) LEFT JOIN label x ON x.list_text = exclusions LEFT JOIN label e ON e.list_text = extras"""
# Every order line with its net ingredients: recipe entries that are not excluded, then extras.
_NET = """
    , numbered AS (SELECT *, row_number() OVER () AS line_no FROM {source})
    , entry AS (
        SELECT line_no, order_id, customer_id, pizza_id, CAST(u.id AS BIGINT) AS topping_id
        FROM numbered JOIN pizza_recipes USING (pizza_id), unnest(string_split(toppings, ', ')) u(id)
        WHERE NOT coalesce(list_contains(string_split(exclusions, ', '), u.id), false)
        UNION ALL
        SELECT line_no, order_id, customer_id, pizza_id, CAST(u.id AS BIGINT) FROM numbered, unnest(string_split(extras, ', ')) u(id))
    , named AS (SELECT * FROM entry JOIN {dictionary} USING (topping_id) JOIN pizza_names USING (pizza_id))"""
_TEXT = "string_agg(if(n = 1, '', n || 'x') || topping_name, ', ' ORDER BY topping_name)"


def _ingredient_check(dictionary: str) -> str:
    return check(
        f"co pizza_names pizza_recipes {dictionary}",
        _NET.format(source="co", dictionary=dictionary)
        + f""", tally AS (SELECT order_id, customer_id, pizza_name, topping_name, count(*) AS n FROM named GROUP BY ALL)
        SELECT order_id AS order_no, customer_id AS customer, pizza_name || ': ' || {_TEXT} AS ingredient_list
        FROM tally GROUP BY order_id, customer_id, pizza_name""",
    )


_RECIPE_TEXT = """
    SELECT pizza_name AS pizza, string_agg(topping_name, ', ' ORDER BY topping_name) AS standard_ingredients
    FROM {dishes}, unnest(string_split(toppings, ', ')) u(id), supplier_toppings WHERE CAST(u.id AS BIGINT) = topping_id GROUP BY 1"""
_TOP_ENTRY = """
    SELECT topping_name AS {name}, count(*) AS {times} FROM co, unnest(string_split({column}, ', ')) u(id), toppings
    WHERE CAST(u.id AS BIGINT) = topping_id GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1"""
_TYPED_RUNS = """strftime(pickup_time, '%Y-%m-%d %H:%M:%S') AS pickup_time, CAST(distance AS DOUBLE) AS distance, CAST(duration AS DOUBLE) AS duration"""
_DONE = "(SELECT order_id FROM ro WHERE cancellation IS NULL)"
_BOTH = "SELECT count(*) AS count FROM co WHERE exclusions IS NOT NULL AND extras IS NOT NULL AND order_id {sign} IN " + _DONE
_INCOME = "sum(CASE pizza_id WHEN 1 THEN 12 WHEN 2 THEN 10 END)"

ORACLE = {
    "pizza_clean_profile_exclusions": _profile_check("co_raw", "exclusions"),
    "pizza_clean_profile_extras": _profile_check("co_raw", "extras"),
    "pizza_clean_orders": check(
        "co", "SELECT order_id, customer_id, pizza_id, exclusions, extras, strftime(order_time, '%Y-%m-%d %H:%M:%S') AS order_time FROM co"
    ),
    "pizza_clean_pair_profile": check("co", "SELECT exclusions, extras, count(*) AS count FROM co GROUP BY ALL"),
    "pizza_clean_raw_columns": check("ro_raw", "SELECT pickup_time, distance, duration, cancellation FROM ro_raw"),
    "pizza_clean_pickup_profile": _profile_check("ro_raw", "pickup_time"),
    "pizza_clean_pickup_fixed": _profile_check("ro_text", "pickup_time"),
    "pizza_clean_distance_profile": _profile_check("ro_raw", "distance"),
    "pizza_clean_distance_fixed": _profile_check("ro_text", "distance"),
    "pizza_clean_duration_profile": _profile_check("ro_raw", "duration"),
    "pizza_clean_duration_fixed": _profile_check("ro_text", "duration"),
    "pizza_clean_duration_fixed_corrected": check(
        "ro_raw",
        """, kept AS (SELECT regexp_replace(nullif(duration, 'null'), '[^0-9.]', '', 'g') AS minutes FROM ro_raw)
        SELECT CAST(minutes AS DOUBLE) AS duration, count(*) AS count FROM kept GROUP BY minutes""",
    ),
    "pizza_clean_cancellation_profile": _profile_check("ro_raw", "cancellation"),
    "pizza_clean_cancellation_fixed": _profile_check("ro_text", "cancellation"),
    "pizza_clean_runs": check("ro_text", "SELECT order_id, runner_id, pickup_time, distance, duration, cancellation FROM ro_text"),
    "pizza_clean_runs_typed": check("ro", f"SELECT order_id, runner_id, cancellation, {_TYPED_RUNS} FROM ro"),
    "pizza_clean_rejected_durations": check(
        "ro_raw", "SELECT order_id, duration FROM ro_raw WHERE duration IS NOT NULL AND TRY_CAST(duration AS DECIMAL(10, 2)) IS NULL"
    ),
    "pizza_clean_preview": check(
        "co_raw",
        """SELECT order_id, customer_id, pizza_id, exclusions, extras, strftime(order_time, '%Y-%m-%d %H:%M:%S') AS order_time
        FROM co_raw""",
    ),
    "pizza_a01_pizzas": check("co_raw", "SELECT count(pizza_id) AS count FROM co_raw"),
    "pizza_a02_orders": check("co_raw", "SELECT count(*) AS count FROM (SELECT order_id FROM co_raw GROUP BY 1) t"),
    "pizza_a03_deliveries_per_runner": check("ro", f"SELECT runner_id AS runner, count(*) AS succesful_orders FROM ro WHERE order_id IN {_DONE} GROUP BY 1"),
    "pizza_a04_deliveries_by_type": check(
        "co ro pizza_names", f"SELECT pizza_name AS pizza, count(*) AS total_deliveries FROM co JOIN pizza_names USING (pizza_id) WHERE order_id IN {_DONE} GROUP BY pizza_id, pizza_name"
    ),
    "pizza_a05_customer_by_type": check(
        "co pizza_names", "SELECT customer_id AS customer, pizza_name AS pizza, count(*) AS total_orders FROM co JOIN pizza_names USING (pizza_id) GROUP BY ALL"
    ),
    "pizza_a06_largest_order": check(
        "co", "SELECT count(pizza_id) AS most_pizzas_ordered FROM co GROUP BY order_id ORDER BY 1 DESC LIMIT 1"
    ),
    "pizza_a06_largest_order_corrected": check(
        "co ro", f"SELECT count(pizza_id) AS most_pizzas_ordered FROM co WHERE order_id IN {_DONE} GROUP BY order_id ORDER BY 1 DESC LIMIT 1"
    ),
    "pizza_a07_changes": check(
        "co ro",
        f"""SELECT customer_id AS customer, if(coalesce(exclusions, extras) IS NULL, 'NO', 'YES') AS changes, count(*) AS total
        FROM co WHERE order_id IN {_DONE} GROUP BY ALL""",
    ),
    "pizza_a08_both_changes": check("co ro", _BOTH.format(sign="NOT")),
    "pizza_a08_both_changes_corrected": check("co ro", _BOTH.format(sign="")),
    "pizza_a09_by_hour": check("co_raw", "SELECT CAST(hour(order_time) AS INTEGER) AS hour_of_day, count(*) AS pizzas_ordered FROM co_raw GROUP BY 1"),
    "pizza_a10_by_weekday": check("co_raw", "SELECT rpad(upper(dayname(order_time)), 9, ' ') AS day_of_week, count(*) AS pizzas_ordered FROM co_raw GROUP BY 1"),
    "pizza_b1_signups_per_week": check(
        "runners", f"SELECT CAST((registration_date - DATE '{FIRST_WEEK}') // 7 + 1 AS INTEGER) AS week_no, count(*) AS runners_signed_up FROM runners GROUP BY 1"
    ),
    "pizza_b2_minutes_to_arrive": check(
        "co ro",
        f"""SELECT runner_id AS runner, {half_up(f"sum({_WAIT})", f"count({_WAIT}) * 60", 2)} AS avg_minutes_to_arrive
        FROM co JOIN ro USING (order_id) GROUP BY 1""",
    ),
    "pizza_b2_minutes_to_arrive_corrected": check(
        "co ro",
        f"""SELECT runner_id AS runner, {half_up(f"sum({_WAIT})", f"count({_WAIT}) * 60", 2)} AS avg_minutes_to_arrive
        FROM (SELECT DISTINCT order_id, order_time FROM co) o JOIN ro USING (order_id) GROUP BY 1""",
    ),
    "pizza_b3_prep_time": check(
        "co ro",
        f""", size AS (SELECT order_id, order_time, count(pizza_id) AS n FROM co GROUP BY ALL)
        SELECT order_id AS order_no, n AS pizzas_ordered, {half_up(_WAIT, "60", 2)} AS prep_time_minutes,
               {half_up(_WAIT, "nullif(n, 0) * 60", 2)} AS prep_time_per_pizza
        FROM size JOIN ro USING (order_id) WHERE cancellation IS NULL""",
    ),
    "pizza_b4_distance_per_customer": check(
        "co ro",
        f"""SELECT customer_id AS customer, {half_up("sum(distance) * 100", "count(distance) * 100", 2)} AS avg_distance_km
        FROM ro JOIN (SELECT order_id, customer_id FROM co GROUP BY ALL) o USING (order_id) WHERE cancellation IS NULL GROUP BY 1""",
    ),
    "pizza_b5_delivery_spread": check(
        "ro", "SELECT CAST(max(duration) - min(duration) AS DOUBLE) AS delivery_time_difference_minutes FROM ro WHERE cancellation IS NULL"
    ),
    "pizza_b6_speed": check("ro", f"SELECT order_id AS order_no, runner_id AS runner, {_KM} AS avg_speed_kmh FROM ro WHERE cancellation IS NULL"),
    "pizza_b7_success_rate": check(
        "ro",
        f"SELECT runner_id AS runner, {half_up('count(*) FILTER (cancellation IS NULL) * 100', 'count(*)', 2)} AS successful_delivery_pct FROM ro GROUP BY 1",
    ),
    "pizza_c1_recipes": check("part_menu part_recipes supplier_toppings", _RECIPE_TEXT.format(dishes="part_menu JOIN part_recipes USING (pizza_id)")),
    "pizza_c2_common_extra": check("co toppings", _TOP_ENTRY.format(name="most_common_extra", times="times_added", column="extras")),
    "pizza_c3_common_exclusion": check("co toppings", _TOP_ENTRY.format(name="most_common_exclusion", times="times_excluded", column="exclusions")),
    "pizza_c4_order_items": check("co pizza_names toppings", _ITEM_LABEL.format(dictionary="toppings")),
    "pizza_c4_order_items_large_dictionary": check("co pizza_names supplier_toppings", _ITEM_LABEL.format(dictionary="supplier_toppings")),
    "pizza_c5_ingredient_lists": _ingredient_check("toppings"),
    "pizza_c5_ingredient_lists_large_dictionary": _ingredient_check("supplier_toppings"),
    "pizza_c5_ingredient_lists_corrected": check(
        "co pizza_names pizza_recipes toppings",
        _NET.format(source="co", dictionary="toppings")
        + f""", tally AS (SELECT line_no, order_id, customer_id, pizza_name, topping_name, count(*) AS n FROM named GROUP BY ALL)
        SELECT order_id AS order_no, customer_id AS customer, pizza_name || ': ' || {_TEXT} AS ingredient_list
        FROM tally GROUP BY line_no, order_id, customer_id, pizza_name""",
    ),
    "pizza_c6_ingredient_usage": check(
        "co ro pizza_names pizza_recipes toppings",
        f", done AS (SELECT * FROM co WHERE order_id IN {_DONE})"
        + _NET.format(source="done", dictionary="toppings")
        + "SELECT topping_name AS ingredient, count(*) AS total_quantity_used FROM entry JOIN toppings USING (topping_id) GROUP BY 1",
    ),
    "pizza_d1_revenue": check("co ro", f"SELECT CAST({_INCOME} AS BIGINT) AS revenue FROM co WHERE order_id IN {_DONE}"),
    "pizza_d2_revenue_with_extras": check(
        "co ro",
        f"SELECT CAST({_INCOME} + sum(coalesce(len(string_split(extras, ', ')), 0)) AS BIGINT) AS revenue_with_extras FROM co WHERE order_id IN {_DONE}",
    ),
    "pizza_d3_ratings": check(
        "ratings",
        f"""SELECT order_id, customer_id, runner_id, rating,
               strftime(coalesce(rating_time, TIMESTAMP '{DEFAULT_RATING_TIME}'), '%Y-%m-%d %H:%M:%S') AS rating_time FROM ratings""",
    ),
    "pizza_d3_changed_ratings": check(
        "ratings", "SELECT order_id, customer_id, runner_id, if(runner_id = 3 AND order_id % 10 <> 0, greatest(rating, 3), rating) AS rating FROM ratings"
    ),
    "pizza_d3_rating_violations": check(
        "ratings",
        """, copies AS (SELECT ratings.* FROM ratings, generate_series(1, 2) g(i) WHERE i = 1 OR order_id % 50 = 0)
        , flaws AS (
            SELECT 'customer_id is missing' AS rule, order_id FROM copies WHERE order_id % 90 = 0
            UNION ALL SELECT 'rating is out of range', order_id FROM copies WHERE order_id % 70 = 0
            UNION ALL SELECT 'order_id is repeated', order_id FROM copies WHERE order_id % 50 = 0)
        SELECT rule, CAST(order_id AS VARCHAR) AS key, count(*) AS rows FROM flaws GROUP BY ALL""",
    ),
    "pizza_d4_delivery_summary": check(
        "co ro ratings",
        f""", size AS (SELECT order_id, customer_id, min(co.order_time) AS order_time, count(*) AS total_pizzas FROM co GROUP BY ALL)
        SELECT size.customer_id, order_id, ro.runner_id, rating, strftime(order_time, '%Y-%m-%d %H:%M:%S') AS order_time,
               strftime(pickup_time, '%Y-%m-%d %H:%M:%S') AS pickup_time, {half_up(_WAIT, "60", 2)} AS minutes_between_order_and_pickup,
               CAST(duration AS DOUBLE) AS delivery_duration_minutes, {_KM} AS avg_speed_kmh, total_pizzas
        FROM ratings JOIN ro USING (order_id) JOIN size USING (order_id) WHERE cancellation IS NULL""",
    ),
    "pizza_d5_net_money": check(
        "co ro",
        f""", got AS (SELECT CAST({_INCOME} AS BIGINT) AS total_revenue FROM co WHERE order_id IN {_DONE})
        , paid AS (SELECT sum(distance) * CAST(0.3 AS DECIMAL(6, 2)) AS cost FROM ro WHERE cancellation IS NULL)
        SELECT total_revenue, CAST(cost AS DOUBLE) AS total_runner_cost, round(CAST(total_revenue - cost AS DOUBLE), 2) AS money_left_over FROM got, paid""",
    ),
    "pizza_e1_new_item": check(
        "part_menu part_recipes supplier_toppings",
        f""", dishes AS (
            SELECT pizza_name, toppings FROM part_menu JOIN part_recipes USING (pizza_id) UNION ALL SELECT '{SUPREME_NAME[1]}', '{SUPREME_RECIPE[1]}')"""
        + _RECIPE_TEXT.format(dishes="dishes"),
    ),
}
