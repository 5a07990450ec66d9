import pytest
from pyspark.sql import functions as F

from tallyloom.operators import lists as L

ORDERS = "order_id int, customer_id int, pizza_id int, exclusions string, extras string"


@pytest.fixture
def names(frame):
    return frame([(1, "Meaty"), (2, "Green")], "pizza_id int, pizza_name string")


@pytest.fixture
def recipes(frame):
    return frame([(1, "1, 2, 3"), (2, "3, 4")], "pizza_id int, toppings string")


@pytest.fixture
def toppings(frame):
    return frame([(1, "bacon"), (2, "apple"), (3, "cheese"), (4, "dill")], "topping_id int, topping_name string")


def orders(frame):
    return frame(
        [
            (1, 9, 1, None, None),
            (2, 9, 1, "3", None),
            (3, 9, 2, None, "1, 2"),
            (4, 9, 1, "3, 1", "4"),
            (5, 9, 2, "", "99"),
            (6, 9, 1, None, "2, 2"),
            (7, 9, 1, None, None),
            (7, 9, 1, None, None),
        ],
        ORDERS,
    )


def test_split(frame):
    df = frame([(None,), ("",), ("null",), ("1",), ("1, 5",), ("7, x, 8",)], "t string")
    got = [r[0] for r in df.select(L.split_ids("t")).collect()]
    assert got == [None, [], [], [1], [1, 5], [7, 8]]
    assert [r[0] for r in df.select(L.list_size("t")).collect()] == [0, 0, 1, 1, 2, 3]


def test_labels(frame, names, toppings, rows):
    got = rows(L.order_item_label(orders(frame), names, toppings), "order_id", "order_item")
    assert got == [
        (1, "Meaty"),
        (2, "Meaty - Exclude cheese"),
        (3, "Green - Extra apple, bacon"),
        (4, "Meaty - Exclude bacon, cheese - Extra dill"),
        (5, "Green"),
        (6, "Meaty - Extra apple, apple"),
        (7, "Meaty"),
        (7, "Meaty"),
    ]


def test_any_dictionary(frame, spark, rows, names, recipes):
    """Missing ids and names, names twice, ids beyond 32 bits, few or many entries: one algorithm."""
    few = [(1, "bacon"), (2, None), (None, "ghost"), (3_000_000_000, "cheese"), (4, "dill"), (5, "dill")]
    many = few + [(10_000 + k, f"n{k}") for k in range(400)]
    df = frame([(1, 9, 1, "3000000000, 1", "4, 5, 2"), (2, 9, 1, None, "2"), (3, 9, 1, "10007", None)], ORDERS)
    wide = frame([(1, "1, 3000000000, 4")], "pizza_id int, toppings string")
    for entries in (few, many):
        dictionary = frame(entries, "topping_id long, topping_name string")
        labels = rows(L.order_item_label(df, names, dictionary), "order_id", "order_item")
        assert labels[:2] == [(1, "Meaty - Exclude bacon, cheese - Extra dill, dill"), (2, "Meaty")]
        assert labels[2] == (3, "Meaty - Exclude n7" if entries is many else "Meaty")
        texts = rows(L.effective_ingredients(df, names, wide, dictionary), "order_id", "ingredient_list")
        assert texts == [(1, "Meaty: 3xdill"), (2, "Meaty: bacon, cheese, dill"), (3, "Meaty: bacon, cheese, dill")]
    assert [r[0] for r in df.select(L.split_ids("exclusions")).collect()] == [[3_000_000_000, 1], None, [10007]]


def test_rows_without_a_list_are_dealt_out(spark, toppings):
    """Most rows have no list: no task of the joins by list holds them all."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        i = F.col("id")
        df = spark.range(20_000).select(i.alias("order_id"), F.when(i % 10 == 0, "3, 1").alias("exclusions"), F.when(i % 20 == 0, "2").alias("extras"))
        named = L.with_list_names(df, {"out": "exclusions", "more": "extras"}, toppings)
        got = named.groupBy("out", "more").count().collect()
        sizes = [r["n"] for r in named.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.count("out"), F.count("more")).collect()]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert {tuple(r) for r in got} == {(None, None, 18_000), ("bacon, cheese", None, 1_000), ("bacon, cheese", "apple", 1_000)}
    assert max(sizes) < 20_000 / 2


def test_a_list_that_looks_like_a_key(frame, toppings, rows):
    """Texts that a key without a list might be are looked up as lists."""
    df = frame([(k, str(k) if k % 2 else None) for k in range(50)] + [(50, ""), (51, "=1"), (52, "1, 1")], "order_id int, extras string")
    got = dict(rows(L.with_list_names(df, {"out": "extras"}, toppings), "order_id", "out"))
    assert {k: v for k, v in got.items() if v} == {1: "bacon", 3: "cheese", 52: "bacon, bacon"} and len(got) == 53


def test_ingredient_texts_are_sorted_where_they_are(frame, names, recipes, toppings):
    """Sorting by order, customer and text shuffles no text: the rows were placed by ranges of order and customer."""
    texts = L.effective_ingredients(orders(frame), names, recipes, toppings).withColumnRenamed("order_id", "order_no")
    df = texts.orderBy("order_no", "customer_id", "ingredient_list")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan[: plan.index("REPARTITION_BY_COL")].count("Exchange") == 1
    got = [tuple(r) for r in df.collect()]
    assert got == sorted(got) and len(got) == 7


def test_ingredient_rows_are_placed_once(spark, frame, names, recipes, toppings):
    """Expanding, counting and listing follow one placement of the order rows."""
    plan = L.effective_ingredients(orders(frame), names, recipes, toppings)._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("REPARTITION_BY_COL")]
    assert above.count("Exchange") == 1 and "Generate inline" in above


def test_ingredient_text(frame, names, recipes, toppings, rows):
    got = rows(L.effective_ingredients(orders(frame), names, recipes, toppings), "order_id", "ingredient_list")
    assert got == [
        (1, "Meaty: apple, bacon, cheese"),
        (2, "Meaty: apple, bacon"),
        (3, "Green: apple, bacon, cheese, dill"),
        (4, "Meaty: apple, dill"),
        (5, "Green: cheese, dill"),
        (6, "Meaty: 3xapple, bacon, cheese"),
        (7, "Meaty: 2xapple, 2xbacon, 2xcheese"),
    ]
    single = rows(L.effective_ingredients_per_pizza(orders(frame), names, recipes, toppings), "order_id", "ingredient_list")
    assert single == got[:-1] + [(7, "Meaty: apple, bacon, cheese")] * 2


def test_usage_and_most_common(frame, recipes, toppings, rows):
    used = L.ingredient_usage(orders(frame), recipes, toppings)
    # bacon: recipes of orders 1, 2, 6, 7, 7 and the extra of order 3
    assert dict(rows(used, "ingredient", "total_quantity_used")) == {"apple": 9, "bacon": 6, "cheese": 6, "dill": 3}
    top = L.most_common_list_item(orders(frame), "extras", toppings)
    assert rows(top) == [("apple", 3)]
    tied = L.most_common_list_item(orders(frame).filter("order_id = 3"), "extras", toppings)
    assert rows(tied) == [("apple", 1)]


def test_unknown_pizza_recipe_keeps_extras(frame, recipes, toppings, rows):
    names = frame([(3, "New")], "pizza_id int, pizza_name string")
    df = frame([(1, 1, 3, None, "4")], ORDERS)
    assert rows(L.effective_ingredients(df, names, recipes, toppings), "ingredient_list") == [("New: dill",)]


def test_two_ids_of_one_name_and_nothing_left(frame, names, rows):
    toppings = frame([(1, "oil"), (2, "oil"), (3, "egg")], "topping_id int, topping_name string")
    recipes = frame([(1, "1, 2, 3"), (2, "3")], "pizza_id int, toppings string")
    df = frame([(1, 1, 1, None, None), (2, 1, 2, "3", None)], ORDERS)
    got = L.effective_ingredients(df, names, recipes, toppings)
    assert rows(got, "order_id", "ingredient_list") == [(1, "Meaty: egg, 2xoil")]
