"""Delimited id lists in a text column: expansion, lookup, labels and net ingredient lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.exprs import col

def _parts(c: str | Column, sep: str) -> Column:
    """The text split at a literal separator."""
    return F.split(col(c), f"\\Q{sep}\\E")


def split_ids(c: str | Column, sep: str = ", ") -> Column:
    """The ids of a delimited list; NULL for NULL, empty for empty text, entries that are no number are dropped."""
    return F.array_compact(F.transform(_parts(c, sep), lambda x: x.try_cast("bigint")))


def list_size(c: str | Column, sep: str = ", ") -> Column:
    """Number of list entries; 0 for NULL or empty text."""
    text = col(c)
    return F.when(text.isNull() | (text == ""), 0).otherwise(F.size(_parts(text, sep)))


def explode_ids(df: DataFrame, list_col: str, out: str, sep: str = ", ") -> DataFrame:
    """One row per list entry; rows with a NULL or empty list give none."""
    return df.withColumn(out, F.explode(split_ids(list_col, sep)))


def ordered_names(name: str = "topping_name", sep: str = ", ") -> Column:
    """Ordered text list of a group's names; a group holds at most the entries of its own lists."""
    return F.expr(f"listagg({name}, '{sep}') within group (order by {name})")


def explode_list_lookup(
    df: DataFrame,
    keys: Sequence[str],
    list_col: str,
    dictionary: DataFrame,
    dict_id: str = "topping_id",
    dict_name: str = "topping_name",
    out: str = "names",
) -> DataFrame:
    """Per key, the names behind a delimited id list, as one ordered text; unknown ids are left out."""
    entries = explode_ids(df.select(*keys, list_col), list_col, dict_id)
    return entries.join(dictionary, dict_id).groupBy(*keys).agg(ordered_names(dict_name).alias(out))


def list_item_counts(
    df: DataFrame, list_col: str, dictionary: DataFrame, dict_id: str = "topping_id", dict_name: str = "topping_name"
) -> DataFrame:
    """How often each name occurs in a list column. Lists are counted before they are expanded."""
    lists = df.filter(F.col(list_col).isNotNull()).groupBy(list_col).agg(F.count(F.lit(1)).alias("n"))
    ids = explode_ids(lists, list_col, dict_id).groupBy(dict_id).agg(F.sum("n").alias("n"))
    return ids.join(dictionary, dict_id).groupBy(dict_name).agg(F.sum("n").alias("times"))


def most_common_list_item(df: DataFrame, list_col: str, dictionary: DataFrame, top: int = 1, dict_name: str = "topping_name") -> DataFrame:
    """The most frequent names; ties are broken by name."""
    return list_item_counts(df, list_col, dictionary, dict_name=dict_name).orderBy(F.col("times").desc(), F.col(dict_name)).limit(top)


# Keys that rows without a list are dealt over.
SPREAD = 1 << 12


def with_list_names(
    df: DataFrame, columns: dict[str, str], dictionary: DataFrame, dict_id: str = "topping_id", dict_name: str = "topping_name"
) -> DataFrame:
    """Add, per list column, the ordered names of its ids. `columns` maps the new column to the list column.

    Distinct list texts of all columns are looked up once, whatever the size of the dictionary, and joined back by their text. No name at all gives NULL.
    Rows without a list are dealt over SPREAD keys that no list has. The key of a list is not its text alone, so names are shuffled apart from their grouping
    and adaptive execution can also split the rows of a frequent list.
    """
    text = F.explode(F.array(*columns.values())).alias("_list")
    lists = df.select(text).filter(F.col("_list").isNotNull()).distinct()
    labels = explode_list_lookup(lists, ["_list"], "_list", dictionary, dict_id, dict_name, "_names")
    anywhere = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(SPREAD)).cast("string")
    named = labels.select(F.concat(F.lit("="), "_list").alias("_key"), "_names")
    for out, src in columns.items():
        key = F.coalesce(F.concat(F.lit("="), src), anywhere)
        df = df.withColumn("_own", key).join(named.withColumnsRenamed({"_names": out}), F.col("_own") == F.col("_key"), "left").drop("_own", "_key")
    return df


def order_item_label(orders: DataFrame, names: DataFrame, toppings: DataFrame) -> DataFrame:
    """One text per ordered pizza: its name, what to leave out and what to add."""
    listed = with_list_names(orders, {"exclusion_list": "exclusions", "extra_list": "extras"}, toppings)
    # A part of the text vanishes when its list is NULL.
    label = F.concat(
        F.col("pizza_name"),
        F.coalesce(F.concat(F.lit(" - Exclude "), "exclusion_list"), F.lit("")),
        F.coalesce(F.concat(F.lit(" - Extra "), "extra_list"), F.lit("")),
    )
    return listed.join(names, "pizza_id").select("order_id", "customer_id", label.alias("order_item"))


def net_ids(recipe: str, exclusions: str, extras: str) -> Column:
    """Recipe ids without the excluded ones, then the extra ids. A NULL list excludes and adds nothing."""
    excluded = split_ids(exclusions)
    kept = F.filter(
        F.coalesce(split_ids(recipe), F.array().cast("array<bigint>")),
        lambda i: ~F.coalesce(F.array_contains(excluded, i), F.lit(False)),
    )
    return F.concat(kept, F.coalesce(split_ids(extras), F.array().cast("array<bigint>")))


def net_ingredients(orders: DataFrame, recipes: DataFrame, toppings: DataFrame, keep: Sequence[str], weight: str | None = None) -> DataFrame:
    """Counted ingredients per `keep` columns after exclusions and extras; `weight` multiplies a row."""
    lists = orders.join(recipes, "pizza_id", "left").withColumn("topping_id", F.explode(net_ids("toppings", "exclusions", "extras")))
    amount = F.sum(weight) if weight else F.count(F.lit(1))
    return lists.join(toppings, "topping_id").groupBy(*keep, "topping_name").agg(amount.alias("topping_count"))


COMBINATION = ["pizza_id", "exclusions", "extras"]


def combinations(orders: DataFrame, names: DataFrame, recipes: DataFrame, toppings: DataFrame) -> DataFrame:
    """(pizza_id, exclusions, extras, pizza_name, items) of every distinct combination ordered; items are its counted ingredients by name.

    Ingredients depend on the combination only, so they are looked up and counted before they meet the order rows.
    """
    distinct = orders.select(*COMBINATION).distinct().join(names, "pizza_id")
    counted = net_ingredients(distinct, recipes, toppings, [*COMBINATION, "pizza_name"]).filter(F.col("topping_name").isNotNull())
    return counted.groupBy(*COMBINATION, "pizza_name").agg(F.array_sort(F.collect_list(F.struct("topping_name", "topping_count"))).alias("items"))


def _with_items(orders: DataFrame, made: DataFrame) -> DataFrame:
    named = made.withColumnsRenamed({c: f"_{c}" for c in COMBINATION})
    return orders.join(named, [F.col("pizza_id") == F.col("_pizza_id"), *[F.col(c).eqNullSafe(F.col(f"_{c}")) for c in COMBINATION[1:]]])


def _text(items: Column) -> Column:
    """`name: a, 2xb, ...` of ingredients in order."""
    shown = F.transform(
        items, lambda x: F.concat(F.when(x["topping_count"] > 1, F.concat(x["topping_count"].cast("string"), F.lit("x"))).otherwise(""), x["topping_name"])
    )
    return F.concat("pizza_name", F.lit(": "), F.array_join(shown, ", "))


def effective_ingredients(orders: DataFrame, names: DataFrame, recipes: DataFrame, toppings: DataFrame) -> DataFrame:
    """Ingredient text per (order, customer, pizza name); equal pizzas of one order are counted together.

    The order rows are placed by ranges of their key before they are expanded, so expanding, counting, listing and sorting by order and customer need no further shuffle,
    and the bounds of the ranges are drawn from rows that are not expanded yet.
    """
    keys = ["order_id", "customer_id", "pizza_name"]
    narrow = orders.select("order_id", "customer_id", *COMBINATION)
    placed = _with_items(narrow, combinations(orders, names, recipes, toppings)).select(*keys, "items").repartitionByRange("order_id", "customer_id")
    counted = placed.select(*keys, F.inline("items")).groupBy(*keys, "topping_name").agg(F.sum("topping_count").alias("topping_count"))
    listed = counted.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("topping_name", "topping_count"))).alias("items"))
    return listed.select("order_id", "customer_id", _text(F.col("items")).alias("ingredient_list"))


def effective_ingredients_per_pizza(orders: DataFrame, names: DataFrame, recipes: DataFrame, toppings: DataFrame) -> DataFrame:
    """Ingredient text for every single pizza, made once per distinct combination."""
    made = combinations(orders, names, recipes, toppings).select(*COMBINATION, _text(F.col("items")).alias("ingredient_list"))
    return _with_items(orders, made).select("order_id", "customer_id", "ingredient_list")


def ingredient_usage(orders: DataFrame, recipes: DataFrame, toppings: DataFrame) -> DataFrame:
    """Total use of each ingredient. Equal combinations are counted before lists are expanded."""
    combos = orders.groupBy(*COMBINATION).agg(F.count(F.lit(1)).alias("n"))
    return net_ingredients(combos, recipes, toppings, [], weight="n").withColumnsRenamed(
        {"topping_name": "ingredient", "topping_count": "total_quantity_used"}
    )
