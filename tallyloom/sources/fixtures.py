"""Projections of the star-schema test tables onto the schemas the operators work on.

Each adapter is one lazy DataFrame, built with integer and decimal arithmetic only, so that another
SQL engine gives the same rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.session import shared_folder
from tallyloom.sources.readers import RETAIL_FILE, inline, read_table

# fixed values: menu of the delivery case; names of toppings and prices of plans are our own
PIZZA_NAMES = ((1, "Hearty"), (2, "Garden"))
PIZZA_RECIPES = ((1, "1, 3, 5, 7, 9, 11"), (2, "2, 4, 6, 8, 11, 12"))
SUPREME_NAME = (3, "Supreme")
SUPREME_RECIPE = (3, "1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12")
TOPPINGS = (
    (1, "Artichoke"),
    (2, "Basil"),
    (3, "Capers"),
    (4, "Fennel"),
    (5, "Ham"),
    (6, "Leek"),
    (7, "Mozzarella"),
    (8, "Olives"),
    (9, "Pepper"),
    (10, "Rocket"),
    (11, "Salami"),
    (12, "Tomato"),
)
PLANS = ((0, "trial", "0.00"), (1, "basic monthly", "8.50"), (2, "pro monthly", "17.25"), (3, "pro annual", "170.00"), (4, "churn", None))

# fixed value: the country that the abroad lists leave out
HOME_MARKET = "United Kingdom"
CLOSED_MONTHS = ("1995-03", "1996-11")
DIRTY_FILES = 16
AD_CHANNELS = ("Television", "Radio", "Print", "Outdoor", "Search", "Social")
DIGITAL_CHANNELS = ("Search", "Social")


class Fixtures:
    """The adapted tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def scratch(self, name: str) -> str:
        """A path of its own in the shared folder."""
        return f"{shared_folder(self.spark)}/{name}-{uuid.uuid4().hex}"

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)

    # ---- restaurant -------------------------------------------------------------------------

    def sales(self) -> DataFrame:
        orders = self.table("orders").select(
            "o_orderkey", F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").cast("date").alias("order_date")
        )
        lines = self.table("lineitem").select("l_orderkey", F.col("l_partkey").alias("product_id"))
        joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        known, dated = F.col("customer_id") % 37 != 5, F.col("o_orderkey") % 53 != 7
        return joined.select(
            F.when(known, F.col("customer_id")).alias("customer_id"), F.when(dated, F.col("order_date")).alias("order_date"), "product_id"
        )

    def menu(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        )

    def members(self) -> DataFrame:
        joined = F.date_add(F.lit("1998-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int"))
        return (
            self.table("customer")
            .filter(F.col("c_mktsegment") == "BUILDING")
            .select(F.col("c_custkey").alias("customer_id"), joined.alias("join_date"))
        )

    # ---- delivery ---------------------------------------------------------------------------

    def _order_times(self) -> DataFrame:
        minutes = F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))
        return self.table("orders").select(
            "o_orderkey", "o_custkey", "o_orderstatus", (F.col("o_orderdate") + minutes).alias("order_time")
        )

    def customer_orders_raw(self) -> DataFrame:
        """One row per ordered pizza, with dirty exclusion and extra lists."""
        a = (F.col("l_suppkey") % 12 + 1).cast("string")
        b = (F.col("l_partkey") % 12 + 1).cast("string")
        c = (F.col("l_orderkey") % 12 + 1).cast("string")
        by_line, by_part, by_order = F.col("l_linenumber") % 4, F.col("l_partkey") % 5, F.col("l_orderkey") % 5
        # Lists of one, three, ten and otherwise two entries.
        ten = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(10)), lambda i: (F.col("l_partkey") * i % 12 + 1).cast("string")), ", ")
        entries = F.when(by_order == 0, a).when(by_order == 1, F.concat_ws(", ", a, b, c)).when(by_order == 2, ten).otherwise(F.concat_ws(", ", a, b))
        exclusions = F.when(by_line == 0, "").when(by_line == 1, "null").when(by_line == 3, entries)
        extras = (
            F.when(by_part == 0, "").when(by_part == 1, "null").when(by_part == 3, "NaN").when(by_part == 4, F.concat_ws(", ", a, c))
        )
        lines = self.table("lineitem").select(
            "l_orderkey",
            F.when(F.col("l_partkey") % 41 != 3, (F.col("l_partkey") % 2 + 1).cast("int")).alias("pizza_id"),
            exclusions.alias("exclusions"),
            extras.alias("extras"),
        )
        orders = self._order_times().select("o_orderkey", "o_custkey", "order_time")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("l_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            "pizza_id",
            "exclusions",
            "extras",
            "order_time",
        )

    def runner_orders_raw(self) -> DataFrame:
        """One row per order, with times and measures as dirty text."""
        key = F.col("o_orderkey")
        cancelled = F.col("o_orderstatus") == "P"
        pickup = F.date_format(F.col("order_time") + F.make_dt_interval(mins=(key % 50 + 5).cast("int")), "yyyy-MM-dd HH:mm:ss")
        km = F.array(F.lit("km"), F.lit(" km"), F.lit(""))[(F.floor(key / 3) % 3).cast("int")]
        distance = F.concat((key % 20 + 5).cast("string"), F.lit("."), (key % 10).cast("string"), km)
        unit = F.array(F.lit(" minutes"), F.lit("mins"), F.lit(" minute"), F.lit(""))[(key % 4).cast("int")]
        duration = F.concat((key % 40 + 10).cast("string"), F.when(key % 6 == 5, ".5").otherwise(""), unit)
        reason = F.when(key % 2 == 0, "Restaurant Cancellation").otherwise("Customer Cancellation")
        blank = F.when(key % 3 == 0, "").when(key % 3 == 1, "null")
        return self._order_times().select(
            key.alias("order_id"),
            (key % 8 + 1).cast("int").alias("runner_id"),
            F.when(cancelled, "null").otherwise(pickup).alias("pickup_time"),
            F.when(cancelled, "null").otherwise(distance).alias("distance"),
            F.when(cancelled, "null").otherwise(duration).alias("duration"),
            F.when(cancelled, reason).otherwise(blank).alias("cancellation"),
        )

    def runners(self) -> DataFrame:
        registered = F.date_add(F.lit("2021-01-01").cast("date"), (F.col("s_suppkey") % 60).cast("int"))
        return self.table("supplier").select(F.col("s_suppkey").alias("runner_id"), registered.alias("registration_date"))

    def pizza_names(self) -> DataFrame:
        return inline(self.spark, PIZZA_NAMES, "pizza_id int, pizza_name string")

    def pizza_recipes(self) -> DataFrame:
        return inline(self.spark, PIZZA_RECIPES, "pizza_id int, toppings string")

    def toppings(self) -> DataFrame:
        return inline(self.spark, TOPPINGS, "topping_id int, topping_name string")

    def part_menu(self) -> DataFrame:
        """A large menu: every part is a dish."""
        return self.table("part").select(
            F.col("p_partkey").alias("pizza_id"), F.concat_ws(" #", "p_name", F.col("p_partkey").cast("string")).alias("pizza_name")
        )

    def part_recipes(self) -> DataFrame:
        key, size = F.col("p_partkey"), F.col("p_size")
        ids = [(key % 97).cast("string"), (100 + key % 89).cast("string"), (200 + size).cast("string"), (key % 7).cast("string")]
        return self.table("part").select(key.alias("pizza_id"), F.concat_ws(", ", *ids).alias("toppings"))

    def supplier_toppings(self) -> DataFrame:
        """A large dictionary: every supplier is an ingredient."""
        return self.table("supplier").select(F.col("s_suppkey").cast("long").alias("topping_id"), F.col("s_name").alias("topping_name"))

    def ratings(self) -> DataFrame:
        """One rating per order that was not cancelled; every seventh has no time of its own."""
        key = F.col("o_orderkey")
        return (
            self._order_times()
            .filter(F.col("o_orderstatus") != "P")
            .select(
                key.alias("order_id"),
                F.col("o_custkey").alias("customer_id"),
                (key % 8 + 1).cast("int").alias("runner_id"),
                (key % 5 + 1).cast("int").alias("rating"),
                F.when(key % 7 != 0, F.col("order_time")).alias("rating_time"),
            )
        )

    def ratings_dirty(self) -> DataFrame:
        """The ratings with repeated keys, missing customers and values out of range."""
        key = F.col("order_id")
        copies = F.when(key % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        return (
            self.ratings()
            .withColumn("copy", F.explode(copies))
            .drop("copy")
            .withColumn("customer_id", F.when(key % 90 != 0, F.col("customer_id")))
            .withColumn("rating", F.when(key % 70 == 0, 6).otherwise(F.col("rating")))
        )

    # ---- subscriptions ----------------------------------------------------------------------

    def plans(self) -> DataFrame:
        return inline(self.spark, PLANS, "plan_id int, plan_name string, price decimal(10,2)")

    def subscriptions(self) -> DataFrame:
        """A customer's first order starts the trial; later orders start plans 1 to 4.

        Some customers and days are missing, and one customer in twenty changes plans on the first of a half-year only, often twice a day.
        """
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("event_id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").cast("date").alias("start_date")
        )
        first = orders.groupBy("customer_id").agg(F.min(F.struct("start_date", "event_id")).alias("head"))
        first = first.select(F.col("head.event_id").alias("event_id"), F.lit(0).alias("trial"))
        plan = F.coalesce(F.col("trial"), (F.col("event_id") % 4 + 1).cast("int"))
        known, dated = F.col("customer_id") % 31 != 4, F.col("event_id") % 59 != 11
        half_year = F.make_date(F.year("start_date"), F.when(F.month("start_date") > 6, 7).otherwise(1), F.lit(1))
        day = F.when(F.col("customer_id") % 20 == 3, half_year).otherwise(F.col("start_date"))
        return orders.join(first, "event_id", "left").select(
            "event_id", F.when(known, F.col("customer_id")).alias("customer_id"), plan.alias("plan_id"), F.when(dated, day).alias("start_date")
        )

    # ---- retail -----------------------------------------------------------------------------

    def retail(self) -> DataFrame:
        """Typed transaction lines with returns, write-offs, guests, copies, odd prices and two months without business."""
        part, order, nation = F.col("l_partkey"), F.col("o_orderkey"), F.col("c_nationkey")
        returned = F.col("l_returnflag") == "R"
        write_off = (part % 211 == 0) & ~returned
        description = (
            F.when(part % 50 == 0, None)
            .when(part % 97 == 0, "POSTAGE")
            .when(part % 101 == 0, "Manual")
            .when(part % 103 == 0, "Dotcom Postage")
            .otherwise(F.col("p_name"))
        )
        price = F.when(write_off, 0).when(part % 503 == 0, -F.col("p_retailprice")).otherwise(F.col("p_retailprice"))
        guest = (F.col("o_custkey") % 10 == 0) | (nation == 7) | write_off
        country = F.when(nation == 4, "EIRE").when(nation.between(8, 15), HOME_MARKET).otherwise(F.col("n_name"))
        copies = F.when(order % 40 == 0, F.array(F.lit(1), F.lit(2), F.lit(3))).otherwise(F.array(F.lit(1)))
        customers = (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", "c_nationkey", "n_name")
        )
        closed = F.date_format("order_time", "yyyy-MM").isin(*CLOSED_MONTHS)
        orders = self._order_times().filter(~closed).join(customers, F.col("o_custkey") == F.col("c_custkey"))
        lines = self.table("lineitem").join(self.table("part"), part == F.col("p_partkey"))
        return (
            lines.join(orders, F.col("l_orderkey") == order)
            .withColumn("copy", F.explode(copies))
            .select(
                F.concat(F.when(returned, "C").otherwise(""), order.cast("string")).alias("invoice"),
                description.alias("description"),
                (F.col("l_quantity").cast("int") * F.when(returned | write_off, -1).otherwise(1)).alias("quantity"),
                F.col("order_time").alias("invoice_date"),
                price.cast("decimal(10,2)").alias("price"),
                F.when(~guest, F.col("o_custkey")).alias("customer_id"),
                country.alias("country"),
            )
        )

    def retail_lines(self) -> DataFrame:
        """The transactions as lines of delimited text, as a file would hold them."""
        fields = [
            F.col("invoice"),
            F.col("description"),
            F.col("quantity").cast("string"),
            F.date_format("invoice_date", "yyyy-MM-dd HH:mm:ss"),
            F.col("price").cast("string"),
            F.concat(F.col("customer_id").cast("string"), F.lit(".0")),
            F.col("country"),
        ]
        return self.retail().select(F.concat_ws(",", *[F.coalesce(f, F.lit("")) for f in fields]).alias("line"))

    def retail_file(self) -> str:
        """The transactions as delimited files with a header row, written to the shared folder; returns their path."""
        text = {
            "invoice_date": F.date_format("invoice_date", "yyyy-MM-dd HH:mm:ss"),
            "customer_id": F.concat(F.col("customer_id").cast("string"), F.lit(".0")),
        }
        named = self.retail().withColumns(text).withColumnsRenamed({out: name for name, (out, _) in RETAIL_FILE.items()})
        path = self.scratch("retail")
        named.write.csv(path, header=True)
        return path

    def retail_dirty_file(self) -> str:
        """The transactions as files written elsewhere: quoted line breaks, quantities that are no numbers, records cut off after three fields. Returns their path."""
        quantity, names = F.col("quantity"), list(RETAIL_FILE)
        bad, short, broken = quantity % 13 == 5, quantity % 17 == 3, quantity % 3 == 0
        described = F.when(broken, F.concat(F.lit('"'), F.replace("description", F.lit(" "), F.lit("\n")), F.lit('"'))).otherwise(F.col("description"))
        head = [F.col("invoice"), F.when(bad | short, F.col("description")).otherwise(described), F.when(bad, F.concat(quantity.cast("string"), F.lit(" pcs"))).otherwise(quantity.cast("string"))]
        tail = [F.date_format("invoice_date", "yyyy-MM-dd HH:mm:ss"), F.col("price").cast("string"), F.concat(F.col("customer_id").cast("string"), F.lit(".0")), F.col("country")]
        line = lambda fields: F.concat_ws(",", *[F.coalesce(f, F.lit("")) for f in fields])
        lines = self.retail().select(F.pmod(F.xxhash64("invoice"), F.lit(DIRTY_FILES)).alias("file"), F.lit(1).alias("place"), F.when(short & ~bad, line(head)).otherwise(line(head + tail)).alias("line"))
        heads = self.spark.range(DIRTY_FILES).select(F.col("id").alias("file"), F.lit(0).alias("place"), F.lit(",".join(names)).alias("line"))
        path = self.scratch("dirty")
        dealt = lines.unionByName(heads).repartition("file").sortWithinPartitions("file", "place")
        dealt.select("file", "line").write.partitionBy("file").text(path)
        return f"{path}/*"

    # ---- dashboards -------------------------------------------------------------------------

    def soda(self) -> DataFrame:
        """Order lines with their profit: discounted price less a cost share of 95 percent."""
        amount = F.col("l_extendedprice").cast("decimal(12,2)")
        profit = amount * (F.lit("0.05").cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)"))
        regions = self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        customers = self.table("customer").join(regions, F.col("c_nationkey") == F.col("n_nationkey"))
        orders = self.table("orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
        lines = self.table("lineitem").join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("l_shipdate").cast("date").alias("sale_date"),
            F.col("r_name").alias("region"),
            F.col("p_name").alias("product"),
            F.col("c_name").alias("customer"),
            profit.cast("decimal(18,4)").alias("profit"),
        )

    def ad_spend(self) -> DataFrame:
        channel = F.array(*[F.lit(c) for c in AD_CHANNELS])[(F.col("o_custkey") % len(AD_CHANNELS)).cast("int")]
        return self.table("orders").select(
            (2012 + F.col("o_orderkey") % 13).cast("int").alias("year"),
            channel.alias("channel"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("spend"),
        )
