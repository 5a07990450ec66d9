"""One key with a third of all rows: joins are split, windows are cut before the shuffle."""

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import cohort as H, loyalty as L

SPLIT_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}
ROWS = 600_000


@pytest.fixture
def split(spark):
    before = {k: spark.conf.get(k, None) for k in SPLIT_CONF}
    for k, v in SPLIT_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def sales(spark):
    i = F.col("id")
    return spark.range(0, ROWS, 1, 8).select(
        F.when(i % 3 == 0, 1).otherwise(i % 20000).cast("long").alias("customer_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.abs(F.hash("id")) % 700).cast("int")).alias("order_date"),
        (F.abs(F.hash(i + 7)) % 500).cast("int").alias("product_id"),
    )


@pytest.fixture
def members(spark):
    return spark.range(20000).select(F.col("id").alias("customer_id"), F.lit("2020-06-01").cast("date").alias("join_date"))


@pytest.fixture
def menu(spark):
    return spark.range(500).select(
        F.col("id").cast("int").alias("product_id"), F.concat(F.lit("p"), F.col("id")).alias("product_name"), F.lit(3).alias("price")
    )


def final_plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text[: text.find("== Initial Plan ==")]


def test_hot_customer_totals_are_split(split, sales, menu, members):
    assert "skew=true" in final_plan(L.pre_anchor_totals(sales, menu, members))


def test_hot_customer_counts_are_right(split, sales, menu, members):
    got = {r["customer_id"]: r["total_items_ordered"] for r in L.pre_anchor_totals(sales, menu, members).collect()}
    before = sales.filter("order_date < date'2020-06-01'")
    assert got[1] == before.filter("customer_id = 1").count()
    assert sum(got.values()) == before.count()


def shuffled_rows(df):
    """Rows written by each exchange of the executed plan."""
    found = []

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        if kind == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    df.collect()
    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_first_items_and_favourites_shuffle_counts_not_rows(sales, menu):
    """The hot customer's 200,000 rows become at most one row per product and map task."""
    hot = sales.filter("customer_id = 1")
    for df in (L.first_event_items(hot, menu), L.favorite_item(hot, menu), L.spend_by_entity(hot, menu)):
        assert max(shuffled_rows(df)) <= 8 * 500 < hot.count() / 10


def test_ranks_shuffle_days_not_rows(sales, menu, members):
    hot = sales.filter("customer_id = 1")
    days = hot.select("customer_id", "order_date").distinct()
    assert max(shuffled_rows(days)) <= 8 * 700
    assert max(shuffled_rows(L.nearest_event(hot, members))) <= 8 * 700
    ranked = L.member_rank(hot, menu, members)
    assert ranked.count() == hot.count()


def test_cohort_shuffles_months_not_rows(sales):
    rows = sales.filter("customer_id = 1").withColumn("invoice_date", F.col("order_date").cast("timestamp_ntz"))
    assert max(shuffled_rows(H.cohort_counts(rows))) <= 8 * 24
