import datetime as dt
import itertools
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.functions import exprs as X
from tallyloom.operators import binning as B, calendar as C, cohort as H, delivery as D, ranking as R, segments as G, share as P

SALES = "invoice string, customer_id long, country string, description string, invoice_date timestamp_ntz, revenue double"


def ts(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def shop(frame):
    """A shop where one customer holds a third of the rows."""
    rng = random.Random(11)
    start = ts("2010-01-03 09:00:00")
    out = []
    for i in range(900):
        customer = 500 if rng.random() < 0.34 else rng.choice([None, *range(1, 60)])
        when = start + dt.timedelta(days=rng.randrange(400), minutes=rng.randrange(600))
        out.append((f"i{rng.randrange(350)}", customer, rng.choice("ABCDEFGH"), rng.choice(["mug", "cup", None]), when, float(rng.randrange(1, 9000)) / 100))
    return frame(out, SALES)


def pandas_of(df):
    return df.toPandas()


def test_rfm_scores_equal_pandas(shop):
    got = G.rfm_segments(G.rfm_scores(G.rfm_values(shop))).toPandas().sort_values("customer_id").reset_index(drop=True)
    pdf = pandas_of(shop)
    ref = pdf["invoice_date"].max() + pd.Timedelta(days=1)
    known = pdf[pdf["customer_id"].notna()].groupby("customer_id")
    want = pd.DataFrame(
        {"recency": (ref - known["invoice_date"].max()).dt.days, "frequency": known["invoice"].nunique(), "monetary": known["revenue"].sum()}
    ).reset_index()
    assert (got["recency"] == want["recency"]).all() and (got["frequency"] == want["frequency"]).all()
    assert np.allclose(got["monetary"], want["monetary"])
    assert (got["r_score"] == 6 - pd.qcut(want["recency"], 5, labels=[1, 2, 3, 4, 5]).astype(int)).all()
    assert (got["f_score"] == pd.qcut(want["frequency"].rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).astype(int)).all()
    assert (got["m_score"] == pd.qcut(want["monetary"], 5, labels=[1, 2, 3, 4, 5]).astype(int)).all()
    summary = G.segment_summary(G.rfm_segments(G.rfm_scores(G.rfm_values(shop)))).toPandas()
    assert summary["customers"].sum() == len(want)


# Score triples written out, with the segment each must have: corners, edges between rules, and the leftovers.
TRIPLES = {
    "444 454 545 555": "Best Customers",
    "144 145 155": "Cannot Lose Customers",
    "411 425 521 515": "New Customers",
    "333 334 355 433 533 543": "Loyal Customers",
    "321 325 332 342 442 552": "Potential Loyal Customers",
    "133 143 134 244 255 233": "At Risk Customers",
    "111 125 215 222": "Lost Customers",
    "311 315 131 152 232 251": "Needs Attention",
}


def test_segments_of_triples(frame):
    triples = [tuple(map(int, t)) for group in TRIPLES for t in group.split()]
    got = {f"{r[0]}{r[1]}{r[2]}": r[3] for r in frame(triples, "r_score int, f_score int, m_score int").withColumn("s", G.segment()).collect()}
    assert got == {t: name for group, name in TRIPLES.items() for t in group.split()}


def test_segment_sizes(frame):
    grid = list(itertools.product(range(1, 6), repeat=3))
    sizes = pd.Series([r[0] for r in frame(grid, "r_score int, f_score int, m_score int").select(G.segment()).collect()]).value_counts().to_dict()
    assert sizes == {
        "Best Customers": 8, "Cannot Lose Customers": 4, "New Customers": 20, "Loyal Customers": 19,
        "Potential Loyal Customers": 23, "At Risk Customers": 14, "Lost Customers": 20, "Needs Attention": 17,
    }


@pytest.mark.parametrize("amount", [1e13, 1e16, 1e20])
def test_large_amounts(frame, amount):
    rows = frame([(2020, "a", 1), (2020, "b", 2)], "year int, channel string, k int").withColumn("spend", F.col("k") * F.lit(str(int(amount))).cast("decimal(28,2)"))
    assert [float(r["share_pct"]) for r in P.channel_share_by_year(rows).orderBy("channel").collect()] == [33.33, 66.67]
    series = rows.select("channel", F.col("spend").alias("revenue"))
    assert float(C.with_overall_mean(series).first()["mean_revenue"]) == pytest.approx(1.5 * amount)
    per_customer = rows.select(F.lit("x").alias("country"), F.col("k").alias("customer_id"), F.col("spend").alias("revenue"))
    assert float(R.revenue_per_customer(per_customer).first()["avg_revenue_per_customer"]) == pytest.approx(1.5 * amount)


@pytest.mark.parametrize("n, d, digits, want", [(1, 8, 2, "0.13"), (-1, 8, 2, "-0.13"), (1, -8, 2, "-0.13"), (5, 1000, 2, "0.01"), ("4.9999", 1000, 2, "0.00"), (2, 3, 1, "0.7"), (7, 0, 2, None), (None, 3, 2, None), (0, 3, 2, "0.00")])
def test_rounding_is_exact(frame, n, d, digits, want):
    df = frame([(None if n is None else str(n), str(d))], "n string, d string").select(F.col("n").cast("decimal(28,4)").alias("n"), F.col("d").cast("decimal(20,2)").alias("d"))
    got = df.select(X.rounded_ratio("n", "d", digits)).first()[0]
    assert (got is None and want is None) or got == __import__("decimal").Decimal(want)


def test_place_beyond_the_list(frame):
    df = frame([("i", 7, "A", "x", ts("2010-01-01"), 5.0), ("j", 8, "A", "x", ts("2010-01-01"), 9.0)], SALES)
    assert [df.select(R.kth_customer_by_revenue(df, k)).first()[0] for k in (1, 2, 3)] == [8, 7, None]


@pytest.mark.parametrize("values", [[5, 1, 4, 2, 3], [1, 1, 1, 2, 2, 9], list(range(23)), [7], [3, 3, 3]])
def test_quantile_edges_equal_numpy(frame, values):
    df = frame([(float(v), i) for i, v in enumerate(values)], "v double, id long")
    got = B.quantiles(df, "v", [0.2, 0.4, 0.6, 0.8])
    assert got == pytest.approx(list(np.quantile(values, [0.2, 0.4, 0.6, 0.8])))


def test_ordinals_with_heavy_ties(frame, rows):
    df = frame([(1 if i % 3 else 2 + i % 7, i * 37 % 1000) for i in range(1000)], "v int, id long")
    got = B.SortedRows(df, "v", "id").with_ordinal("place")
    want = sorted((r["v"], r["id"]) for r in df.collect())
    assert rows(got, "place", "v", "id") == sorted(((k, *pair) for k, pair in enumerate(want, 1)), key=repr)


def test_empty_edges(frame):
    df = frame([], "v double, id long")
    assert B.quantiles(df, "v", [0.5]) == [None]
    assert B.rank_cuts(df, "v", "id", 5) == []


def test_repeated_edges_take_the_smallest_bin(frame):
    df = frame([(i, float(v)) for i, v in enumerate([1, 1, 1, 1, 1, 1, 1, 9])], "id int, v double")
    got = [r["t"] for r in B.quantile_tiers(df, "v", B.TIER_LABELS, "t").orderBy("id").collect()]
    assert got == ["Very Low"] * 7 + ["Very High"]


def test_country_tiers_equal_pandas(shop):
    totals = R.country_revenue_tiers(shop).toPandas().sort_values("country").reset_index(drop=True)
    want = pd.qcut(totals["revenue"], 5, labels=list(B.TIER_LABELS)).astype(str)
    assert (totals["revenue_tier"] == want).all()


def test_single_customer_countries(frame):
    counts = {"A": 1, "B": 1, "C": 5, "D": 7, "E": 11, "F": 20}
    df = frame([("i", c, k, "x", ts("2010-01-01"), 1.0) for k, n in counts.items() for c in range(n)], SALES)
    got = {r["country"]: r["customer_tier"] for r in R.country_customer_tiers(df).collect()}
    assert got == {"A": "Very Low", "B": "Very Low", "C": "Low", "D": "Medium", "E": "High", "F": "Very High"}


def test_country_without_customers(frame):
    data = [("A", None, 5.0), ("B", 1, 4.0), ("C", 2, 6.0), ("C", 3, 6.0), ("D", 4, 9.0), ("E", 5, 20.0)]
    df = frame([("i", c, k, "x", ts("2010-01-01"), v) for k, c, v in data], SALES)
    got = {r["country"]: (None if r["avg_revenue_per_customer"] is None else float(r["avg_revenue_per_customer"]), r["revenue_tier"]) for r in R.revenue_per_customer_tiers(df).collect()}
    assert got["A"] == (None, None)
    assert got["B"] == (4.0, "Very Low")
    assert [got[c][1] for c in "CDE"] == ["Low", "Medium", "Very High"]
    assert [r["country"] for r in R.top_revenue_per_customer(df).collect()] == ["E", "D", "C", "B"]


def test_cut_before_or_after_the_list(frame):
    df = frame([("i", 1, c, "x", ts("2010-01-01"), float(v)) for v, c in enumerate("ABCDEFGHIJKL")], SALES)
    top = R.top_k(R.country_revenue(df), "revenue", 10, "country")
    assert R.without(top, "country", "L").count() == 9
    assert R.top_k(R.without(R.country_revenue(df), "country", "L"), "revenue", 10, "country").count() == 10


def test_months_without_sales_are_zero(frame):
    df = frame([("i", 1, "A", "x", ts(t), v) for t, v in [("2010-01-31 10:00", 10.0), ("2010-04-01 00:00", 2.0)]], SALES)
    got = [(str(r["month_end"]), float(r["revenue"]), float(r["mean_revenue"])) for r in C.with_overall_mean(C.monthly_revenue(df)).orderBy("month_end").collect()]
    assert got == [("2010-01-31", 10, 3), ("2010-02-28", 0, 3), ("2010-03-31", 0, 3), ("2010-04-30", 2, 3)]


def test_retention_equals_pandas(shop):
    got = H.cohort_retention(H.cohort_counts(shop)).toPandas()
    pdf = pandas_of(shop)
    pdf = pdf[pdf["customer_id"].notna()].copy()
    pdf["month"] = pdf["invoice_date"].dt.to_period("M")
    pdf["cohort"] = pdf.groupby("customer_id")["month"].transform("min")
    pdf["gap"] = [(a - b).n for a, b in zip(pdf["month"], pdf["cohort"])]
    table = pdf.groupby(["cohort", "gap"])["customer_id"].nunique().unstack()
    share = (table.div(table[0], axis=0).round(3) * 100).round(1)
    assert len(got) == int(table.notna().sum().sum())
    for r in got.itertuples():
        cohort = pd.Period(r.cohort_month, "M")
        assert table.loc[cohort, r.months_elapsed] == r.customers
        assert share.loc[cohort, r.months_elapsed] == pytest.approx(r.retention_pct)
    assert set(got[got["months_elapsed"] == 0]["retention_pct"]) == {100.0}
    wide = {r.cohort_month: r.cells for r in H.cohort_matrix(H.cohort_retention(H.cohort_counts(shop))).collect()}
    assert {len(cells) for cells in wide.values()} == {max(got["months_elapsed"]) + 1}
    assert {(m, k): v for m, cells in wide.items() for k, v in enumerate(cells) if v is not None} == {(r.cohort_month, r.months_elapsed): r.retention_pct for r in got.itertuples()}


def test_cohort_matrix_has_one_schema(frame):
    schema = "cohort_month date, months_elapsed int, retention_pct double"
    gaps = frame([(dt.date(2020, 1, 1), 0, 100.0), (dt.date(2020, 1, 1), 3, 12.5), (dt.date(2020, 2, 1), 0, 100.0)], schema)
    assert {tuple(r.cells) for r in H.cohort_matrix(gaps).collect()} == {(100.0, None, None, 12.5), (100.0, None, None, None)}
    assert [tuple(r) for r in H.shown_cells(H.cohort_matrix(gaps)).orderBy("cohort_month").collect()][0][1:] == (4, "100.0 - - 12.5")
    nothing = H.cohort_matrix(gaps.limit(0))
    assert nothing.dtypes == H.cohort_matrix(gaps).dtypes and nothing.collect() == []


def test_top_lists(frame):
    data = [("i1", 1, "mug", 5.0), ("i1", 1, "mug", 1.0), ("i2", 1, None, 9.0), ("i3", 2, "cup", 6.0), ("i4", None, "cup", 50.0)]
    df = frame([(i, c, "A", p, ts("2010-01-01"), v) for i, c, p, v in data], SALES)
    assert [tuple(r) for r in R.top_products(df).collect()] == [("cup", 56.0), ("mug", 6.0)]
    assert [tuple(r) for r in R.top_customers_by_revenue(df).collect()] == [(1, 15.0), (2, 6.0)]
    assert [tuple(r) for r in R.top_customers_by_invoices(df).collect()] == [(1, 2), (2, 1)]
    assert [(r[0], float(r[1])) for r in R.top_customers_by_mean(df).collect()] == [(2, 6.0), (1, 5.0)]
    assert [(r[0], float(r[1])) for r in R.top_customers_by_mean(df, per="invoice").collect()] == [(1, 7.5), (2, 6.0)]
    assert df.select(R.kth_customer_by_revenue(df, 2)).first()[0] == 2


def test_extremes_and_shares(frame, rows):
    totals = frame([("a", 3), ("b", -1), ("c", 7)], "product string, profit int")
    assert rows(R.extremes(totals, "product", k=1), "product", "end") == [("b", "least"), ("c", "most")]
    spend = frame([(2012, "TV", 30), (2012, "Search", 10), (2024, "TV", 5)], "year int, channel string, spend int")
    shared = P.channel_share_by_year(spend)
    assert [(a, b, float(c), p) for a, b, c, p in rows(shared, "year", "channel", "share_pct", "projected")] == [
        (2012, "Search", 25.0, False),
        (2012, "TV", 75.0, False),
        (2024, "TV", 100.0, True),
    ]
    grouped = P.digital_share_by_year(spend, ["Search"])
    assert rows(grouped, "year", "channel") == [(2012, "digital"), (2012, "traditional"), (2024, "traditional")]


def test_scalar_expressions(frame):
    df = frame([(ts("2021-01-08 23:10:00"), ts("2021-01-09 22:00:00"), dt.date(2021, 1, 8), None)], "a timestamp_ntz, b timestamp_ntz, day date, n string")
    row = df.select(
        X.weekday_label("a").alias("weekday"),
        X.minutes_between("a", "b").cast("double").alias("minutes"),
        X.whole_days("a", "b").alias("days"),
        X.week_number("day", "2021-01-01").alias("week"),
        X.month_gap(F.lit("2020-11-30").cast("date"), "day").alias("gap"),
        X.concat_skip_null("day", "n", F.lit("!")).alias("text"),
        X.percent(F.lit(1), F.lit(3), 1).cast("double").alias("pct"),
        X.percent(F.lit(1), F.lit(0), 1).alias("none"),
        X.rounded_ratio(F.lit(5), F.lit(8), 2).cast("double").alias("away"),
        F.bround(F.lit(0.125), 2).alias("even"),
        X.differs_or_null("n", "x").alias("differs"),
        X.has_prefix(F.lit(123), "12").alias("prefix"),
        B.equal_width_bucket(F.lit(360), 0, 360, 12).alias("bucket"),
    ).first()
    assert row.weekday == "FRIDAY   " and row.minutes == 1370 and row.days == 0 and row.week == 2 and row.gap == 2
    assert row.text == "2021-01-08!" and row.pct == 33.3 and row.none is None and row.away == 0.63 and row.even == 0.12
    assert row.differs and row.prefix and row.bucket == 13


def test_prices_without_an_entry_add_nothing(frame, rows):
    orders = frame([(1, 7, 1, None, None), (1, 7, 2, None, "1, 4"), (1, 7, 3, None, None), (2, 7, 1, None, "1")], "order_id int, customer_id int, pizza_id int, exclusions string, extras string")
    runs = frame([(1, None, "10.5"), (2, "Customer Cancellation", None)], "order_id int, cancellation string, distance string").withColumn("distance", F.col("distance").cast("decimal(10,2)"))
    assert rows(D.revenue(orders, runs)) == [(22,)]
    assert rows(D.revenue(orders, runs, extra_fee=1)) == [(24,)]
    assert [float(x) for x in rows(D.net_money(orders, runs))[0]] == [22, 3.15, 18.85]
    assert rows(D.both_changes(orders, runs)) == [(0,)]
    assert rows(D.largest_order(orders)) == [(3,)] and rows(D.largest_order(orders, runs)) == [(3,)]
