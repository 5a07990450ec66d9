import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import events as E, schedule as S
from tallyloom.operators.sequence import nth_rows, with_neighbors

EVENTS = "event_id long, customer_id int, plan_id int, start_date date"


def d(text):
    return dt.date.fromisoformat(text)


@pytest.fixture
def plans(frame):
    rows = frame([(0, "trial", "0"), (1, "basic monthly", "10"), (2, "pro monthly", "20"), (3, "pro annual", "199"), (4, "churn", None)], "plan_id int, plan_name string, price string")
    return rows.withColumn("price", F.col("price").cast("decimal(10,2)"))


def events(frame, *rows):
    return frame([(i, c, p, d(day)) for i, (c, p, day) in enumerate(rows)], EVENTS)


def random_events(frame, n=600):
    rng = random.Random(5)
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=k) for k in range(40)]
    # customer 1 holds a third of all rows
    return frame([(i, 1 if rng.random() < 0.34 else rng.randrange(2, 30), rng.randrange(5), rng.choice(days)) for i in range(n)], EVENTS)


FOLLOWING = {"next_plan": "plan_id", "next_day": "start_date"}
PRECEDING = {"prev_plan": "plan_id"}


def neighbours_of(data):
    """(event, next plan, next day, previous plan, place) of every row, by plain sorting; missing days come last."""
    out = []
    for key in {r[1] for r in data}:
        mine = sorted((r for r in data if r[1] == key), key=lambda r: (r[3] is None, r[3] or dt.date.min, r[0]))
        for k, r in enumerate(mine):
            after, before = mine[k + 1] if k + 1 < len(mine) else None, mine[k - 1] if k else None
            out.append((r[0], after and after[2], after and after[3], before and before[2], k + 1))
    return sorted(out, key=repr)


@pytest.fixture
def many_parts(spark):
    """Range partitions of a few rows each."""
    conf = {"spark.sql.shuffle.partitions": "37", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield 37
    for k, v in before.items():
        spark.conf.set(k, v)


def shapes():
    rng = random.Random(8)
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=k) for k in range(40)]
    ids = rng.sample(range(10**12), 500)
    return {
        "a third on one key": [(i, 1 if rng.random() < 0.34 else rng.randrange(2, 30), rng.randrange(5), rng.choice(days)) for i in range(500)],
        "one key, ids not in day order": [(i, 1, rng.randrange(5), rng.choice(days)) for i in ids],
        "one key, one day": [(i, 1, i % 5, days[0]) for i in range(300)],
        "no key, no day": [(i, rng.choice([None, 1, 2]), rng.randrange(5), rng.choice([None, *days])) for i in range(500)],
        "every key once": [(i, i, 0, days[0]) for i in range(200)],
        "nothing": [],
    }


@pytest.mark.parametrize("shape", shapes())
def test_neighbours_equal_plain_sorting(frame, rows, many_parts, shape):
    data = shapes()[shape]
    got = with_neighbors(frame(data, EVENTS), "customer_id", E.EVENT_ORDER, FOLLOWING, PRECEDING, "place")
    assert got.columns == [*EVENTS.replace(",", "").split()[::2], *FOLLOWING, *PRECEDING, "place"]
    assert rows(got, "event_id", "next_plan", "next_day", "prev_plan", "place") == neighbours_of(data)


def test_a_key_is_spread_over_partitions(spark, many_parts, monkeypatch):
    """One key holds all rows, its ids are not in day order; no window group is much larger than a partition's share."""
    from tallyloom.operators import sequence

    seen = []
    monkeypatch.setattr(sequence, "cut_lineage", lambda df: seen.append(df.checkpoint()) or seen[-1])
    n = 40_000
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.abs(F.hash("id")) % 50).cast("int"))
    df = spark.range(n).select((F.abs(F.xxhash64("id"))).alias("event_id"), F.lit(1).alias("customer_id"), F.lit(0).alias("plan_id"), day.alias("start_date"))
    placed = with_neighbors(df, "customer_id", E.EVENT_ORDER, FOLLOWING, position="place")
    assert placed.agg(F.max("place"), F.count_if(F.col("next_day").isNull())).first() == (n, 1)
    groups = [r["count"] for r in seen[0].groupBy("customer_id", "_part").count().collect()]
    assert len(groups) > many_parts / 2 and max(groups) < 4 * n / many_parts


def test_nth_row_is_cut_before_the_shuffle(frame, rows):
    df = random_events(frame)
    second = nth_rows(df, "customer_id", E.EVENT_ORDER, 2)
    place = with_neighbors(df, "customer_id", E.EVENT_ORDER, position="place")
    assert rows(second) == rows(place.filter("place = 2").drop("place"))
    assert "WindowGroupLimit" in second._jdf.queryExecution().executedPlan().toString()


def test_missing_customers_and_days(frame, plans, rows):
    df = frame(
        [(1, 1, 0, d("2020-01-01")), (2, 1, 4, d("2020-01-10")), (3, None, 0, d("2020-01-01")), (4, None, 4, d("2020-01-02")), (5, None, 3, d("2020-03-01")), (6, 2, 0, d("2020-01-01")), (7, 2, 3, d("2020-02-10")), (8, 2, 3, None), (9, 2, 0, None)],
        EVENTS,
    )
    assert [float(x) for x in rows(E.churn_rate(df))[0]] == [1, 50.0]
    assert {r["plan_name"]: r["customer_count"] for r in E.plan_mix_as_of(df, plans, "2020-12-31").collect()} == {"churn": 1, "pro annual": 1}
    assert float(E.mean_days_between(df, 0, 3).first()[0]) == 40
    assert [(r["bucket_no"], r["customer_count"]) for r in E.days_histogram(df, 0, 3).collect()] == [(2, 1)]


def test_transition_mix_and_churn(frame, plans, rows):
    df = events(
        frame,
        (1, 0, "2020-01-01"), (1, 4, "2020-01-08"),
        (2, 0, "2020-01-01"), (2, 1, "2020-01-08"), (2, 4, "2020-02-01"), (2, 2, "2020-03-01"),
        (3, 0, "2020-01-01"),
    )
    assert [float(x) for x in rows(E.transition_rate(df, 0, 4))[0]] == [1, 33.3]
    assert [float(x) for x in rows(E.churn_rate(df))[0]] == [2, 66.7]
    mix = {r["plan_name"]: (r["customer_count"], float(r["pct_of_customers"])) for r in E.nth_plan_mix(df, plans).collect()}
    assert mix == {"churn": (1, 33.3), "basic monthly": (1, 33.3)}
    as_of = {r["plan_name"]: r["customer_count"] for r in E.plan_mix_as_of(df, plans, "2020-02-01").collect()}
    assert as_of == {"churn": 2, "trial": 1}
    assert rows(E.downgrades_in(df, 4, 2, "2020-03-01", "2020-03-02")) == [(1,)]
    assert rows(E.downgrades_in(df, 4, 2, "2020-02-01", "2020-03-01")) == [(0,)]
    assert rows(E.upgrades_in(df, 2, "2020-01-01", "2020-03-01")) == [(0,)]
    assert rows(E.events_after(df, plans, "2020-02-01")) == [("churn", 1), ("pro monthly", 1)]
    assert rows(E.customer_journey(df, plans, [1]), "plan_name") == [("churn",), ("trial",)]


def test_same_day_events_follow_their_id(frame, plans, rows):
    df = events(frame, (1, 0, "2020-01-01"), (1, 2, "2020-01-05"), (1, 1, "2020-01-05"))
    seq = E.plan_sequence(df, plans)
    assert rows(seq, "plan_order", "plan_id", "next_plan_id") == [(1, 0, 2), (2, 2, 1), (3, 1, None)]
    assert rows(E.plan_mix_as_of(df, plans, "2020-01-05"), "plan_name") == [("basic monthly",)]


def test_mix_sums_to_customers_started(frame, plans):
    df = random_events(frame)
    for day in ("2020-01-03", "2020-01-20", "2020-12-31"):
        total = E.plan_mix_as_of(df, plans, day).agg(F.sum("customer_count")).collect()[0][0]
        assert total == df.filter(F.col("start_date") <= day).select("customer_id").distinct().count()


def pairs_of(df, a, b):
    data = [r.asDict() for r in df.collect()]
    return [
        (y["start_date"] - x["start_date"]).days
        for x in data
        for y in data
        if x["customer_id"] == y["customer_id"] and x["plan_id"] == a and y["plan_id"] == b
    ]


def test_days_between_equal_brute_force_pairs(frame):
    df = random_events(frame)
    days = pairs_of(df, 0, 3)
    mean = float(E.mean_days_between(df, 0, 3).collect()[0][0])
    assert mean == pytest.approx(sum(days) / len(days), abs=0.006)
    want = {}
    for x in days:
        bucket = 0 if x < 0 else 5 if x >= 40 else x // 10 + 1
        want[bucket] = want.get(bucket, 0) + 1
    got = {r["bucket_no"]: r["customer_count"] for r in E.days_histogram(df, 0, 3, 0, 40, 4).collect()}
    assert got == want


def test_buckets_that_do_not_divide_the_range(frame, spark):
    """As the width_bucket function."""
    first = d("2020-01-01")
    df = events(frame, (1, 0, str(first)), *[(1, 3, str(first + dt.timedelta(days=k))) for k in range(-3, 110)])
    got = {r["bucket_no"]: r["customer_count"] for r in E.days_histogram(df, 0, 3, 0, 100, 12).collect()}
    want = spark.range(-3, 110).select(F.width_bucket("id", F.lit(0), F.lit(100), F.lit(12)).alias("b")).groupBy("b").count()
    assert got == {r["b"]: r["count"] for r in want.collect()}


def test_bucket_edges(frame, rows):
    df = events(
        frame, (1, 0, "2020-01-01"), *[(1, 3, str(d("2020-01-01") + dt.timedelta(days=k))) for k in (-1, 0, 29, 30, 359, 360, 1000)]
    )
    got = [(r["day_range"], r["customer_count"]) for r in E.days_histogram(df, 0, 3).orderBy("bucket_no").collect()]
    assert got == [("-30-0 days", 1), ("0-30 days", 2), ("30-60 days", 1), ("330-360 days", 1), ("360-390 days", 2)]


def test_no_pairs(frame, rows):
    df = events(frame, (1, 0, "2020-01-01"))
    assert rows(E.mean_days_between(df, 0, 3)) == [(None,)]
    assert rows(E.days_histogram(df, 0, 3)) == []


def payments(df, plans, rows, horizon="2020-12-31", **kw):
    paid = rows(S.payment_schedule(df, plans, horizon, **kw), "payment_date", "amount", "payment_order")
    return sorted((str(a), float(b), c) for a, b, c in paid)


def test_payments_repeat_until_the_day_before_the_next_plan(frame, plans, rows):
    df = events(frame, (1, 0, "2020-01-01"), (1, 1, "2020-01-08"), (1, 2, "2020-03-08"), (1, 4, "2020-05-07"))
    assert payments(df, plans, rows) == [
        ("2020-01-08", 10, 1),
        ("2020-02-08", 10, 2),
        ("2020-03-08", 20, 1),
        ("2020-04-08", 20, 2),
    ]


def test_month_end_stays_at_the_shortest_month(frame, plans, rows):
    df = events(frame, (1, 1, "2020-01-31"))
    assert [p[0] for p in payments(df, plans, rows, "2020-05-29")] == ["2020-01-31", "2020-02-29", "2020-03-29", "2020-04-29", "2020-05-29"]
    df = events(frame, (1, 1, "2021-01-30"))
    assert [p[0] for p in payments(df, plans, rows, "2021-04-28")] == ["2021-01-30", "2021-02-28", "2021-03-28", "2021-04-28"]
    df = events(frame, (1, 1, "2021-03-31"))
    assert [p[0] for p in payments(df, plans, rows, "2021-05-31")] == ["2021-03-31", "2021-04-30", "2021-05-30"]


def test_annual_pays_once_and_horizon_cuts(frame, plans, rows):
    df = events(frame, (1, 3, "2020-02-01"), (2, 1, "2020-12-31"), (3, 1, "2021-01-01"))
    assert payments(df, plans, rows) == [("2020-02-01", 199, 1), ("2020-12-31", 10, 1)]


def test_credit_modes(frame, plans, rows):
    df = events(frame, (1, 1, "2020-11-01"), (1, 2, "2020-12-01"))
    assert [p[1] for p in payments(df, plans, rows)] == [10, 20]
    assert [p[1] for p in payments(df, plans, rows, credit="upgrade")] == [10, 10]
    # the next plan on the same day: the credit of the as-written rule
    df = events(frame, (1, 1, "2020-11-01"), (1, 2, "2020-12-01"), (1, 4, "2020-12-01"))
    assert [p[1] for p in payments(df, plans, rows)] == [10, 10]
    assert [p[1] for p in payments(df, plans, rows, credit="none")] == [10, 20]
    with pytest.raises(ValueError):
        S.payment_schedule(df, plans, "2020-12-31", "sometimes")


def test_unpaid_plans_count_as_neighbours(frame, plans, rows):
    # trial between basic and pro: the previous plan is the trial, so nothing is credited
    df = events(frame, (1, 1, "2020-10-01"), (1, 0, "2020-10-15"), (1, 2, "2020-12-01"))
    assert payments(df, plans, rows, credit="upgrade") == [("2020-10-01", 10, 1), ("2020-12-01", 20, 1)]


def test_payments_increase_and_keep_the_bound(frame, plans):
    df = random_events(frame)
    paid = S.payment_schedule(df, plans, "2020-06-30").collect()
    by_event = {}
    for r in sorted(paid, key=lambda r: r["payment_order"]):
        by_event.setdefault(r["event_id"], []).append(r["payment_date"])
    assert by_event
    for dates in by_event.values():
        assert dates == sorted(set(dates)) and dates[-1] <= d("2020-06-30")


def step(day):
    """One month later, clamped to the month's end."""
    year, month = divmod(day.year * 12 + day.month, 12)
    for number in range(day.day, 27, -1):
        try:
            return dt.date(year, month + 1, number)
        except ValueError:
            continue
    return dt.date(year, month + 1, day.day)


def test_monthly_dates_equal_repeated_steps(frame):
    rng = random.Random(3)
    cases = [(dt.date(1999, 1, 1) + dt.timedelta(days=rng.randrange(3000)), rng.randrange(40)) for _ in range(800)]
    df = frame(cases, "start date, months int").withColumn("dates", S.monthly_dates(F.col("start"), F.col("months")))
    for r in df.collect():
        want = [r["start"]]
        while len(want) <= r["months"]:
            want.append(step(want[-1]))
        assert r["dates"] == want
