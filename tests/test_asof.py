"""As-of matching with many anchors per key, and the daily sweep, against plain versions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import asof as A, events as E

DAY = dt.date(2020, 1, 1)


def day(k):
    return None if k is None else DAY + dt.timedelta(days=k)


def table(seed, n, keys, span):
    """A third of the rows have one key; some keys and days are missing."""
    pick = random.Random(seed)
    return [(k, 1 if pick.random() < 0.34 else pick.choice([None, *range(2, keys)]), day(pick.choice([None, *range(span)]))) for k in range(n)]


@pytest.fixture
def many_parts(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def plain(rows, anchors, direction, inclusive):
    out = []
    for i, key, at in rows:
        fit = [a for _, k, a in anchors if None not in (key, at, a) and k == key and (a == at and inclusive or (a < at if direction == "before" else a > at))]
        out.append((i, key, at, (max(fit) if direction == "before" else min(fit)) if fit else None))
    return sorted(out)


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("direction", A.DIRECTIONS)
def test_as_of_equals_a_plain_search(frame, many_parts, direction, inclusive):
    rows, anchors = table(1, 800, 12, 90), table(2, 300, 14, 90)
    got = A.as_of(frame(rows, "id int, who int, d date"), frame(anchors, "n int, who int, a date"), "who", "d", "a", direction, inclusive)
    assert sorted(map(tuple, got.collect())) == plain(rows, anchors, direction, inclusive)


def test_as_of_without_rows_or_anchors(frame):
    rows, anchors = frame(table(1, 20, 5, 9), "id int, who int, d date"), frame(table(2, 20, 5, 9), "n int, who int, a date")
    assert A.as_of(rows.limit(0), anchors, "who", "d", "a").count() == 0
    assert [r.as_of for r in A.as_of(rows, anchors.limit(0), "who", "d", "a").collect()] == [None] * 20
    with pytest.raises(ValueError):
        A.as_of(rows, anchors, "who", "d", "a", "sideways")


def test_mixed_times(frame):
    rows = frame([(1, 7, dt.datetime(2020, 1, 2, 12)), (2, 7, dt.datetime(2020, 1, 1, 0)), (3, 7, dt.datetime(2019, 1, 1, 0))], "id int, who int, t timestamp_ntz")
    anchors = frame([(7, day(0)), (7, day(1)), (7, day(2))], "who int, a date")
    got = {r.id: r.as_of for r in A.as_of(rows, anchors, "who", "t", "a").collect()}
    assert got == {1: dt.datetime(2020, 1, 2), 2: dt.datetime(2020, 1, 1), 3: None}


def test_a_hot_key_is_spread_and_nothing_is_multiplied(spark, many_parts, monkeypatch):
    seen = []
    monkeypatch.setattr(A, "cut_lineage", lambda df: seen.append(df.checkpoint()) or seen[-1])
    n, at = 60_000, lambda c, m: F.date_add(F.lit(DAY), (F.abs(F.hash(c)) % m).cast("int"))
    rows = spark.range(n).select("id", F.lit(1).alias("who"), at(F.col("id"), 3000).alias("d"))
    anchors = spark.range(20_000).select(F.lit(1).alias("who"), at(F.col("id") + 5, 3000).alias("a"))
    got = A.as_of(rows, anchors, "who", "d", "a")
    assert got.count() == n and got.select("id").distinct().count() == n
    days = sorted(r.a for r in anchors.distinct().collect())
    assert got.filter(F.col("as_of").isNull()).count() == rows.filter(F.col("d") < F.lit(days[0])).count()
    sizes = [r["count"] for r in seen[0].groupBy("_part").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 4 * n / 13


def test_rows_of_the_nearest_day_of_each_anchor(frame, many_parts):
    rows, anchors = table(3, 500, 9, 60), table(4, 120, 9, 60)
    for direction, inclusive in (("after", True), ("before", False)):
        got = A.nearest_events(frame(rows, "id int, who int, d date"), frame(anchors, "n int, who int, a date"), direction, key="who", day="d", anchor="a")
        want = []
        for key, a in {(k, a) for _, k, a in anchors if None not in (k, a)}:
            days = [d for _, k, d in rows if k == key and d is not None and (d >= a if direction == "after" else d < a)]
            if days:
                near = min(days) if direction == "after" else max(days)
                want += [(key, near, i, a) for i, k, d in rows if (k, d) == (key, near)]
        assert sorted(tuple(r) for r in got.select("who", "d", "id", "a").collect()) == sorted(want)


def test_the_sweep_gives_every_day_its_mix(frame):
    pick = random.Random(9)
    events = [(k, 1 if pick.random() < 0.3 else pick.choice([None, *range(2, 30)]), pick.randrange(5), day(pick.choice([None, *range(200)]))) for k in range(600)]
    df = frame(events, "event_id int, customer_id int, plan_id int, start_date date")
    plans = frame([(k, f"plan {k}") for k in range(5)], "plan_id int, plan_name string")
    swept = E.plan_mix_by_day(df, plans, "2020-03-01", "2020-07-31").collect()
    assert len(swept) == 5 * 153
    for at in ("2020-03-01", "2020-05-17", "2020-07-31"):
        want = {r.plan_name: (r.customer_count, r.pct_of_customers) for r in E.plan_mix_as_of(df, plans, at).collect()}
        assert {r.plan_name: (r.customer_count, r.pct_of_customers) for r in swept if str(r.day) == at and r.customer_count} == want
    before = E.plan_mix_by_day(df, plans, "2019-01-01", "2019-01-02").collect()
    assert [r.customer_count for r in before] == [0] * 10
