"""Exact quantiles and rank cuts by sketched brackets."""

import datetime as dt
import math
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import binning as B

SHARES = [0.0, 0.2, 0.25, 0.5, 0.8, 0.999, 1.0]


def shapes():
    pick = random.Random(3)
    return {
        "distinct": [float(pick.random()) for _ in range(4000)],
        "two heavy values": [1.0] * 1500 + [2.0] * 1500 + [1.0 + k / 4000 for k in range(1, 1000)],
        "one value": [5.0] * 300,
        "few": [3.0, -1.0],
        "long tail": [float(int(1 / (1 - pick.random()))) for _ in range(3000)],
        "holes": [None, 4.0, None, 1.0, None, 9.0],
    }


@pytest.fixture
def driver_rows(monkeypatch):
    """Numbers of groups that reach the driver."""
    seen, counted = [], B._counted
    monkeypatch.setattr(B, "_counted", lambda *a: seen.append(counted(*a)) or seen[-1])
    return seen


@pytest.mark.parametrize("collected", [100_000, 50])
@pytest.mark.parametrize("shape", shapes())
def test_quantiles_equal_numpy(frame, monkeypatch, driver_rows, shape, collected):
    monkeypatch.setattr(B, "COLLECTED", collected)
    values = shapes()[shape]
    got = B.quantiles(frame([(v,) for v in values], "v double").repartition(3), "v", SHARES)
    assert got == pytest.approx(list(np.quantile([v for v in values if v is not None], SHARES)), rel=1e-12)
    assert all(len(x) <= collected + 2 * len(SHARES) + 1 for x in driver_rows)


@pytest.mark.parametrize("collected", [100_000, 20])
@pytest.mark.parametrize("shape", ["two heavy values", "long tail", "one value"])
def test_rank_cuts_equal_sorting(frame, monkeypatch, shape, collected):
    monkeypatch.setattr(B, "COLLECTED", collected)
    rows = [(v, None if k % 97 == 0 else k * 7919 % 5003) for k, v in enumerate(shapes()[shape])]
    want = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0))
    got = B.rank_cuts(frame(rows, "v double, t int"), "v", "t", 5)
    assert got == [want[math.floor((len(rows) - 1) * p)] for p in B.inner_probabilities(5)]


def test_types(frame):
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=k * k % 731) for k in range(500)]
    amounts = [Decimal(k * k % 977) / 100 for k in range(500)]
    df = frame(list(zip(days, amounts)), "d date, a decimal(20,2)")
    for c, values in (("d", days), ("a", amounts)):
        total, found = B.values_at(df, c, lambda n: range(0, n, 50), [k / 10 for k in range(10)])
        assert total == 500 and {p: v for p, (v, _, _) in found.items()} == {p: sorted(values)[p] for p in range(0, 500, 50)}
    assert B.rank_cuts(df.select(F.col("d").cast("string").alias("d"), "a"), "d", "a", 2) == [sorted(zip(map(str, days), amounts))[249]]


def test_ten_million_distinct_values(spark, driver_rows):
    """What reaches the driver is a small share of the values, and nothing is sorted or written."""
    n = 10_000_000
    df = spark.range(n).select(((F.col("id") * 7_368_787) % n).alias("v"))
    got = B.quantiles(df, "v", [0.2, 0.4, 0.6, 0.8])
    assert got == pytest.approx([(n - 1) * p for p in (0.2, 0.4, 0.6, 0.8)], rel=1e-12)
    assert sum(map(len, driver_rows)) <= 4 * 4 * B.MARGIN * n
