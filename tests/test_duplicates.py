"""Duplicate rows found by digests: full rows are shuffled among candidates only."""

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import bitmap
from tallyloom.operators import quality as Q

SCHEMA = "a string, b int, c double"
ROWS = [("x", 1, 1.0), ("x", 1, 1.0), ("x", None, 1.0), (None, 1, 1.0), (None, 1, 1.0), (None, None, None), (None, None, None), ("", 1, 1.0), ("y", 2, None), ("y", None, None), ("x", 1, 1.0)]


def test_rows_with_gaps(frame, rows):
    df = frame(ROWS, SCHEMA)
    assert rows(Q.drop_duplicates(df)) == sorted(set(ROWS), key=repr)
    assert Q.duplicate_count(df).first()[0] == len(ROWS) - len(set(ROWS))
    assert Q.drop_duplicates(df.limit(0)).count() == 0 and Q.duplicate_count(df.limit(0)).first()[0] == 0


def test_equal_digests_of_unlike_rows(frame, rows, monkeypatch):
    """Digests only choose candidates: with one digest for all rows the result is the same."""
    monkeypatch.setattr(Q, "row_digest", lambda df: F.lit(7).cast("long") + 0 * F.coalesce(F.length("a"), F.lit(0)))
    df = frame(ROWS, SCHEMA)
    assert rows(Q.drop_duplicates(df)) == sorted(set(ROWS), key=repr)
    assert Q.duplicate_count(df).first()[0] == len(ROWS) - len(set(ROWS))


def test_few_rows_are_candidates(spark):
    """One row in fifty has a copy, and one row has 5,000: what is compared in full is about what repeats."""
    i = F.col("id")
    df = spark.range(0, 200_000, 1, 8).select(F.when(i % 50 == 0, i - i % 100).when(i % 40 == 1, 7).otherwise(i).alias("a"), F.lit("some text").alias("b"))
    repeated = df.groupBy("a", "b").count().filter("count > 1").agg(F.sum("count")).first()[0]
    found = Q.duplicate_candidates(df).count()
    assert repeated <= found <= repeated + 200_000 * 2 * repeated / bitmap.SLOTS + 100 < 20_000
    assert Q.drop_duplicates(df).count() == df.distinct().count()
    plan = Q.drop_duplicates(df)._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in plan and "Join" not in plan


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_a_bitmap_misses_nothing(spark, n):
    keys = spark.range(n).select((F.xxhash64("id")).alias("k"))
    marked = bitmap.with_mark(spark.range(10_000).select("id", F.xxhash64("id").alias("k")), F.col("k"), bitmap.bitmap_of(keys, "k"), "m")
    got = {r.id: r.m for r in marked.collect()}
    assert len(got) == 10_000 and all(got[i] for i in range(n)) and sum(got.values()) <= n + 30


def test_a_digest_is_computed_once_a_row(frame):
    """The filters by the bitmap use a digest that is there, however costly the columns are."""
    df = frame(ROWS, SCHEMA).withColumn("c", F.col("c").cast("decimal(10,2)"))
    plan = Q.drop_duplicates(df)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("xxhash64" in line for line in filters)
