"""Stored tables under failing and repeated writes, totals by batches, distinct sketches, profiles of all columns."""

import os

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import calendar as C, distinct as D, quality as Q, totals as T
from tallyloom.sources import writers as W


def failing(df, after=0):
    """A frame whose write breaks when some tasks are done."""
    return df.withColumn("v", F.when(F.spark_partition_id() >= after, F.raise_error(F.lit("broken")).cast("int")).otherwise(F.col("v")))


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    W.replace_table(spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "v int, p string"), path, ["p"])
    return path


def held(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("v", "p").collect())


def test_a_table_is_replaced_from_itself(spark, table):
    W.replace_table(spark.read.parquet(table).withColumn("v", F.col("v") * 10).select("v", "p"), table, ["p"])
    assert held(spark, table) == [(10, "a"), (20, "a"), (30, "b")]
    assert os.listdir(os.path.dirname(table)) == ["t"]


@pytest.mark.parametrize("after", [0, 2])
def test_a_failed_write_leaves_the_table(spark, table, after):
    rows = spark.range(40).repartition(4).select(F.col("id").cast("int").alias("v"), F.lit("a").alias("p"))
    with pytest.raises(Exception, match="broken"):
        W.replace_table(failing(rows, after), table, ["p"])
    with pytest.raises(Exception, match="broken"):
        W.replace_partitions(failing(rows, after), table, ["p"])
    assert held(spark, table) == [(1, "a"), (2, "a"), (3, "b")]
    assert os.listdir(os.path.dirname(table)) == ["t"]


def test_a_failed_move_puts_the_old_table_back(spark, table, monkeypatch):
    move = W._Files.move
    monkeypatch.setattr(W._Files, "move", lambda self, old, new: (_ for _ in ()).throw(OSError("no")) if "__stage_" in old else move(self, old, new))
    with pytest.raises(OSError):
        W.replace_table(spark.createDataFrame([(9, "z")], "v int, p string"), table)
    assert held(spark, table) == [(1, "a"), (2, "a"), (3, "b")]


def test_only_named_partitions_change(spark, table):
    W.replace_partitions(spark.createDataFrame([(7, "b"), (8, "c")], "v int, p string"), table, ["p"])
    assert held(spark, table) == [(1, "a"), (2, "a"), (7, "b"), (8, "c")]


def test_a_batch_counts_once(spark, tmp_path):
    path, rows = str(tmp_path / "b"), spark.createDataFrame([(1,), (2,), (2,)], "v int")
    for batch in ("01", "02", "01"):
        W.append_batch(rows, path, batch)
    assert sorted(r.v for r in W.read_batches(spark, path).collect()) == [1, 1, 2, 2, 2, 2]
    with pytest.raises(Exception, match="broken"):
        W.append_batch(failing(rows.withColumn("p", F.lit(1))), path, "03")
    assert W.read_batches(spark, path).count() == 6


def test_totals_by_batches(spark, tmp_path):
    path = str(tmp_path / "totals")
    sold = spark.range(5000).select(
        F.expr("timestamp_ntz'2020-01-15 10:00:00' + make_interval(0, cast(id % 14 as int))").alias("invoice_date"), (F.col("id") * 7 % 1001 / 100).cast("decimal(18,2)").alias("revenue"), "id"
    ).filter("month(invoice_date) <> 5")
    for k in (0, 1, 2, 1):
        T.add_batch(sold.filter(F.col("id") % 3 == k), path, f"batch {k}")
    want = sorted(tuple(r) for r in C.monthly_revenue(sold).collect())
    assert sorted(tuple(r) for r in T.current_months(spark, path).collect()) == want
    assert W.read_batches(spark, path).count() <= 3 * 14  # states, not rows


def test_sketches_add_up(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 12).alias("m"), (F.col("id") % 7919).alias("who"))
    df = df.unionByName(spark.createDataFrame([(9, 1, None), (9, 2, None)], "g long, m long, who long"))
    whole = {r.g: r.n for r in D.estimate(D.union(D.sketches(df, ["g", "m"], "who"), ["g"]), "n").collect()}
    exact = {r.g: r.n for r in df.groupBy("g").agg(F.count_distinct("who").alias("n")).collect()}
    assert whole.keys() == exact.keys() and whole[9] == 0
    assert all(abs(whole[g] - n) <= D.error() * n for g, n in exact.items())
    assert spark.range(1).select(D.within(F.lit(1000), F.lit(1300)).alias("w")).first().w is False


def profile(df, column, k):
    text = F.col(column).cast("string").alias("value")
    counted = [(r.value, r["count"]) for r in df.groupBy(text).count().collect()]
    return sorted(counted, key=lambda x: (-x[1], x[0] is not None, x[0] or ""))[:k]


def test_top_values_equal_the_profiles(spark, monkeypatch):
    monkeypatch.setattr(Q, "TRACKED", 512)
    monkeypatch.setattr(Q, "CANDIDATES", 8)
    i = F.col("id")
    df = spark.range(0, 30_000, 1, 6).select(
        i.alias("own"), F.when(i % 5 == 0, None).otherwise(i % 3).alias("few"), F.when(i % 4 == 0, "hot").otherwise(i.cast("string")).alias("one hot"),
        (i % 9000).alias("flat"), F.lit(None).cast("int").alias("none"), (F.sqrt(i) / 3).cast("int").cast("decimal(10,2)").alias("steps"),
    )
    got = {}
    for r in Q.top_values(df, 3).orderBy("column_name", "rank").collect():
        got.setdefault(r.column_name, []).append((r.value, r["count"]))
    assert got == {c: profile(df, f"`{c}`", 3) for c in df.columns}
    assert Q.top_values(df.limit(0), 3).count() == 0
