"""Neighbouring rows in a per-key sequence: next, previous and position.

All rows are put in one order of key and sequence, in range partitions of about equal size, so a key of any size is spread over as many partitions as it
needs. A window runs over the rows that a key has in one partition. A summary with one row per key and partition carries first rows, last rows and counts across
the cuts; it has at most as many rows as there are keys and partitions together. The rows without a key are a sequence of their own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.session import cut_lineage


def with_neighbors(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    following: Mapping[str, str] | None = None,
    preceding: Mapping[str, str] | None = None,
    position: str | None = None,
) -> DataFrame:
    """Add columns of the next and previous row of the same key, and the row's place.

    `order` makes a row unique within its key; missing values come last. `following` and `preceding` map a new column to the column it copies.
    """
    following, preceding = dict(following or {}), dict(preceding or {})
    along = [F.col(c).asc_nulls_last() for c in order]
    # The partition of a row must be the same wherever it is read, so the partitioned rows are written once.
    ranged = df.repartitionByRange(F.col(key).asc_nulls_first(), *along)
    parted = cut_lineage(ranged.withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy(key, "_part").orderBy(*along)
    rows = parted.select(
        "*",
        F.lead(F.lit(1)).over(inside).isNull().alias("_last"),
        F.row_number().over(inside).cast("long").alias("_n"),
        *[F.lead(src).over(inside).alias(f"_next_{out}") for out, src in following.items()],
        *[F.lag(src).over(inside).alias(f"_prev_{out}") for out, src in preceding.items()],
    )
    heads = F.struct(F.lit(1).alias("_x"), *[F.col(src).alias(out) for out, src in following.items()])
    tails = F.struct(F.lit(1).alias("_x"), *[F.col(src).alias(out) for out, src in preceding.items()])
    # The first and the last row of a key in a partition: the window has already found them.
    ends = rows.groupBy(key, "_part").agg(
        F.max(F.when(F.col("_n") == 1, heads)).alias("_head"), F.max(F.when(F.col("_last"), tails)).alias("_tail"), F.max("_n").alias("_rows")
    )
    across = Window.partitionBy(key).orderBy("_part")
    carried = ends.select(
        F.col(key).alias("_key"),
        F.col("_part").alias("_in"),
        F.lead("_head").over(across).alias("_next_head"),
        F.lag("_tail").over(across).alias("_prev_tail"),
        (F.sum("_rows").over(across.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_rows")).alias("_before"),
    )
    joined = rows.join(carried, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_in")))
    return joined.select(
        *df.columns,
        *[F.when(F.col("_last"), F.col(f"_next_head.{out}")).otherwise(F.col(f"_next_{out}")).alias(out) for out in following],
        *[F.when(F.col("_n") == 1, F.col(f"_prev_tail.{out}")).otherwise(F.col(f"_prev_{out}")).alias(out) for out in preceding],
        *([(F.col("_n") + F.col("_before")).alias(position)] if position else []),
    )


def nth_rows(df: DataFrame, key: str, order: Sequence[str], n: int) -> DataFrame:
    """The n-th row of every key. Spark keeps only n rows per key before the shuffle, so large keys are harmless."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_n", F.row_number().over(w)).filter((F.col("_n") <= n) & (F.col("_n") == n)).drop("_n")


def top_ranked(df: DataFrame, key: str | Sequence[str], *order: Column) -> DataFrame:
    """The rows that rank first per key, ties kept, again cut per key before the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.dense_rank().over(w)).filter(F.col("_rank") == 1).drop("_rank")
