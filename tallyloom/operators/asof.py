"""As-of matching: of many anchors per key, the last one up to a row, or the first one from it on.

Rows and anchors are put in one order of key and time and cut into range partitions of about equal size, so a key of any size is spread over as many tasks as it
needs. A window carries the last anchor along inside a partition, and a summary with one row per key and partition carries it across the cuts. No row meets more than one
anchor, so nothing is multiplied, however many anchors a key has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.session import cut_lineage

DIRECTIONS = ("before", "after")


def _carried(one: Column, many: DataFrame, key: str, out: str, along: list[Column]) -> DataFrame:
    """`many` with the last value that is not NULL up to each row, by key in the order `along`; `_part` is the partition of a row."""
    inside = Window.partitionBy(key, "_part").orderBy(*along).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = many.withColumn("_here", F.last(one, ignorenulls=True).over(inside))
    ends = many.groupBy(key, "_part").agg(F.max_by(F.struct(one.alias("v")), F.when(one.isNotNull(), F.col("_at"))).alias("_tail"))
    across = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = ends.select(F.col(key).alias("_key"), F.col("_part").alias("_in"), F.last("_tail", ignorenulls=True).over(across).alias("_carried"))
    joined = rows.join(before, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_in")))
    return joined.withColumn(out, F.coalesce("_here", F.col("_carried.v")))


def as_of(
    rows: DataFrame,
    anchors: DataFrame,
    key: str,
    at: str,
    anchor: str,
    direction: str = "before",
    inclusive: bool = True,
    out: str = "as_of",
) -> DataFrame:
    """All rows with `out`: the last anchor of their key before `at` (or the first after it), NULL if there is none.

    `inclusive` lets an anchor at the same time count. Every row comes out once. A key or time that is missing has no anchor.
    """
    if direction not in DIRECTIONS:
        raise ValueError(direction)
    back = direction == "after"
    known = anchors.filter(F.col(key).isNotNull() & F.col(anchor).isNotNull()).select(F.col(key), F.col(anchor).alias("_at_time")).distinct()
    # At one time, anchors stand before the rows that may use them, or behind those that may not.
    rank = 0 if inclusive else 2
    void = [F.lit(None).cast(f.dataType).alias(f"_row_{f.name}") for f in rows.schema]
    left = rows.select(F.col(key), F.col(at).alias("_at_time"), F.lit(1).alias("_kind"), *[F.col(c).alias(f"_row_{c}") for c in rows.columns])
    right = known.select(F.col(key), "_at_time", F.lit(rank).alias("_kind"), *void)
    time = F.col("_at_time").desc_nulls_first() if back else F.col("_at_time").asc_nulls_first()
    along = [time, F.col("_kind").asc()]
    both = left.unionByName(right)
    # A row's partition and place are columns, so that they are the same wherever the rows are read. A spread of equal times over partitions is cut by place.
    ranged = both.repartitionByRange(F.col(key).asc_nulls_first(), *along, F.xxhash64(*[f"_row_{c}" for c in rows.columns])).sortWithinPartitions(F.col(key).asc_nulls_first(), *along)
    dealt = cut_lineage(ranged.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()))
    value = F.when(F.col("_kind") != 1, F.col("_at_time"))
    found = _carried(value, dealt, key, out, [F.col("_at")])
    usable = F.col(f"_row_{key}").isNotNull() & F.col(f"_row_{at}").isNotNull()
    return found.filter("_kind = 1").select(*[F.col(f"_row_{c}").alias(c) for c in rows.columns], F.when(usable, F.col(out)).alias(out))


def nearest_events(sales: DataFrame, anchors: DataFrame, direction: str = "after", inclusive: bool | None = None, key: str = "customer_id", day: str = "order_date", anchor: str = "join_date") -> DataFrame:
    """For every anchor of a key, of which there may be many, the rows of the first day after it, or of the last day before it; ties kept.

    The day is found as of each anchor on distinct days, then the rows of that day are joined. Anchors without such a day give nothing.
    """
    inclusive = direction == "after" if inclusive is None else inclusive
    points = anchors.filter(F.col(key).isNotNull() & F.col(anchor).isNotNull()).select(key, anchor).distinct()
    days = sales.filter(F.col(key).isNotNull() & F.col(day).isNotNull()).select(key, day).distinct()
    matched = as_of(points, days, key, anchor, day, direction, inclusive, out="_day").filter("_day is not null")
    return sales.join(matched.withColumnRenamed("_day", day), [key, day])
