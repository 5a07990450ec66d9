"""Exact quantile edges, tiers and order statistics."""

from __future__ import annotations

import math
import operator
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from tallyloom.functions.exprs import col
from tallyloom.session import cut_lineage

# fixed values: tier labels from lowest to highest
TIER_LABELS = ("Very Low", "Low", "Medium", "High", "Very High")


def inner_probabilities(bins: int) -> list[float]:
    return [k / bins for k in range(1, bins)]


def bin_number(value: Column, edges: Sequence[Column]) -> Column:
    """1 plus the number of edges below the value: right-closed bins, the smallest one that fits; NULL stays NULL."""
    above = [F.when(value > e, 1).otherwise(0) for e in edges]
    return F.when(value.isNotNull(), sum(above, F.lit(1)))


def label_of(number: Column, labels: Sequence[str]) -> Column:
    return F.try_element_at(F.array(*[F.lit(x) for x in labels]), number)


# Ranks of the sketch are off by at most one row in ACCURACY; a place is looked for within MARGIN of its share, and brackets with more than COLLECTED rows are narrowed first.
ACCURACY = 10_000
MARGIN = 2 / ACCURACY
COLLECTED = 100_000
# Types that Spark's mergeable quantile sketch takes.
SKETCHED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


@dataclass
class Bracket:
    """Where a place lies: among the `rows` rows above `low` and under `high` (None: open), behind `before` rows."""

    place: int
    before: int
    rows: int
    low: object = None
    high: object = None

    def holds(self, value: Column) -> Column:
        inside = value.isNotNull()
        inside = inside if self.low is None else inside & (value > F.lit(self.low))
        return inside if self.high is None else inside & (value < F.lit(self.high))

    def share(self) -> float:
        return (self.place - self.before) / max(1, self.rows - 1)


def _around(shares: Sequence[float]) -> list[float]:
    return [min(1.0, max(0.0, x + side * MARGIN)) for x in shares for side in (-1, 1)]


def _counted(df: DataFrame, keys: Sequence[Column]) -> list[Row]:
    """Groups with their sizes, on the driver; the caller bounds their number."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).collect()


def _narrowed(df: DataFrame, value: Column, b: Bracket, low, high) -> Bracket | tuple:
    """The bracket cut at two of its values, or the value at the place with the rows before it and the rows equal to it."""
    inside = b.holds(value)
    tests = (inside & (value < F.lit(low)), inside & (value == F.lit(low)), inside & (value > F.lit(low)) & (value < F.lit(high)), inside & (value == F.lit(high)))
    under, at_low, between, at_high = df.agg(*[F.count_if(t).alias(f"n{k}") for k, t in enumerate(tests)]).first()
    at_high = 0 if low == high else at_high
    start = b.before
    if b.place < start + under:
        return Bracket(b.place, start, under, b.low, low)
    start += under
    if b.place < start + at_low:
        return low, start, at_low
    start += at_low
    if b.place < start + between:
        return Bracket(b.place, start, between, low, high)
    start += between
    if b.place < start + at_high:
        return high, start, at_high
    return Bracket(b.place, start + at_high, b.before + b.rows - start - at_high, high, b.high)


def values_at(df: DataFrame, value: str, places: Callable[[int], Sequence[int]], shares: Sequence[float]) -> tuple[int, dict[int, tuple]]:
    """Number of values, and for each place in their order (from 0) the value there, the rows before it and the rows equal to it. NULL is no value.

    A mergeable sketch brackets each place, a second pass counts what lies under and between the brackets and brings only the values inside them to the driver: two
    scans of one column, without sorting or writing it, and no task holds more than a sketch and its share of the brackets. Where a bracket would hold more than COLLECTED rows, it is
    narrowed by further sketches of its own rows first. Brackets only save work: a place that its bracket misses is found by narrowing. `places` gives the places by
    the number of values; `shares` says where about they lie, from 0 to 1.
    """
    v = F.col(value)
    known = df.select(v).filter(v.isNotNull())
    sketch = known.agg(F.count(v).alias("n"), F.percentile_approx(v, _around(shares), ACCURACY).alias("edges")).first()
    total, edges = sketch["n"], sketch["edges"]
    wanted = sorted(set(places(total))) if total else []
    found: dict[int, tuple] = {}
    if not wanted:
        return total, found
    if 2 * MARGIN * total * len(shares) <= COLLECTED:
        cuts = sorted(set(edges))
        region = sum((F.when(v >= F.lit(e), 1).otherwise(0) for e in cuts), F.lit(0))
        inside = [(v >= F.lit(a)) & (v <= F.lit(b)) for a, b in zip(edges[::2], edges[1::2])]
        kept = F.when(reduce(operator.or_, inside), v)
        start = 0
        # A region begins with the cut that opens it; what of it lies in no bracket comes behind.
        for r in sorted(_counted(known, [region.alias("region"), kept.alias("kept")]), key=lambda r: (r["region"], r["kept"] is None, r["kept"])):
            if r["kept"] is not None:
                found |= {p: (r["kept"], start, r["n"]) for p in wanted if start <= p < start + r["n"]}
            start += r["n"]
    for p in wanted:
        b = found.get(p) or Bracket(p, 0, total)
        while isinstance(b, Bracket) and b.rows > COLLECTED:
            low, high = known.agg(F.percentile_approx(F.when(b.holds(v), v), _around([b.share()]), ACCURACY)).first()[0]
            b = _narrowed(known, v, b, low, high)
        if isinstance(b, Bracket):
            start = b.before
            for r in sorted(_counted(known.filter(b.holds(v)), [v.alias("kept")]), key=lambda r: r["kept"]):
                if start <= p < start + r["n"]:
                    b = r["kept"], start, r["n"]
                    break
                start += r["n"]
        # Several places often share a value.
        found |= {q: b for q in wanted if b[1] <= q < b[1] + b[2]}
    return total, found


def quantiles(df: DataFrame, value: str, probabilities: Sequence[float]) -> list[float | None]:
    """Exact quantiles of a column with any number of distinct values, interpolated between neighbours."""
    spots = lambda n: [(n - 1) * p for p in probabilities]
    total, found = values_at(df, value, lambda n: [i for x in spots(n) for i in (math.floor(x), math.ceil(x))], probabilities)
    if not total:
        return [None] * len(probabilities)
    edges = []
    for x in spots(total):
        low, high = float(found[math.floor(x)][0]), float(found[math.ceil(x)][0])
        edges.append(low + (high - low) * (x - math.floor(x)))
    return edges


def quantile_tiers(df: DataFrame, value: str, labels: Sequence[str], out: str, lowest: tuple[Column, str] | None = None) -> DataFrame:
    """Label rows by quantile bins of a value, with exact edges interpolated between neighbours, whatever the number of rows.

    The table is read three times, so it is written first. `lowest` is a rule and a label for rows that are set apart before the edges are computed.
    """
    apart, apart_label = lowest or (F.lit(False), "")
    held = cut_lineage(df)
    edges = quantiles(held.select(F.when(~apart, F.col(value).cast("double")).alias("_rest")), "_rest", inner_probabilities(len(labels)))
    number = bin_number(F.col(value).cast("double"), [F.lit(e).cast("double") for e in edges])
    return held.withColumn(out, F.when(apart, apart_label).otherwise(label_of(number, labels)))


class SortedRows:
    """A table in global order, for exact positions at any size.

    The rows are range-partitioned and sorted once and written to the shared folder. Every partition knows
    how many rows come before it, so the n-th row is found without a single-task window. Only one count per
    partition and the asked-for rows reach the driver.
    """

    def __init__(self, df: DataFrame, *order: str):
        self.order = order
        ranged = df.select(*order).repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
        id_bits = F.monotonically_increasing_id()
        self.rows = cut_lineage(ranged.withColumn("_part", F.spark_partition_id()).withColumn("_at", id_bits.bitwiseAND(F.lit((1 << 33) - 1))))
        counts = {r["_part"]: r["n"] for r in self.rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
        self.starts: dict[int, int] = {}
        total = 0
        for part in sorted(counts):
            self.starts[part] = total
            total += counts[part]
        self.total = total

    def at(self, positions: Sequence[int]) -> dict[int, Row]:
        """The rows at given places, counted from 0."""
        wanted = F.lit(False)
        for p in set(positions):
            part = max((k for k, start in self.starts.items() if start <= p))
            wanted = wanted | ((F.col("_part") == part) & (F.col("_at") == p - self.starts[part]))
        found = self.rows.filter(wanted).collect() if self.total else []
        return {self.starts[r["_part"]] + r["_at"]: r for r in found}

    def with_ordinal(self, out: str = "ordinal") -> DataFrame:
        """All rows with their place, counted from 1."""
        starts = self.rows.sparkSession.createDataFrame(list(self.starts.items()), "_in int, _start long")
        placed = self.rows.join(starts, F.col("_part") == F.col("_in"))
        return placed.withColumn(out, F.col("_start") + F.col("_at") + 1).select(*self.order, out)


def rank_cuts(df: DataFrame, value: str, tie: str, bins: int) -> list[tuple]:
    """The (value, tie) pair that closes each rank bin but the last, when rows are ranked by value and then by the tie column.

    First the value at each place is selected, then the tie among the rows that share it. Rows without a value have no rank; rows without a tie come first among equals.
    """
    shares = inner_probabilities(bins)
    # Ranks run from 1; a quantile edge of the ranks closes its bin.
    places = lambda n: [math.floor((n - 1) * p) for p in shares]
    if not all(isinstance(df.schema[c].dataType, SKETCHED) for c in (value, tie)):
        rows = SortedRows(df, value, tie)
        found = rows.at(places(rows.total)) if rows.total else {}
        return [(found[p][value], found[p][tie]) for p in places(rows.total)] if rows.total else []
    total, found = values_at(df, value, places, shares)
    if not total:
        return []
    ties: dict[int, object] = {}
    groups = {v: (before, n) for v, before, n in found.values()}
    if sum(n for _, n in groups.values()) <= COLLECTED:
        held = _counted(df.filter(F.col(value).isin(*groups)), [F.col(value).alias("v"), F.col(tie).alias("t")])
        for v, (before, _) in groups.items():
            start = before
            for r in sorted((r for r in held if r["v"] == v), key=lambda r: (r["t"] is not None, r["t"])):
                ties |= {p: r["t"] for p in found if start <= p < start + r["n"]}
                start += r["n"]
    else:
        for v, (before, n) in groups.items():
            mine = sorted(p for p in found if before <= p < before + n)
            # Rows without a tie come first.
            first = lambda known, before=before, n=n: before + n - known
            known, at = values_at(df.filter(F.col(value) == F.lit(v)), tie, lambda m, mine=mine, first=first: [p - first(m) for p in mine if p >= first(m)], [(p - before) / max(1, n - 1) for p in mine])
            ties |= {p: at[p - first(known)][0] if p >= first(known) else None for p in mine}
    return [(found[p][0], ties[p]) for p in places(total)]


def bin_by_cuts(value: str | Column, tie: str | Column, cuts: Sequence[tuple]) -> Column:
    """Bin number of a (value, tie) pair among closing pairs."""
    v, t = col(value), col(tie)
    above = [F.when((v > a) | ((v == a) & (t > b)), 1).otherwise(0) for a, b in cuts]
    return sum(above, F.lit(1))


def equal_width_bucket(value: str | Column, low: float, high: float, buckets: int) -> Column:
    """Number of an equal-width bucket; 0 below the range and one above the last at or beyond its end."""
    return F.width_bucket(col(value), F.lit(low), F.lit(high), F.lit(buckets)).cast("int")
