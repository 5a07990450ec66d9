"""Cleaning, profiles, audits and rule checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.functions import bitmap
from tallyloom.functions.exprs import (
    NON_PRODUCT_KEYWORDS,
    NULL_TOKENS,
    contains_any,
    has_prefix,
    keep_chars,
    null_if_token,
    parse_timestamp,
)


def normalize_nulls(df: DataFrame, columns: Sequence[str], tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Replace null-like text by NULL in several columns."""
    return df.withColumns({c: null_if_token(c, tokens) for c in columns})


def strip_units(df: DataFrame, column: str, keep: str = "0-9.", null_tokens: Sequence[str] = ("null",), cast: str | None = None) -> DataFrame:
    """Keep only the characters of a number; with `cast`, text that is still no number becomes NULL."""
    cleaned = keep_chars(column, keep, null_tokens)
    return df.withColumn(column, cleaned.try_cast(cast) if cast else cleaned)


def rejected_rows(raw: DataFrame, column: str, typed: Column) -> DataFrame:
    """Rows whose text is present but has no typed value."""
    return raw.filter(F.col(column).isNotNull() & typed.isNull())


def clean_customer_orders(raw: DataFrame) -> DataFrame:
    return normalize_nulls(raw, ["exclusions", "extras"])


def clean_runner_orders(raw: DataFrame, typed: bool = True, duration_keep: str = "0-9") -> DataFrame:
    """Text measures to clean text or, with `typed`, to timestamp and exact numbers."""
    df = normalize_nulls(raw, ["pickup_time"], ("null",))
    df = strip_units(df, "distance", "0-9.", cast="decimal(10,2)" if typed else None)
    df = strip_units(df, "duration", duration_keep, cast="decimal(10,2)" if typed else None)
    df = normalize_nulls(df, ["cancellation"])
    return df.withColumn("pickup_time", parse_timestamp("pickup_time")) if typed else df


def value_profile(df: DataFrame, *columns: str) -> DataFrame:
    """How often each value, or combination of values, occurs."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("count"))


# Values that the sketch of a column keeps, and those whose exact counts are taken. A value it does not keep occurs in at most SKETCH_ERROR / TRACKED of the rows.
TRACKED, CANDIDATES = 4096, 64
SKETCH_ERROR = 3.5


def top_values(df: DataFrame, k: int = 3, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, rank, value, count): the k most frequent values of every column as text, NULL included, ties by value.

    Two scans for all columns together: a mergeable heavy-hitter sketch per column names candidates, then the candidates are counted exactly. The result is exact where the
    k-th candidate occurs more often than any value outside the candidates can; a column where it does not, such as an id, is profiled on its own, with a shuffle
    of its values. The sketches are CANDIDATES rows a column on the driver.
    """
    columns = list(df.columns if columns is None else columns)
    shown = {c: F.col(f"`{c}`").cast("string") for c in columns}
    tops = [F.call_function("approx_top_k", shown[c], F.lit(CANDIDATES), F.lit(TRACKED)).alias(f"t{i}") for i, c in enumerate(columns)]
    sketch = df.agg(F.count(F.lit(1)).alias("n"), *tops).first()
    named = {c: [(r["item"], r["count"]) for r in sketch[f"t{i}"] or []] for i, c in enumerate(columns)}
    cells = [F.struct(F.lit(c).alias("column_name"), shown[c].alias("value"), _among(shown[c], [v for v, _ in named[c]]).alias("held")) for c in columns]
    each = df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").filter("held")
    counted = each.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))
    exact = {c: sorted((r["count"] for r in rows), reverse=True) for c, rows in _by_column(counted).items()}
    unsure = []
    for c in columns:
        every = len(named[c]) < CANDIDATES and sketch["n"] * SKETCH_ERROR / TRACKED < 1
        outside = max([named[c][-1][1] if len(named[c]) == CANDIDATES else 0, sketch["n"] * SKETCH_ERROR / TRACKED]) if named[c] else 0
        if not every and (len(exact.get(c, [])) < k or exact[c][k - 1] <= outside):
            unsure.append(c)
    sure = counted.filter(~F.col("column_name").isin(*unsure)) if unsure else counted
    for c in unsure:
        sure = sure.unionByName(df.groupBy(shown[c].alias("value")).agg(F.count(F.lit(1)).alias("count")).withColumn("column_name", F.lit(c)))
    place = F.row_number().over(Window.partitionBy("column_name").orderBy(F.desc("count"), F.col("value").asc_nulls_first()))
    return sure.withColumn("rank", place).filter(F.col("rank") <= k).select("column_name", "rank", "value", "count")


def _among(value: Column, candidates: Sequence[str | None]) -> Column:
    known = [v for v in candidates if v is not None]
    among = F.coalesce(value.isin(*known), F.lit(False)) if known else F.lit(False)
    return among | value.isNull() if None in candidates else among


def _by_column(counted: DataFrame) -> dict[str, list]:
    """Counts of the candidates, at most CANDIDATES a column, on the driver."""
    found: dict[str, list] = {}
    for r in counted.collect():
        found.setdefault(r["column_name"], []).append(r)
    return found


def _per_column(df: DataFrame, fields: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """One aggregate pass over the table, then one output row per column."""
    names = next(iter(fields.values())).keys()
    wide = df.agg(*[expr.alias(f"{c}|{name}") for c, exprs in fields.items() for name, expr in exprs.items()])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{c}|{n}`").alias(n) for n in names]) for c in fields])
    return wide.select(F.explode(rows).alias("row")).select("row.*")


def schema_profile(df: DataFrame) -> DataFrame:
    """Type and number of present values per column."""
    return _per_column(df, {f.name: {"data_type": F.lit(f.dataType.simpleString()), "non_null": F.count(f.name)} for f in df.schema})


def null_report(df: DataFrame) -> DataFrame:
    """Number of missing values per column."""
    return _per_column(df, {c: {"missing": F.count_if(F.col(c).isNull())} for c in df.columns})


def row_digest(df: DataFrame) -> Column:
    """64 bits of a whole row; rows that are equal in every column, NULL included, have equal digests."""
    missing = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in df.columns])
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], missing)


def _seen_twice(df: DataFrame) -> DataFrame:
    """All rows, marked true if their digest may occur more than once.

    Only digests are shuffled, 8 bytes for each that a task holds. Those that occur again set bits in a bitmap of fixed size, by which each task marks its rows.
    """
    counted = df.select(row_digest(df).alias("_digest")).groupBy("_digest").agg(F.count(F.lit(1)).alias("_n"))
    # Exploded, the digest is computed once a row; as a plain column each use of it in a filter would compute all columns again.
    digested = df.withColumn("_digest", F.explode(F.array(row_digest(df))))
    return bitmap.with_mark(digested, F.col("_digest"), bitmap.bitmap_of(counted.filter("_n > 1"), "_digest"), "_again").drop("_digest")


def duplicate_candidates(df: DataFrame) -> DataFrame:
    """The rows that may repeat another one: all that do, and a few by chance."""
    return _seen_twice(df).filter("_again").drop("_again")


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in every column; NULL equals NULL. Full rows are compared, and shuffled, only among candidates."""
    groups = duplicate_candidates(df).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def drop_duplicates(df: DataFrame) -> DataFrame:
    """The distinct rows. Only rows whose digest occurs again are shuffled and compared in full; the others stay where they are.

    The table is read three times for that: write a costly one first (`session.cut_lineage`), or take `distinct` for one that is small.
    """
    marked = _seen_twice(df)
    once = marked.filter(~F.col("_again")).drop("_again")
    return once.unionByName(marked.filter("_again").drop("_again").distinct())


def present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where the columns have values."""
    return df.dropna(subset=list(columns))


def _is_cancellation(invoice: str, prefix: str) -> Column:
    return F.coalesce(has_prefix(invoice, prefix), F.lit(False))


def cancellation_audit(df: DataFrame, prefix: str = "C") -> DataFrame:
    """Negative quantities, whether all of them carry the prefix, and how many do not."""
    marked = _is_cancellation("invoice", prefix)
    return df.filter(F.col("quantity") < 0).agg(
        F.count(F.lit(1)).alias("negative_rows"),
        F.coalesce(F.bool_and(marked), F.lit(True)).alias("all_prefixed"),
        F.count_if(~marked).alias("violators"),
    )


def cancellation_violators(df: DataFrame, prefix: str = "C") -> DataFrame:
    return df.filter((F.col("quantity") < 0) & ~_is_cancellation("invoice", prefix))


def valid_sales(df: DataFrame) -> DataFrame:
    """Positive quantity and price; missing values fail."""
    return df.filter((F.col("quantity") > 0) & (F.col("price") > 0))


def relabel(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    return df.replace(dict(mapping), subset=[column])


def exclude_keywords(df: DataFrame, column: str = "description", keywords: Sequence[str] = NON_PRODUCT_KEYWORDS) -> DataFrame:
    """Rows whose text holds none of the keywords; rows without text stay."""
    return df.filter(~contains_any(column, keywords))


def with_revenue(df: DataFrame) -> DataFrame:
    return df.withColumn("revenue", (F.col("quantity") * F.col("price")).cast("decimal(18,2)"))


# fixed values: country label to replace
COUNTRY_LABELS = {"EIRE": "Ireland"}


def clean_transactions(df: DataFrame) -> DataFrame:
    """Invalid rows removed, duplicates dropped, country label unified, revenue added.

    The input is read once: valid rows are made distinct in one shuffle. Where the input is a table that is cheap to read, `drop_duplicates` before it shuffles less.
    """
    return with_revenue(relabel(valid_sales(df).distinct(), "country", COUNTRY_LABELS))


def quality_report(df: DataFrame, prefix: str = "C") -> DataFrame:
    """Missing values, duplicates and the cancellation audit as one list of measures.

    Equal rows are counted once, and every measure is a sum over those counts: one pass, one shuffle.
    """
    negative = F.col("quantity") < 0
    marked = _is_cancellation("invoice", prefix)
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    measures = {f"missing {c}": F.when(F.col(c).isNull(), F.col("_n")) for c in df.columns}
    measures["duplicate rows"] = F.col("_n") - 1
    measures["negative quantity"] = F.when(negative, F.col("_n"))
    measures["negative quantity without prefix"] = F.when(negative & ~marked, F.col("_n"))
    totals = groups.agg(*[F.coalesce(F.sum(expr), F.lit(0)).alias(name) for name, expr in measures.items()])
    rows = F.array(*[F.struct(F.lit(name).alias("measure"), F.col(f"`{name}`").alias("value")) for name in measures])
    return totals.select(F.explode(rows).alias("row")).select("row.*")


@dataclass(frozen=True)
class Rule:
    """A row rule; `ok` must be true."""

    name: str
    ok: Column


def not_null(column: str) -> Rule:
    return Rule(f"{column} is missing", F.col(column).isNotNull())


def in_range(column: str, low, high) -> Rule:
    return Rule(f"{column} is out of range", F.coalesce(F.col(column).between(low, high), F.lit(True)))


def violations(df: DataFrame, key: str, rules: Sequence[Rule]) -> DataFrame:
    """Keys that break a row rule or occur more than once, with the number of rows concerned."""
    counts = {r.name: F.count_if(~r.ok) for r in rules}
    rows = F.count(F.lit(1))
    counts[f"{key} is repeated"] = F.when(rows > 1, rows).otherwise(0)
    per_key = df.groupBy(F.col(key).cast("string").alias("key")).agg(*[n.alias(rule) for rule, n in counts.items()])
    found = F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(f"`{rule}`").alias("rows")) for rule in counts])
    return per_key.select("key", F.explode(found).alias("flaw")).select("flaw.rule", "key", "flaw.rows").filter(F.col("rows") > 0)


def rating_rules() -> list[Rule]:
    return [not_null("order_id"), not_null("customer_id"), not_null("runner_id"), not_null("rating"), in_range("rating", 1, 5)]


def with_default_time(df: DataFrame, column: str, default: Column | None = None) -> DataFrame:
    """Missing times become the default, the current time unless another is given."""
    now = F.current_timestamp().cast("timestamp_ntz") if default is None else default
    return df.withColumn(column, F.coalesce(F.col(column), now))
