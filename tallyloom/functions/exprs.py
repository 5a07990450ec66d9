"""Column expressions shared by the operators. All of them stay on the JVM side."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F

# fixed values: text that stands for a missing value
NULL_TOKENS = ("", "null", "NaN")

# fixed values: keyword fragments of lines that are not products
NON_PRODUCT_KEYWORDS = ("Manual", "POSTAGE", "DOTCOM")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_token(c: str | Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    c = col(c)
    return F.when(~c.isin(*tokens), c)


def keep_chars(c: str | Column, keep: str, null_tokens: Sequence[str] = ("null",)) -> Column:
    """Drop every character outside the class `keep`; tokens become NULL."""
    return F.regexp_replace(null_if_token(c, null_tokens), f"[^{keep}]", "")


def contains_any(c: str | Column, keywords: Iterable[str]) -> Column:
    """Case-insensitive substring test against a keyword list; NULL text counts as no match."""
    pattern = "(?i)" + "|".join(re.escape(k) for k in keywords)
    return F.coalesce(col(c).rlike(pattern), F.lit(False))


def has_prefix(c: str | Column, prefix: str) -> Column:
    return F.startswith(col(c).cast("string"), F.lit(prefix))


def differs_or_null(c: str | Column, value) -> Column:
    """Not equal, where a missing value counts as different."""
    return ~col(c).eqNullSafe(F.lit(value))


def concat_skip_null(*parts: str | Column) -> Column:
    return F.concat_ws("", *[col(p).cast("string") for p in parts])


def weekday_label(ts: str | Column) -> Column:
    """Upper-case English weekday, blank-padded to nine characters."""
    return F.rpad(F.upper(F.date_format(col(ts), "EEEE")), 9, " ")


def seconds_between(start: str | Column, end: str | Column) -> Column:
    return F.timestamp_diff("SECOND", col(start), col(end))


def minutes_between(start: str | Column, end: str | Column, digits: int = 2) -> Column:
    return rounded_ratio(seconds_between(start, end), F.lit(60), digits)


def whole_days(start: str | Column, end: str | Column) -> Column:
    """Full 24-hour days between two timestamps, rounded down."""
    return F.floor(seconds_between(start, end) / F.lit(86400)).cast("int")


def week_number(day: str | Column, first_day: str) -> Column:
    """1 for the seven days from `first_day`, 2 for the next seven, ..."""
    return (F.floor(F.datediff(col(day), F.lit(first_day).cast("date")) / F.lit(7)) + 1).cast("int")


def month_start(day: str | Column) -> Column:
    return F.trunc(col(day), "month")


def month_gap(earlier: str | Column, later: str | Column) -> Column:
    a, b = col(earlier), col(later)
    return (F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))


def parse_timestamp(c: str | Column, fmt: str | None = None) -> Column:
    """Text to a zone-less timestamp; text that does not parse gives NULL."""
    parsed = F.try_to_timestamp(col(c), F.lit(fmt)) if fmt else F.try_to_timestamp(col(c))
    return parsed.cast("timestamp_ntz")


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Quotient to ten decimals, for numerators below 1e26; a zero denominator gives NULL."""
    return F.try_divide(col(numerator).cast("decimal(30,4)"), col(denominator).cast("decimal(20,2)"))


def rounded_ratio(numerator: str | Column, denominator: str | Column, digits: int) -> Column:
    """The exact quotient rounded half away from zero, for values below 1e26; a zero denominator gives NULL.

    Rounding is a whole division of scaled values, so no intermediate quotient is cut off.
    """
    n, d = (col(x).cast("decimal(30,4)") for x in (numerator, denominator))
    whole = F.abs(n) * F.lit(2 * 10**digits).cast("decimal(6,0)") + F.abs(d)
    twice = F.nullif(F.abs(d) * 2, F.lit(0))
    steps = ((whole - whole % twice) / twice).cast("decimal(30,0)")
    return steps * F.lit(10.0**-digits).cast(f"decimal({digits + 1},{digits})") * F.sign(n).cast("decimal(1,0)") * F.sign(d).cast("decimal(1,0)")


def percent(part: Column, whole: Column, digits: int) -> Column:
    """Share of a whole in percent; an empty whole gives NULL."""
    return rounded_ratio(part * 100, whole, digits)


def money(c: str | Column) -> Column:
    """An exact amount as a double with two decimals, for reports."""
    return F.round(col(c).cast("double"), 2)


def flag(c: Column) -> Column:
    """A predicate as 'Y' or 'N'; unknown counts as 'N'."""
    return F.when(c, F.lit("Y")).otherwise(F.lit("N"))
