"""Bitmaps of fixed size that tell which rows may be in a set, whatever the set's size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Bits of a bitmap, and of a page of it: 256 pages of 4 KiB, so 1 MiB reaches a task at most.
SLOTS, PAGE = 1 << 23, 1 << 15


def _slot(key: Column) -> Column:
    return F.pmod(key, F.lit(SLOTS))


def bitmap_of(keys: DataFrame, key: str) -> Column:
    """The slots of all keys as a scalar: an array of pages, NULL where a page is empty. A task sends a page once, so neither shuffle nor result grows with the keys beyond the bitmap."""
    slot = _slot(F.col(key)) + 1  # Spark's bitmaps begin with 1
    pages = keys.groupBy(F.bitmap_bucket_number(slot).alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    held = pages.agg(F.map_from_entries(F.collect_list(F.struct("page", "bits"))).alias("held"))
    return held.select(F.transform(F.sequence(F.lit(1).cast("long"), F.lit(SLOTS // PAGE).cast("long")), lambda p: F.try_element_at("held", p))).scalar()


def with_mark(df: DataFrame, key: Column, bitmap: Column, out: str) -> DataFrame:
    """The rows with a boolean: false where the key is surely none of the bitmap's, true where it is one or shares its slot. No join and no shuffle."""
    at = (_slot(key) % PAGE).cast("int")
    page = F.get(bitmap, F.floor(_slot(key) / PAGE).cast("int"))
    byte = F.conv(F.hex(F.substring(page, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, at % 8).bitwiseAND(F.lit(1))
    return df.withColumn(out, F.coalesce(bit == 1, F.lit(False)))
