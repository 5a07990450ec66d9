"""Typed readers, inline rows and result output."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyloom.functions.exprs import null_if_token
from tallyloom.sources.writers import replace_table

# The transaction file's columns, in file order; dates stay text until parsed.
RETAIL_CSV_SCHEMA = T.StructType(
    [
        T.StructField("invoice", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("invoice_date", T.StringType()),
        T.StructField("price", T.DecimalType(10, 2)),
        T.StructField("customer_id", T.DecimalType(20, 1)),
        T.StructField("country", T.StringType()),
    ]
)

# fixed values: header names of the transaction file, with the name and type of each column here
RETAIL_FILE = {
    "Invoice": ("invoice", "string"),
    "Description": ("description", "string"),
    "Quantity": ("quantity", "int"),
    "InvoiceDate": ("invoice_date", "string"),
    "Price": ("price", "decimal(10,2)"),
    "Customer ID": ("customer_id", "bigint"),
    "Country": ("country", "string"),
}

RATINGS_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.IntegerType(), False),
        T.StructField("customer_id", T.IntegerType(), False),
        T.StructField("runner_id", T.IntegerType(), False),
        T.StructField("rating", T.IntegerType(), False),
        T.StructField("rating_time", T.TimestampNTZType()),
    ]
)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Scan one Parquet table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


@dataclass(frozen=True)
class CsvRows:
    """A delimited file as typed rows, and the records that are none: `reason` tells why, `record` holds the text."""

    accepted: DataFrame
    rejected: DataFrame


RECORD = "_record"
SHORT = "number of fields"


def _typed(kind: str, text: Column) -> Column:
    """Whole numbers are read as decimals first, so ids written with a decimal point keep all their digits."""
    return text.try_cast("decimal(38,2)").try_cast(kind) if kind in ("int", "bigint") else text.try_cast(kind)


def _header(spark: SparkSession, path: str, options: Mapping[str, str | bool]) -> list[str]:
    """The file's own names; only its head is read."""
    return spark.read.options(**options).csv(path, header=True).columns


def scan_csv(spark: SparkSession, path: str, columns: Mapping[str, tuple[str, str]], delimiter: str = ",", null_tokens: Sequence[str] = (), multi_line: bool = True) -> CsvRows:
    """Scan delimited text with a header row; what does not fit is set apart instead of being lost.

    `columns` maps the file's own names to a column name and a type; they are found by name, in any order, and other columns are left out. A name that the file lacks is an error.
    Types are declared, so there is no inference pass over the data. A record is rejected if its number of fields is not the header's, or if a
    field has text that is no value of its type; empty fields and `null_tokens` are NULL. Accepted and rejected rows together are the records of the file.

    Quoted fields may hold line breaks. A file is then read as a whole by one task, since a line break alone does not tell where a record ends: data in many files is read in
    parallel. For one large file known to have a record on every line, `multi_line=False` reads it in parts.
    """
    options = {"sep": delimiter, "escape": '"', "multiLine": multi_line}
    names = _header(spark, path, options)
    missing = [name for name in columns if name not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    # All fields are parsed, wanted or not: only then does the reader know how many a record has.
    fields = [T.StructField(name, T.StringType()) for name in names]
    raw = spark.read.schema(T.StructType([*fields, T.StructField(RECORD, T.StringType())])).options(**options, columnNameOfCorruptRecord=RECORD, columnPruning=False).csv(path, header=True)
    text = {name: null_if_token(f"`{name}`", null_tokens) if null_tokens else F.col(f"`{name}`") for name in columns}
    bad = F.array_compact(F.array(*[F.when(text[name].isNotNull() & _typed(kind, text[name]).isNull(), F.lit(name)) for name, (_, kind) in columns.items()]))
    reason = F.when(F.col(RECORD).isNotNull(), SHORT).when(F.size(bad) > 0, F.array_join(bad, ", "))
    judged = raw.withColumn("_reason", reason)
    accepted = judged.filter(F.col("_reason").isNull()).select(*[_typed(kind, text[name]).alias(out) for name, (out, kind) in columns.items()])
    # A well-formed record with a bad value is written out again, as a file would hold it.
    written = F.to_csv(F.struct(*[F.col(f"`{name}`") for name in names]), {"sep": delimiter, "escape": '"'})
    rejected = judged.filter(F.col("_reason").isNotNull()).select(F.col("_reason").alias("reason"), F.coalesce(RECORD, written).alias("record"))
    return CsvRows(accepted, rejected)


def read_csv(spark: SparkSession, path: str, columns: Mapping[str, tuple[str, str]], delimiter: str = ",", multi_line: bool = True) -> DataFrame:
    """All records of a delimited file with a header row; text that is no value of its type gives NULL, and so do missing fields. `scan_csv` sets such records apart."""
    options = {"sep": delimiter, "escape": '"', "multiLine": multi_line}
    raw = spark.read.options(**options).csv(path, header=True)
    return raw.select(*[_typed(kind, F.col(f"`{name}`")).alias(out) for name, (out, kind) in columns.items()])


def parse_csv_lines(df: DataFrame, line: str, schema: T.StructType, delimiter: str = ",") -> DataFrame:
    """Parse a column of delimited text lines into typed columns."""
    declared = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    parsed = F.from_csv(F.col(line), declared, {"sep": delimiter})
    return df.select(parsed.alias("row")).select("row.*")


def inline(spark: SparkSession, rows: Sequence[Sequence], schema: str | T.StructType) -> DataFrame:
    """A few literal rows. They are part of the plan, so Spark knows their size and joins them without a shuffle."""
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    literals = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields, strict=True)]) for row in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*literals)))


def append_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    """The table with further rows, matched by column name; missing columns are NULL."""
    return df.unionByName(rows, allowMissingColumns=True)


def preview(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first n rows in a stated order."""
    return df.orderBy(*order).limit(n)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Persist a result as Parquet, in place of an earlier one."""
    replace_table(df, path, partition_by)
