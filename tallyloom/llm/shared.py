"""Session settings, stored intermediate tables and size-checked broadcasts for the text operators."""

from __future__ import annotations

import io
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import shared_folder, tune

# Rows that one Arrow batch carries to Python; texts are cut further by bytes in ragged.slices.
BATCH_ROWS = 1000
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors by way of the shared folder, once per application; their Python need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    path = f"{shared_folder(spark)}-code/{package.name}.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(context._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(packed.getvalue()))
    out.close()
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the text operators rely on."""
    tune(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def stash(df: DataFrame) -> DataFrame:
    """Write the frame once as Parquet in the shared folder and read it back, so that no later job recomputes it.

    The files stay until clear_stash: frames returned by an operator may still read them.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_stash(spark: SparkSession) -> None:
    """Delete every table that stash has written in this application."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


# Slots of the bitmap that keeps rows away from a shuffle: 1 MiB, whatever the input.
SLOTS = 1 << 23


def with_likely(rows: DataFrame, column: str, ids: DataFrame, ids_column: str, out: str) -> DataFrame:
    """The rows with a boolean: false where the id is surely not among ids, true where it is or by chance shares a slot with one.

    The ids set bits in a bitmap of SLOTS bits, of which every task gets a copy: at most 256 rows of 4 KiB.
    """
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(SLOTS))
    marked = ids.select(slot(ids_column).alias("slot")).select(F.bitmap_bucket_number("slot").alias("_page"), F.bitmap_bit_position("slot").alias("at"))
    pages = marked.groupBy("_page").agg(F.bitmap_construct_agg("at").alias("_bits"))
    at = F.bitmap_bit_position(slot(column))
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    hit = F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    held = rows.withColumn("_slot_page", F.bitmap_bucket_number(slot(column))).join(F.broadcast(pages), F.col("_slot_page") == F.col("_page"), "left")
    return held.select(*rows.columns, F.coalesce(hit, F.lit(False)).alias(out))


def likely_in(rows: DataFrame, column: str, ids: DataFrame, ids_column: str) -> DataFrame:
    """The rows whose id may be among ids: all that are, and by chance some that are not. An exact join has to follow.

    The more ids, the fewer rows it keeps back; the result of the join that follows is the same.
    """
    return with_likely(rows, column, ids, ids_column, "_likely").filter("_likely").drop("_likely")


def same(left: Column, right: Column) -> Column:
    """Equality that also joins null with null."""
    return left.eqNullSafe(right)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")


def row_key() -> Column:
    """Tells rows apart that repeat a doc_id with another text; rows alike in both get equal results anyway."""
    return F.struct(F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("text_hash"))
