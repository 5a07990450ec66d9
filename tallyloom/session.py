"""Session settings and the shared folder for checkpoints."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Runtime settings that may be changed on a session somebody else made.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even when the split costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# What a task reads at most, where rows can be dealt out. Sizes are those of compressed rows, which take ten times the memory and more.
LARGEST_READ = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "32m",
}
# Partitions a shuffle begins with; adaptive execution joins small ones, but does not cut large ones.
INITIAL_PARTITIONS, FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", 600


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallyloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for name, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on. Sizes are only lowered and partitions only added: a session may be finer by itself."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for name, value in LARGEST_READ.items():
        if size(spark.conf.get(name)) > size(value):
            spark.conf.set(name, value)
    own = [spark.conf.get(name, None) for name in (INITIAL_PARTITIONS, "spark.sql.shuffle.partitions")]
    spark.conf.set(INITIAL_PARTITIONS, str(max([FIRST_PARTITIONS, *(int(n) for n in own if n)])))
    return spark


def use_shared_checkpoints(spark: SparkSession) -> None:
    """Point checkpoints at the folder the cluster names, or at a fresh local one in local mode."""
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return
    if context.getCheckpointDir() is not None:
        return
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyloom-", dir=os.environ.get("TMPDIR", "/tmp")))


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application that the driver and all executors see, below the one for checkpoints."""
    use_shared_checkpoints(spark)
    named = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    return f"{named.rstrip('/')}/tallyloom-{spark.sparkContext.applicationId}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the frame once as Parquet in the shared folder and read it back: later passes read columns of files, and only those they need, instead of recomputing rows.

    Rows are not read in the order or the partitions they were written in; what depends on either has to be a column. The files stay until `drop_written`.
    """
    path = f"{shared_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession) -> None:
    """Delete all that `cut_lineage` has written in this application; frames made from it can no longer be read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/cut-*")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in files.globStatus(path) or ():
        files.delete(found.getPath(), True)
