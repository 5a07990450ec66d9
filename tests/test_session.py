from types import SimpleNamespace

import pytest

from tallyloom.session import FIRST_PARTITIONS, INITIAL_PARTITIONS, LARGEST_READ, tune, use_shared_checkpoints


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(master, named=None, folder=None):
    return SimpleNamespace(sparkContext=Context(master, folder), conf=SimpleNamespace(get=lambda name, default: named or default))


def test_the_named_folder_is_used():
    spark = session("spark://host", named="hdfs:///shared")
    use_shared_checkpoints(spark)
    assert spark.sparkContext.folder == "hdfs:///shared"


def test_a_folder_that_is_already_set_stays():
    spark = session("spark://host", folder="hdfs:///other")
    use_shared_checkpoints(spark)
    assert spark.sparkContext.folder == "hdfs:///other"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        use_shared_checkpoints(session("spark://host"))


def test_a_fresh_local_folder_in_local_mode(tmp_path, monkeypatch):
    monkeypatch.setenv("TMPDIR", str(tmp_path))
    spark = session("local[2]")
    use_shared_checkpoints(spark)
    assert spark.sparkContext.folder.startswith(str(tmp_path))


def test_tasks_read_little_whatever_the_session_says(spark):
    """Large reads are made smaller, small ones stay; the same with few and many partitions. A session of its own keeps the others' settings."""
    other = spark.newSession()
    for name in LARGEST_READ:
        other.conf.set(name, "256m")
    tune(other)
    assert {name: other.conf.get(name) for name in LARGEST_READ} == LARGEST_READ
    assert other.conf.get(INITIAL_PARTITIONS) == str(FIRST_PARTITIONS)
    for name in LARGEST_READ:
        other.conf.set(name, "50KB")
    other.conf.set("spark.sql.shuffle.partitions", "5000")
    tune(other)
    assert {other.conf.get(name) for name in LARGEST_READ} == {"50KB"} and other.conf.get(INITIAL_PARTITIONS) == "5000"


def test_a_large_shuffle_is_read_in_many_tasks(spark):
    """20 MB of a shuffle whose session has one partition only."""
    other = spark.newSession()
    other.conf.set("spark.sql.shuffle.partitions", "1")
    tune(other)
    rows = other.range(0, 2_000_000, 1, 2).selectExpr("id % 1000003 AS k", "xxhash64(id) AS v")
    tasks = rows.groupBy("k").agg({"v": "sum", "*": "count"}).selectExpr("spark_partition_id() AS task").distinct().count()
    assert tasks > 1
