from pathlib import Path

import pytest
from pyspark.sql import functions as F

from routepulse import session


def test_staged_table_is_read_back_from_the_shared_folder(spark):
    df = spark.range(10).withColumn("x", F.col("id") / 3)
    staged = session.stage(df, "numbers")
    assert staged.dtypes == df.dtypes
    assert sorted(staged.collect()) == sorted(df.collect())
    folder = spark.conf.get("spark.checkpoint.dir")
    assert all(folder in path for path in staged.inputFiles())
    assert session.stage(df.limit(0), "nothing").count() == 0


def test_a_scope_removes_what_was_staged_in_it(spark):
    kept = session.stage(spark.range(3), "kept")
    with session.staging(spark):
        gone = session.stage(spark.range(4), "gone")
        path = gone.inputFiles()[0].removeprefix("file:")
        assert Path(path).exists() and gone.count() == 4
    assert not Path(path).exists()
    assert kept.count() == 3


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Cluster:
        master, applicationId = "local-cluster[2,1,1024]", "x"

    class Session:
        class conf:
            @staticmethod
            def get(key, default):
                return default

        sparkContext = Cluster

    with pytest.raises(ValueError, match="checkpoint"):
        session.staging_dir(Session)
    Cluster.master = "local[2]"
    assert session.staging_dir(Session) == session.staging_dir(Session)


def test_only_small_tables_are_settled(spark):
    df = spark.range(50).groupBy((F.col("id") % 20).alias("g")).count()
    table, small = session.settle(df, 20)
    assert small and sorted(table.collect()) == sorted(df.collect())
    same, small = session.settle(df, 19)
    assert not small and same is df


def test_join_small_gives_the_same_rows_either_way(spark, monkeypatch):
    left = spark.range(100).withColumn("g", F.col("id") % 7)
    right = spark.range(5).select(F.col("id").alias("g"), (F.col("id") * 2).alias("v"))
    one = session.join_small(left, right, ["g"], "left")
    assert "BroadcastHashJoin" in one._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(session, "settle", lambda table: (table, False))
    two = session.join_small(left, right, ["g"], "left")
    assert sorted(one.collect(), key=str) == sorted(two.collect(), key=str)


def test_tune_sizes_the_shuffle(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        session.tune(spark, 100 * session.SHUFFLE_PARTITION_BYTES)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "100"
        session.tune(spark, 1)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "100"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
