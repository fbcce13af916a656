"""Session settings, and where intermediate tables live."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Largest table that may be pulled together on the driver program and broadcast.
SMALL_ROWS = 10_000

# AQE splits a skewed join partition even when a grouping on the same key follows.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def tune(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Apply the adaptive settings the operators count on; never static ones.

    ``shuffle_bytes`` is the size of the largest table that will be shuffled: there
    are then enough shuffle partitions for each to fit into memory. Adaptive execution
    merges those that turn out small.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    if shuffle_bytes:
        current = int(spark.conf.get("spark.sql.shuffle.partitions"))
        needed = -(-shuffle_bytes // SHUFFLE_PARTITION_BYTES)
        spark.conf.set("spark.sql.shuffle.partitions", str(max(current, needed)))
    return spark


def staging_dir(spark: SparkSession) -> str:
    """The shared folder that spark.checkpoint.dir names.

    Where it is unset and everything runs in one process, a folder of this session is
    made once; the session's settings stay as they are.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _own_dir(spark.sparkContext.applicationId)


@cache
def _own_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"{application}-")


class Staged:
    """Remembers the tables staged while it is active and removes them at the end.

    ``with staging(spark): ...`` around work whose results were written or collected
    inside; results that still read staged tables can't be used after it.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Staged:
        _active.append(self)
        return self

    def __exit__(self, *_) -> None:
        _active.remove(self)
        jvm, conf = self.spark._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in self.paths:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


_active: list[Staged] = []
staging = Staged


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table once and read it back.

    It cuts the lineage, survives lost executors, is read column-pruned by its
    consumers and gives the planner its true size.
    """
    spark = df.sparkSession
    application = f"routepulse-{spark.sparkContext.applicationId}"
    path = f"{staging_dir(spark).rstrip('/')}/{application}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for scope in _active:
        scope.paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_observed(df: DataFrame, name: str, metrics: dict[str, Column]) -> tuple[DataFrame, dict]:
    """Stage a table and return it with aggregates over its rows, taken while it is written."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    table = stage(df.observe(seen, *(c.alias(k) for k, c in metrics.items())), name)
    return table, seen.get


def settle(df: DataFrame, max_rows: int = SMALL_ROWS) -> tuple[DataFrame, bool]:
    """Evaluate a presumably small aggregate now.

    Returns (table, True) when it has at most ``max_rows`` rows: the table is then a
    local relation of known size that may be broadcast. Otherwise the untouched
    input and False: the caller must use a shuffle join.
    """
    found = df.limit(max_rows + 1).toArrow()
    if found.num_rows > max_rows:
        return df, False
    return df.sparkSession.createDataFrame(found, schema=df.schema), True


def join_small(
    df: DataFrame, small: DataFrame, on: list[str], how: str = "inner"
) -> DataFrame:
    """Broadcast ``small`` if it proves small, else let the shuffle join do it."""
    table, is_small = settle(small)
    return df.join(F.broadcast(table) if is_small else table, on, how)
