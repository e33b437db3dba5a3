"""What the operators need from the session: shared storage, size-checked broadcasts, spread scans."""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
TASKS_PER_CORE = 4
ROW_GROUP_BYTES = 32 << 20  # a writer holds one in memory
_local_dirs: dict[str, str] = {}
_passing: ContextVar[list[str] | None] = ContextVar("_passing", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it. Only a local session may make its own."""
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):  # local-cluster has executors of its own
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _local_dirs[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: computed once, whatever is lost later. A ``lasting``
    table also stays at the end of ``scratch``."""
    path, passing = new_path(df.sparkSession, name), _passing.get()
    if passing is not None and not lasting:
        passing.append(path)
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are saved inside go at the end. What is read later has to be saved as lasting."""
    paths: list[str] = []
    token = _passing.set(paths)
    try:
        yield
    finally:
        _passing.reset(token)
        for path in map(spark._jvm.org.apache.hadoop.fs.Path, paths):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` when it is counted to hold at most ``max_rows`` rows; leave the join to AQE otherwise.

    Meant for aggregated tables, whose count costs as much as the join will spend on them anyway.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread a scan with fewer splits than cores by a key of many values; leave any larger scan as it is.

    Give it a plain scan: one file with a single row group is one task, and text work is CPU-bound.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    # a few tasks per core, because long texts make uneven tasks
    return df.repartition(TASKS_PER_CORE * cores, key) if df.rdd.getNumPartitions() < cores else df


def small_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A few fixed rows as a table, made inside the JVM."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))
