"""Shared helpers: input tables, whole-row keys, connected components."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailprep.session import saved

FEW_EDGES = 100_000  # up to so many are one partition, which needs no exchange
CHARS_PER_STEP = 1 << 18  # text that one vectorised step takes at once; longer single texts are taken alone


def reachable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it. On a cluster it is installed there, or sent
    along with ``--py-files``; a local session finds it whatever folder it runs in."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Python workers take up to so many rows at once inside; a smaller number that is set already stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, unset = spark.conf.get(name), name not in spark.conf.getAll
    if not 0 < int(before) <= rows:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(name) if unset else spark.conf.set(name, before)


def give_back() -> None:
    """Return what this process has freed to the system. Workers outlive their tasks, and what the allocators keep of long
    texts and keys would count beside the next task's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of Linux has it
    if trim is not None:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def steps(texts: list, limit: int = CHARS_PER_STEP) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts (or byte strings) that hold up to ``limit`` characters together, or one text."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t)
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def nothing(spark: SparkSession, schema: str) -> DataFrame:
    """An empty table made inside the JVM. One made of a Python list takes Python workers of a kind of its own, which stay."""
    return spark.range(0).select(F.from_json(F.lit("{}"), schema).alias("row")).select("row.*")


def filled(column: pd.Series) -> list[str]:
    """The texts of a column, null as the empty text."""
    return ["" if t is None or t != t else t for t in column.tolist()]


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of undirected ``edges`` (a, b) as rows (node, component), component being the smallest node.

    Large-star and small-star steps in turn: each sends the neighbours of a node to their smallest one, so stars grow in
    few rounds and no node's neighbours are ever gathered. Minima combine before the shuffle; a node with very many
    edges is a skewed join that adaptive execution splits. Every round is a table in the shared folder. Up to
    ``FEW_EDGES`` edges take rounds of one task. Loops and repeated edges are allowed; nodes without an edge to another
    node do not appear.
    """
    edges = saved(edges.filter("a is not null and b is not null and a != b")
                  .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first())

    now, before = state(edges), None
    while now != before and now[0]:  # no edge, no round
        edges = edges.coalesce(1) if now[0] <= FEW_EDGES else edges
        both = edges.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a and b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(smallest, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
                 .filter("a != b").distinct())
        edges = saved(small, name)
        before, now = now, state(edges)
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(edges.select("b", "b")).distinct())
