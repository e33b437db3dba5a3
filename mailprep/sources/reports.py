"""Results for people: predictions, statistics, metrics, value lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from mailprep.operators.model import errors
from mailprep.session import small_table
from mailprep.sources.delimited import write_delimited


def write_predictions(pred: DataFrame, folder: str) -> None:
    """All scored rows, and the wrong ones, as two delimited tables."""
    kept = pred.persist(StorageLevel.DISK_ONLY)  # score once; lost blocks are scored again
    try:
        write_delimited(kept, f"{folder}/test_predictions")
        write_delimited(errors(kept), f"{folder}/incorrect_predictions")
    finally:
        kept.unpersist()


def write_stats(stats: DataFrame, folder: str) -> None:
    """dataset_stats as JSON."""
    label = F.struct("label_name", F.struct("count", "percent").alias("share"))
    # a few labels per split, three splits
    split = (stats.groupBy("split").agg(F.max("total").alias("total"), F.max("split_total").alias("rows"),
                                        F.map_from_entries(F.collect_list(label)).alias("labels")))
    rows = lambda name: F.coalesce(F.max(F.when(F.col("split") == name, F.col("rows"))), F.lit(0)).alias(name)
    one = split.agg(F.max("total").alias("total"), rows("train"), rows("validation"), rows("test"),
                    F.map_from_entries(F.collect_list(F.struct("split", "labels"))).alias("splits"))
    one.write.json(f"{folder}/dataset_stats")


def write_metrics(metrics: DataFrame, folder: str) -> None:
    metrics.write.json(f"{folder}/final_metrics")


def write_history(spark: SparkSession, history: list[tuple[int, float]], folder: str) -> None:
    """Iterations and validation score of every training round."""
    rows = [{"iterations": n, "score": value} for n, value in history]
    small_table(spark, rows, "iterations: int, score: double").write.json(f"{folder}/training_history")


def export_distinct(df: DataFrame, column: str, path: str) -> None:
    """The distinct values of a column as a one-column delimited table."""
    write_delimited(df.select(column).dropna().distinct(), path)
