"""The cleaned table on disk, in any order or in the order of a key."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mailprep.session import saved

FILE = "_metadata.file_name"
ORDER = "_order"            # the folder of the directory; readers of the table pass over it
FILE_ROWS = 1_000_000       # rows of one file of an ordered snapshot


def write_snapshot(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_ordered(df: DataFrame, path: str, key: str, file_rows: int = FILE_ROWS) -> None:
    """The snapshot with its rows in the order of a unique key, null first: files hold ranges of keys, one after the
    other. Beside it a directory is kept, with the number of rows of every file. One shuffle moves the rows."""
    order = F.asc_nulls_first(key)
    ranges = df.repartitionByRange(order).sortWithinPartitions(order)
    ranges.write.option("maxRecordsPerFile", file_rows).parquet(path)
    file_places(read_snapshot(df.sparkSession, path)).write.parquet(f"{path}/{ORDER}")


def read_order(spark: SparkSession, path: str) -> DataFrame | None:
    """The directory of an ordered snapshot; None if the snapshot has no order."""
    try:
        return spark.read.parquet(f"{path}/{ORDER}")
    except AnalysisException:
        return None


def file_places(rows: DataFrame) -> DataFrame:
    """How many rows each file of an ordered snapshot gives, and how many come before: (file, rows, before).

    ``rows`` is the snapshot as read, or with filters. Counts combine before the shuffle; the running sum takes one row
    per file.
    """
    number = lambda pattern: F.regexp_extract("file", pattern, 1).cast("long")
    order = [number(r"part-(\d+)"), number(r"-c(\d+)\.")]  # files are numbered in the order of their ranges
    counts = rows.groupBy(F.col(FILE).alias("file")).agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return counts.withColumn("before", F.coalesce(before, F.lit(0)))


def record_of(rows: DataFrame, key: str, k: int, places: DataFrame | None = None) -> DataFrame:
    """Row number ``k`` (from 1) of an ordered snapshot as read, or with filters, with its position and the row count;
    outside is an error. Only the file that holds it is read, once ``places`` (``file_places`` of the same rows) is at
    hand; without it the rows of all files are counted first."""
    places = saved(file_places(rows), "places") if places is None else places
    total = places.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    if not 1 <= k <= total:
        raise ValueError(f"record {k} is outside 1..{total}")
    held = places.filter((F.col("before") < k) & (F.col("before") + F.col("rows") >= k)).first()
    inside = rows.filter(F.col(FILE) == held["file"]).orderBy(F.asc_nulls_first(key)).offset(k - 1 - held["before"]).limit(1)
    return inside.select("*", F.lit(k).cast("long").alias("position"), F.lit(total).cast("long").alias("total"))
