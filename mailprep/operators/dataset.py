"""Training rows: labels, exact splits, statistics and class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailprep import fixed as X
from mailprep.functions.dialect import hundredths
from mailprep.session import broadcast_if_small, saved

SPLITS = ("train", "validation", "test")
MAX_CLASSES = 10_000  # above this the class table is joined without a broadcast


def binary_dataset(df: DataFrame, text_col: str = X.CLEAN_BODY, label_col: str = X.COMPLAINT,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Text and complaint label, complete rows only; ``keep`` carries key columns along."""
    label = F.col(label_col).cast("int") if isinstance(df.schema[label_col].dataType, T.BooleanType) \
        else F.col(label_col)
    return df.select(*keep, text_col, label.alias("label")).dropna(subset=[text_col, "label"])


def type_dataset(df: DataFrame, text_col: str = X.CLEAN_BODY, type_col: str = X.COMPLAINT_TYPE,
                 label_col: str = X.COMPLAINT, keep: tuple[str, ...] = ()) -> DataFrame:
    """Text and complaint type of the complaints that have an applicable type."""
    return (df.filter((F.col(label_col).cast("int") == 1) & (F.col(type_col) != "Not applicable"))
            .select(*keep, text_col, type_col).dropna(subset=[text_col, type_col]))


def label_mapping(df: DataFrame, column: str) -> DataFrame:
    """Class names and their numbers from 0, in name order."""
    classes = df.filter(F.col(column).isNotNull()).select(F.col(column).alias("class")).distinct()
    return numbered(classes, "class", "label")


def numbered(rows: DataFrame, key: str, number: str) -> DataFrame:
    """``rows`` with the place of each by a unique key, from 0. The rows are sorted by ranges and written; a place is
    that in a range and what the ranges before it hold, of which there is one row per range."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, key).sortWithinPartitions(key).withColumn("__at", F.monotonically_increasing_id())
    ranged = saved(ranged, "numbered")
    part = F.shiftright("__at", 33)
    sizes = ranged.groupBy(part.alias("__part")).agg(F.min("__at").alias("__low"), F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")
    shifts = sizes.select("__part", (before - F.col("__low")).alias("__shift"))
    placed = ranged.join(F.broadcast(shifts), part == F.col("__part"))  # one row per shuffle partition
    return placed.select(*[F.col(f"`{c}`") for c in rows.columns], (F.col("__at") + F.col("__shift")).alias(number))


def encode_labels(df: DataFrame, column: str, label: str = "label", mapping: DataFrame | None = None) -> DataFrame:
    """Add the class number of ``column``, by a class table (class, label) if one is at hand."""
    classes = broadcast_if_small(label_mapping(df, column) if mapping is None else mapping, MAX_CLASSES)
    rest = [df[f"`{c}`"] for c in df.columns if c != label]
    return df.join(classes, df[f"`{column}`"] == classes["class"]).select(*rest, classes["label"].alias(label))


def split_dataset(df: DataFrame, key: str, ratios: tuple[float, float, float] = X.SPLIT_RATIOS,
                  seed: int = X.SPLIT_SEED) -> DataFrame:
    """Add ``split``: a fixed shuffle cut at exactly int(n * ratio) rows. ``key`` must be unique.

    The shuffle order is the MD5 of key and seed. Rows are counted by the first four digits of it (at most 65,536
    counts), which names the two groups that hold a cut; only those groups are ordered. Every other row is placed by
    comparing its own position with the two cuts, so texts are neither sorted nor shuffled.
    """
    if len(ratios) != 3 or abs(sum(ratios) - 1.0) >= 1e-6:
        raise ValueError("split ratios must be three numbers that sum to 1")
    text_key = F.col(key).cast("string")
    place = F.concat(F.md5(F.concat(text_key, F.lit(f":{seed}"))), F.lit(":"), text_key)
    places = df.select(place.alias("place")).withColumn("group", F.substring("place", 1, 4))
    counts = places.groupBy("group").count()
    in_order = Window.orderBy("group")
    held = (counts.withColumn("upto", F.sum("count").over(in_order))
            .withColumn("total", F.sum("count").over(Window.partitionBy()).cast("double")))
    first = (F.col("total") * ratios[0]).cast("long")
    second = first + (F.col("total") * ratios[1]).cast("long")
    cuts = (held.select("group", "upto", "count", F.explode(F.array(
                F.struct(F.lit(1).alias("no"), first.alias("rank")),
                F.struct(F.lit(2).alias("no"), second.alias("rank")))).alias("cut"))
            .filter((F.col("cut.rank") <= F.col("upto")) & (F.col("cut.rank") > F.col("upto") - F.col("count")))
            .select("group", F.col("cut.no").alias("no"),
                    (F.col("cut.rank") - (F.col("upto") - F.col("count"))).alias("rank")))
    last = (places.join(F.broadcast(cuts), "group")  # two rows at most
            .withColumn("at", F.row_number().over(Window.partitionBy("no", "group").orderBy("place")))
            .filter("at = rank")
            .agg(F.struct(F.max(F.when(F.col("no") == 1, F.col("place"))).alias("train"),
                          F.max(F.when(F.col("no") == 2, F.col("place"))).alias("validation")).alias("last")))
    bound = last.scalar()
    return df.withColumn("split", F.when(place <= bound["train"], SPLITS[0])
                         .when(place <= bound["validation"], SPLITS[1]).otherwise(SPLITS[2]))


def dataset_stats(df: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """Rows per split and label with the share of the split; labels by name when a mapping is given."""
    counts = df.groupBy("split", "label").agg(F.count("*").alias("count"))
    name = F.col("label").cast("string")
    if mapping is not None:
        counts = counts.join(broadcast_if_small(mapping, MAX_CLASSES), "label", "left")
        name = F.col("class")
    in_split = F.sum("count").over(Window.partitionBy("split"))  # one row per label
    total = F.sum("count").over(Window.partitionBy())
    return counts.select("split", "label", name.alias("label_name"), "count",
                         (hundredths(F.col("count"), in_split) / 100.0).alias("percent"),
                         in_split.alias("split_total"), total.alias("total"))


def class_weights(train: DataFrame) -> DataFrame:
    """Balanced weights: rows / (classes * rows of the class)."""
    everything = Window.partitionBy()  # one row per class
    return (train.groupBy("label").agg(F.count("*").alias("count"))
            .select("label", "count", (F.sum("count").over(everything)
                                       / (F.count("*").over(everything) * F.col("count"))).alias("weight")))
