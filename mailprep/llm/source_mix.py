"""Mixing sources to target weights along a curriculum, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailprep.session import saved

WEIGHTS = (3, 1, 2)
SLOPES = (0.5, 0.0, -0.5)   # how a source's weight changes from start to end, by the same place as its weight
SHARE_PERCENT = 150
MOST_PERCENT = 200          # no source gives more than this share of its own size
CELL_DIGITS = 3             # leading digits of the shuffled order that make a part; each is added up on its own


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, weight, slope, target) from (source, source_size): weights in code-point order, null last.

    Shares of the demand go by weight up to the cap; what is cut off is shared again by weight. The level at which
    that ends is found in one pass over the sources, ordered by the level at which each meets its cap. Sums are whole
    numbers, so a rerun gives the same targets. One row per source, however many documents it has.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(WEIGHTS)
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), place + 1)
    s = sizes.select("source", "source_size", pick(WEIGHTS).cast("long").alias("weight"), pick(SLOPES).alias("slope"))
    most = F.col("source_size") * MOST_PERCENT
    # met: the level at which the source is full; ties in any order give the same level
    s = s.withColumn("met", most / F.col("weight"))
    by_level = Window.orderBy("met", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("full", F.coalesce(F.sum(most).over(before), F.lit(0)))
    s = s.withColumn("open", F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("all", F.sum(F.col("source_size") * SHARE_PERCENT).over(Window.partitionBy()))
    level = (F.col("all") - F.col("full")) / F.col("open")
    s = s.withColumn("level", F.min(F.when(level <= F.col("met"), F.struct("met", level.alias("level"))))
                     .over(Window.partitionBy())["level"])
    target = F.least(most.cast("double"), F.col("weight") * F.coalesce("level", F.lit(0.0))) / 100
    return s.select("source", "source_size", "weight", "slope", target.alias("target"))


def _when(demand: Column, slope: Column) -> Column:
    """The time t in 0..1 at which the share ``demand`` of a source has been asked for.

    The weight of a source runs linearly from ``1 + slope`` to ``1 - slope``; its integral is t + slope * (t - t^2).
    """
    b = slope + 1
    root = F.sqrt(F.greatest(b * b - slope * demand * 4, F.lit(0.0)))
    return F.when(slope == 0, demand).otherwise(demand * 2 / (b + root))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Every row of ``docs`` with (size, source_size, target, taken, position, positions), sorted by first position.

    Inside a source, documents follow each other in the order of the MD5 of key and text. The source gives them in
    that order until its target is met, from the start again if the target exceeds its size; the last one taken is
    taken in part. ``positions`` holds the time of each copy along the curriculum, ``position`` the first one, which is
    null for documents that the mix does not reach. Sizes are added up per cell of the order, then over cells, so a
    source that holds most rows is spread over many tasks.
    Null text or source: size 0, a source of its own that comes last. Repeated rows each count. An empty table gives
    an empty result. Reruns agree.
    """
    extra = ("_mark", "_source", "_at", "slope")
    placed = _taken(_placed(_marked(docs, key, text, source)))
    return placed.orderBy(F.col("position").asc_nulls_last(), "_mark").drop(*extra)


def _marked(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    mark = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.md5(F.coalesce(F.col(text).cast("binary"), F.lit("").cast("binary")))))
    return docs.select("*", words(F.col(text)).alias("size"), mark.alias("_mark"), F.col(source).alias("_source"))


def _placed(rows: DataFrame) -> DataFrame:
    """``rows`` with (_at, source_size, slope, target), _at being the words of the source that come before the row."""
    rows = rows.withColumn("_cell", F.substring("_mark", 1, CELL_DIGITS))
    cells = saved(rows.groupBy("_source", "_cell").agg(F.sum("size").alias("n")), "mix_cells")
    plan = targets(cells.groupBy(F.col("_source").alias("source")).agg(F.sum("n").alias("source_size")))
    starts = cells.select("_source", "_cell", (F.sum("n").over(Window.partitionBy("_source").orderBy("_cell")) - F.col("n"))
                          .alias("_start"))
    plan = starts.join(plan, starts["_source"].eqNullSafe(plan["source"])).drop("source")
    plan = plan.select(F.col("_source").alias("_s"), F.col("_cell").alias("_c"), "_start", "source_size", "slope", "target")
    inside = Window.partitionBy("_source", "_cell").orderBy("_mark").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(plan, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_cell") == F.col("_c")))
    return rows.withColumn("_at", F.col("_start") + F.col("_inside")).drop("_cell", "_s", "_c", "_start", "_inside")


def _taken(rows: DataFrame) -> DataFrame:
    """Placed rows with (taken, positions, position)."""
    at = F.col("_at").cast("double")
    again = at + F.col("source_size")

    def part(start: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("size"), F.floor(F.col("target") - start)))

    rows = rows.withColumn("taken", (part(at) + part(again)).cast("long"))
    times = F.array(*[_when(F.try_divide(s, F.col("target")), F.col("slope")) for s in (at, again)])
    copies = F.when(part(again) > 0, 2).when(part(at) > 0, 1).otherwise(0)
    return rows.withColumn("positions", F.slice(times, 1, copies)).withColumn("position", F.get("positions", F.lit(0)))


def _placed_whole(rows: DataFrame) -> DataFrame:
    """``_placed`` for rows that carry texts, which travel once: places are found without them. Rows of one source with the
    same key and text follow each other, so the place of the first tells those of all."""
    rows = rows.withColumn("_id", F.concat("_mark", F.coalesce(F.concat(F.lit(":"), F.col("_source").cast("string")), F.lit(""))))
    first = _placed(rows.select("_id", "_mark", "_source", "size")).groupBy(F.col("_id").alias("_f")).agg(
        F.min("_at").alias("_first"), *[F.first(c).alias(c) for c in ("source_size", "slope", "target")])
    nth = F.row_number().over(Window.partitionBy("_id").orderBy("_mark")) - 1
    rows = rows.withColumn("_at", nth * F.col("size")).join(first, F.col("_id") == F.col("_f"))
    return rows.withColumn("_at", F.col("_at") + F.col("_first")).drop("_id", "_f", "_first")


def sequence(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: one row of the columns of ``docs`` per copy taken, in training order.

    A copy that is taken in part (one per source) is cut after the last word that still counts. Documents without
    words take no room and stay in, once, at the end.
    """
    columns = docs.columns
    mixed = _taken(_placed_whole(_marked(docs, key, text, source))).drop("_at")
    copies = mixed.withColumn("_left", F.col("taken")).select(
        "*", F.posexplode(F.when(F.col("size") == 0, F.array(F.lit(None).cast("double"))).otherwise(F.col("positions")))
        .alias("_copy", "_at"))
    share = F.least(F.col("size"), F.col("taken") - F.col("_copy") * F.col("size"))
    pieces = F.regexp_extract_all(F.col(text), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    cut = F.array_join(F.slice(pieces, F.lit(1), F.greatest(F.col("_share"), F.lit(0)).cast("int")), "")
    copies = copies.withColumn("_share", share)
    copies = copies.withColumn(text, F.when(F.col("_share") < F.col("size"), cut).otherwise(F.col(text)))
    return copies.orderBy(F.col("_at").asc_nulls_last(), F.col(key), "_copy").select(*columns)
