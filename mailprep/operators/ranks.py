"""Exact positions in a global order without sorting everything, and without one large sketch.

The values are counted by cell three times, each time inside the cells that hold a wanted position: first on a
logarithmic scale, then in equal steps between the smallest and the largest value of such a cell, then by value. Counts
combine before the shuffle, and what remains to be ordered is one narrow cell per position.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailprep.session import saved

STEPS_PER_DOUBLING = 256  # cells of the first count
STEPS_PER_CELL = 1 << 16  # cells of the second count
STEP_CHARS = 2            # characters by which a start of texts grows per count
SKETCH_K = 1024           # of a sketch of ranks, whose error is about 0.3 % of the rows then
SKETCH_MARGIN = 0.015
MIN_BRACKETED = 1000      # values of a column from which on the sketch is asked
MAX_INSIDE = 5_000_000    # values between the ends that a sketch gives


def first_rows(df: DataFrame, key: str, n: int, last: bool = False) -> DataFrame:
    """The ``n`` rows with the smallest (or largest) keys, in key order, null first. Keys are unique.

    Every task offers its n best to one task, so only keys make that trip; the rows are read by their key range
    afterwards, which a Parquet scan can use to skip row groups.
    """
    order = F.desc_nulls_last(key) if last else F.asc_nulls_first(key)
    low, high, rows, filled = (df.select(key).orderBy(order).limit(n)
                               .agg(F.min(key), F.max(key), F.count("*"), F.count(key)).first())
    wanted = F.col(key).between(F.lit(low), F.lit(high))
    if rows > filled:
        wanted = F.coalesce(wanted, F.lit(False)) | F.col(key).isNull()
    return df.filter(wanted).orderBy(F.asc_nulls_first(key)).limit(n)


def row_at(df: DataFrame, key: str, k: int) -> DataFrame:
    """Row number ``k`` (from 1) in the order of a unique key, null first, with its position and the row count.

    Any key that has an order will do. Numbers and times are counted by value, texts by ever longer starts; neither
    sorts the table.
    """
    total, filled = df.agg(F.count("*"), F.count(key)).first()
    if not 1 <= k <= total:
        raise ValueError(f"record {k} is outside 1..{total}")
    rank = k - (total - filled)
    if rank < 1:
        found = df.filter(F.col(key).isNull()).limit(1)
    else:
        as_key = _comparable(df, key)
        keys = df.filter(F.col(key).isNotNull()).select(as_key.alias("value"))
        is_text = isinstance(keys.schema["value"].dataType, T.StringType)
        found = df.filter(as_key == F.lit(_text_at(keys, rank) if is_text else _number_at(keys, rank))).limit(1)
    return found.select("*", F.lit(k).cast("long").alias("position"), F.lit(total).cast("long").alias("total"))


def _comparable(df: DataFrame, key: str) -> Column:
    """The key as a number or a text of the same order."""
    kind = df.schema[key].dataType
    if isinstance(kind, (T.NumericType, T.StringType)):
        return F.col(key)
    if isinstance(kind, T.BooleanType):
        return F.col(key).cast("int")
    if isinstance(kind, T.DateType):
        return F.unix_date(key)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(key).cast("timestamp"))
    if isinstance(kind, T.BinaryType):
        return F.hex(key)
    raise TypeError(f"{key!r} has no order: {kind.simpleString()}")


def _number_at(keys: DataFrame, rank: int) -> object:
    values = keys.select(F.lit("key").alias("column"), "value")
    targets = keys.sparkSession.range(1).select(F.lit("key").alias("column"), F.lit(0).alias("target"),
                                                F.lit(rank - 1).cast("long").alias("rank"))
    return values_at(values, targets).first()["value"]


def _text_at(keys: DataFrame, rank: int) -> str:
    """The text at a rank: counted by the next ``STEP_CHARS`` characters, then again inside the start that holds it."""
    start = ""
    while True:
        inside = keys.filter(F.startswith("value", F.lit(start)))
        step = F.substring(F.col("value"), len(start) + 1, STEP_CHARS)
        counts = inside.groupBy(step.alias("next")).agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.orderBy("next"))  # one row per next two characters
        held = counts.withColumn("upto", upto).filter(F.col("upto") >= rank).orderBy("upto").first()
        rank -= held["upto"] - held["n"]
        start += held["next"]
        if len(held["next"]) < STEP_CHARS:  # the texts counted here end here, so they are all equal
            return start


def _scale(d: Column) -> Column:
    """The logarithmic cell of a number; cells keep the order of the numbers."""
    size = F.least(F.greatest(F.abs(d), F.lit(5e-324)), F.lit(1.7976931348623157e308))
    step = F.floor(F.log2(size) * STEPS_PER_DOUBLING) + 1100 * STEPS_PER_DOUBLING
    return F.when(d == 0, 0).when(d > 0, step).otherwise(-step)


def _step(d: Column, low: Column, high: Column) -> Column:
    """The equal-width cell of a number between the ends of its logarithmic cell."""
    return F.coalesce(F.floor((d - low) / F.nullif(high - low, F.lit(0.0)) * STEPS_PER_CELL), F.lit(0))


def _narrow(counts: DataFrame, targets: DataFrame, within: list[str], by: str) -> DataFrame:
    """The row of ``counts`` that holds each target, with the rank left inside it. A few targets per column."""
    before = F.sum("n").over(Window.partitionBy(*within).orderBy(by)) - F.col("n")
    return (counts.withColumn("before", before)
            .join(F.broadcast(targets.select(*within, "target", "rank")), within)
            .filter((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n")))
            .withColumn("rank", F.col("rank") - F.col("before")).drop("before", "n"))


def values_at(values: DataFrame, targets: DataFrame) -> DataFrame:
    """The values at given ranks (from 0) of a long table (column, value): rows (column, target, value).

    ``targets`` is a small table (column, target, rank).
    """
    d = F.col("value").cast("double")
    scaled = values.filter(F.col("value").isNotNull()).withColumn("d", d).withColumn("scale", _scale(d))
    by_scale = scaled.groupBy("column", "scale").agg(F.count("*").alias("n"), F.min("d").alias("low"),
                                                     F.max("d").alias("high"))
    first = saved(_narrow(by_scale, targets, ["column"], "scale"), "ranks")
    held = first.select("column", "scale", "low", "high").distinct()
    stepped = (scaled.join(F.broadcast(held), ["column", "scale"])
               .withColumn("step", _step(F.col("d"), F.col("low"), F.col("high"))))
    by_step = stepped.groupBy("column", "scale", "step").agg(F.count("*").alias("n"))
    second = saved(_narrow(by_step, first, ["column", "scale"], "step"), "ranks")
    held = second.select("column", "scale", "step").distinct()
    by_value = (stepped.join(F.broadcast(held), ["column", "scale", "step"])
                .groupBy("column", "scale", "step", "value").agg(F.count("*").alias("n")))
    return _narrow(by_value, second, ["column", "scale", "step"], "value").select("column", "target", "value")


def sketch(value: Column | str) -> Column:
    """A mergeable sketch of ranks, for ``bracketed``."""
    return F.kll_sketch_agg_double(value, F.lit(SKETCH_K))


def bracketed(values: DataFrame, stats: DataFrame, shares: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Exact quantiles as by ``quantiles``, from one more read of ``values`` (column, value: double).

    ``stats`` has (column, rows, sketch): the sketch tells between which two values a quantile lies. Values between
    them are counted by value, the rest by the gap they lie in, so a rank is exact whatever the sketch's error. A column
    for which it is larger than allowed for, or whose brackets would hold too much, is counted by cells instead.
    """
    n = F.col("rows")

    def end(share: float, all_: float) -> Column:
        told = F.kll_sketch_get_quantile_double("sketch", F.lit(min(max(share, 0.0), 1.0)))
        return F.when(n < MIN_BRACKETED, F.lit(all_)).otherwise(told)

    fits = (n > 0) & (n * (2 * SKETCH_MARGIN * len(shares)) <= MAX_INSIDE)
    sides = [(f"low{i}", f"high{i}", s) for i, s in enumerate(shares)]
    ends = stats.filter(fits).select("column", *[c for low, high, s in sides for c in (
        end(s - SKETCH_MARGIN, -math.inf).alias(low), end(s + SKETCH_MARGIN, math.inf).alias(high))])
    ends = saved(ends, "brackets")  # one row per column
    v = F.col("value")
    inside = reduce(or_, [v.between(F.col(low), F.col(high)) for low, high, _ in sides])
    gap = reduce(add, [F.when(F.col(low) <= v, 1).otherwise(0) for low, _, _ in sides])
    cells = (values.filter(v.isNotNull()).join(F.broadcast(ends), "column")
             .groupBy("column", F.when(inside, v).alias("exact"), F.when(~inside, gap).alias("gap"))
             .agg(F.count("*").alias("n"), F.min("value").alias("at")))
    at = [(n - 1) * F.lit(s) for s in shares]
    targets = stats.filter(fits).select("column", F.explode(F.array(*[
        F.struct(F.lit(i).alias("share"), F.least(F.floor(a) + up, n - 1).alias("rank"), F.lit(up).alias("up"), (a - F.floor(a)).alias("part"))
        for i, a in enumerate(at) for up in (0, 1)])).alias("t")).select("column", "t.*")
    upto = F.sum("n").over(Window.partitionBy("column").orderBy("at"))  # up to MAX_INSIDE rows
    placed = cells.withColumn("upto", upto).join(F.broadcast(targets), "column").filter(
        (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
    low, high = (F.max(F.when(F.col("up") == up, F.col("exact"))) for up in (0, 1))
    found = placed.groupBy("column", "share").agg(low.alias("low"), high.alias("high"), F.max("part").alias("part"))
    found = saved(found, "quartiles")
    names = F.array(*[F.lit(s) for s in shares])
    done = found.filter("low is not null and high is not null").select(
        "column", F.get(names, F.col("share")).alias("share"), (F.col("low") + F.col("part") * (F.col("high") - F.col("low"))).alias("quantile"))
    missing = stats.filter("rows > 0").join(found.filter("low is null or high is null").select("column").union(
        stats.filter((n > 0) & ~fits).select("column")).distinct(), "column", "left_semi").select("column", "rows")
    missing = saved(missing, "quartiles_missing")
    if missing.isEmpty():
        return done
    again = quantiles(values.join(F.broadcast(missing.select("column")), "column"), missing, shares)
    return done.join(F.broadcast(missing), "column", "left_anti").unionByName(again)


def quantiles(values: DataFrame, rows: DataFrame, shares: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Exact linear quantiles of a long table (column, value), given its counts (column, rows) without nulls.

    Returns rows (column, share, quantile).
    """
    at = [(F.col("rows") - 1) * F.lit(s) for s in shares]
    targets = (rows.filter("rows > 0").select("column", F.explode(F.array(*[
        F.struct(F.lit(2 * i + up).alias("target"),
                 F.least(F.floor(a) + up, F.col("rows") - 1).alias("rank")) for i, a in enumerate(at) for up in (0, 1)
    ])).alias("t")).select("column", "t.target", "t.rank"))
    found = values_at(values, targets).groupBy("column").pivot("target", list(range(2 * len(shares)))).agg(F.max("value"))

    def between(i: int) -> Column:
        low, high = F.col(str(2 * i)), F.col(str(2 * i + 1))
        return low + (at[i] - F.floor(at[i])) * (high - low)

    return found.join(F.broadcast(rows), "column").select("column", F.explode(F.array(*[
        F.struct(F.lit(s).alias("share"), between(i).alias("quantile")) for i, s in enumerate(shares)])).alias("q")
    ).select("column", "q.share", "q.quantile")
