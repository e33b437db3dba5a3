"""Table profiles.

Counting distinct values of mail bodies by value would shuffle the bodies themselves. All counts here work on long
tables (column, short stand-in of the value), so that a row costs a few dozen bytes however long its texts are; the
few values a report shows are fetched by stand-in afterwards. Columns of one type share a long table, which keeps
numbers and times from being turned into text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailprep import fixed as X
from mailprep.operators.ranks import bracketed
from mailprep.operators.ranks import sketch as rank_sketch
from mailprep.session import saved, small_table

QUARTILES = (0.25, 0.5, 0.75)
SKETCH_ACCURACY = 10_000
START = 32  # characters of a text that are compared before the text itself is fetched


def _columns_of(df: DataFrame, kind: type[T.DataType]) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, kind)]


def _values(df: DataFrame, columns: list[str], as_type: str = "string") -> DataFrame:
    """The long table (column, value)."""
    typed = df.select([F.col(f"`{c}`").cast(as_type).alias(c) for c in columns])
    return typed.unpivot([], list(columns), "column", "value")


def _stand_in(value: str) -> Column:
    """A short text for a text: itself up to 32 characters, else its MD5 behind a sign that makes it longer."""
    return F.when(F.char_length(value) <= 32, F.col(value)).otherwise(F.concat(F.lit("#"), F.md5(value)))


def _families(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """The columns by type; types without an order count as text."""
    families: dict[str, list[str]] = {}
    for c in columns:
        kind = df.schema[c].dataType
        ordered = isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType))
        families.setdefault(kind.simpleString() if ordered else "string", []).append(c)
    return families


def _summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: filled and null cells, distinct values, the start of the most frequent value and its count;
    among values of that count, the smallest.

    The result is tiny and used more than once, so it is written out.
    """
    parts = []
    for kind, members in _families(df, columns).items():
        key, start = (_stand_in("value"), F.left("value", F.lit(START))) if kind == "string" else (F.col("value"), F.col("value"))
        counts = _values(df, members, kind).groupBy("column", key.alias("key"), start.alias("start")).count()
        n, filled = F.col("count"), F.col("key").isNotNull()
        first = F.min(F.when(filled, F.struct((-n).alias("n"), F.col("start").alias("key"))))
        parts.append(counts.groupBy("column").agg(
            F.sum(F.when(filled, n).otherwise(0)).alias("count"), F.sum(F.when(filled, 0).otherwise(n)).alias("nulls"),
            F.count("key").alias("distinct"), first["key"].cast("string").alias("top_key"), (-first["n"]).alias("freq")))
    return saved(reduce(DataFrame.unionByName, parts), "summary")


def _shown(df: DataFrame, summary: DataFrame, max_distinct: int = 0) -> DataFrame:
    """Add ``top``, the smallest of the most frequent values, and ``values``, the sorted values of columns with fewer
    than ``max_distinct``. One pass over the columns concerned; the broadcast side has one row per column. Of long
    values, only those that begin as the top one does are looked at."""
    long_top = F.char_length("top_key") >= START
    small = F.col("distinct") < max_distinct
    columns = [r["column"] for r in summary.filter(long_top | small).select("column").collect()]
    if not columns:
        return summary.withColumn("top", F.col("top_key")).withColumn("values", F.lit(None).cast("array<string>"))
    wanted = summary.select(F.col("column").alias("c"), "top_key", "freq", small.alias("small"))
    begins = F.startswith("value", F.col("top_key"))
    picked = (_values(df, columns).join(F.broadcast(wanted), F.col("column") == F.col("c"))
              .filter(F.col("value").isNotNull() & (F.col("small") | begins))
              .groupBy("column", "small", "top_key", "freq", _stand_in("value").alias("key"))
              .agg(F.count("*").alias("n"), F.first("value").alias("value")))
    found = picked.groupBy("column").agg(
        F.min(F.when(begins & (F.col("n") == F.col("freq")), F.col("value"))).alias("found"),
        F.sort_array(F.collect_list(F.when(F.col("small"), F.col("value")))).alias("listed"))
    return (summary.join(F.broadcast(found), "column", "left")
            .withColumn("top", F.when(long_top, F.col("found")).otherwise(F.col("top_key")))
            .withColumn("values", F.when(small, F.coalesce("listed", F.array().cast("array<string>"))))
            .drop("found", "listed"))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)).cast("long"))


def column_types(df: DataFrame) -> DataFrame:
    return small_table(df.sparkSession, [{"column": c, "type": t} for c, t in df.dtypes],
                       "column: string, type: string")


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, for columns that have any."""
    row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return row.unpivot([], df.columns, "column", "nulls").filter("nulls > 0")


def _exact(c: Column, kind: T.DataType) -> Column:
    """A value as text, different for different values: nulls are a sign of their own, the rest is in hexadecimal."""
    if isinstance(kind, T.ArrayType):
        value = F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: _exact(x, kind.elementType)), ","), F.lit("]"))
    elif isinstance(kind, T.StructType):
        fields = [_exact(c[f.name], f.dataType) for f in kind]
        value = F.when(c.isNotNull(), F.concat(F.lit("("), F.concat_ws(",", *fields), F.lit(")")))
    elif isinstance(kind, T.MapType):
        pairs = F.array_sort(F.map_entries(c))
        return _exact(pairs, T.ArrayType(T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])))
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        value = F.unix_micros(c.cast("timestamp")).cast("string")
    elif isinstance(kind, (T.BinaryType, T.StringType)):
        value = F.concat(F.lit("x"), F.hex(c))
    else:
        zero = isinstance(kind, (T.FloatType, T.DoubleType))  # zero has two signs and one value
        value = F.when(c == 0, "0.0").otherwise(c.cast("string")) if zero else c.cast("string")
    return F.coalesce(value, F.lit("null"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier identical row; nulls are equal to each other."""
    digest = F.md5(F.concat_ws(",", *[_exact(F.col(f"`{f.name}`"), f.dataType) for f in df.schema]))
    groups = df.groupBy(digest.alias("row")).count()
    return groups.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicate_rows"))


def describe_numeric(df: DataFrame, approx: bool = False) -> DataFrame:
    """count, mean, std, min, quartiles and max of every numeric column. Quartiles are exact unless ``approx``."""
    values = _values(df, _columns_of(df, T.NumericType), "double")
    values = values.withColumn("value", F.nanvl("value", F.lit(None).cast("double")))
    plain = [F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
             F.min("value").alias("min"), F.max("value").alias("max")]
    if approx:
        sketch = F.percentile_approx("value", list(QUARTILES), SKETCH_ACCURACY)
        stats = values.groupBy("column").agg(*plain, *[sketch[i].alias(f"p{int(s * 100)}")
                                                       for i, s in enumerate(QUARTILES)])
    else:
        # one row per numeric column on either side; the values are read once for these and once for the quartiles
        stats = saved(values.groupBy("column").agg(*plain, rank_sketch("value").alias("sketch")), "stats")
        cuts = bracketed(values, stats.select("column", F.col("count").alias("rows"), "sketch"), QUARTILES).groupBy("column").agg(
            *[F.max(F.when(F.col("share") == s, F.col("quantile"))).alias(f"p{int(s * 100)}") for s in QUARTILES])
        stats = stats.join(F.broadcast(cuts), "column", "left")
    return stats.select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def describe_categorical(df: DataFrame) -> DataFrame:
    """count, unique, top and freq of every text column; on a tie the top is the smallest value."""
    shown = _shown(df, _summary(df, _columns_of(df, T.StringType)))
    return shown.select("column", "count", F.col("distinct").alias("unique"), "top", "freq")


def distinct_counts(df: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct non-null values per column."""
    if approx:
        row = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`")).alias(c) for c in df.columns])
        return row.unpivot([], df.columns, "column", "distinct")
    return _summary(df, df.columns).select("column", "distinct")


def small_domains(df: DataFrame, max_distinct: int = X.SMALL_DOMAIN) -> DataFrame:
    """The sorted values of the columns with fewer than ``max_distinct`` of them."""
    shown = _shown(df, _summary(df, df.columns), max_distinct)
    return shown.filter(F.col("distinct") < max_distinct).select("column", "distinct", "values")


def value_counts(df: DataFrame, column: str, dropna: bool = False) -> DataFrame:
    """Rows per value, most frequent first; nulls count as a value unless ``dropna``."""
    rows = df.filter(F.col(column).isNotNull()) if dropna else df
    return rows.groupBy(column).count().orderBy(F.desc("count"), column)


def profile(df: DataFrame, max_distinct: int = X.SMALL_DOMAIN) -> DataFrame:
    """All of the above in one table, one row per column of ``df``. The input is written once and profiled from there."""
    df = saved(df, "profiled")
    report = _shown(df, _summary(df, df.columns), max_distinct).drop("top_key")
    report = report.join(F.broadcast(column_types(df)), "column")
    if _columns_of(df, T.NumericType):
        report = report.join(F.broadcast(describe_numeric(df).drop("count")), "column", "left")
    whole = duplicate_rows(df).scalar()
    return report.withColumn("rows", F.col("count") + F.col("nulls")).withColumn("duplicate_rows", whole)
