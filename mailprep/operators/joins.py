"""Joining mails to their case data, and language codes to names."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailprep import fixed as X
from mailprep.session import saved, small_table

HOWS = ("inner", "left", "right", "outer")
MIN_HEAVY = 100_000   # rows of the join from which on a key is worth dealing out
MAX_ITEMS = 400_000   # that a sketch keeps
SPREAD = 16           # parts for every share of a task, so that tasks get much the same


def _family(kind: T.DataType) -> str | None:
    """Kinds of keys whose equal values have equal texts."""
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    return "whole" if isinstance(kind, whole) else kind.simpleString() if isinstance(kind, (T.StringType, T.DateType, T.BooleanType)) else None


def heavy_keys(mails: DataFrame, meta: DataFrame, left_on: str = X.MAIL_KEY, right_on: str = X.META_KEY,
               null_keys: str = "match", tasks: int | None = None, least: int | None = None) -> DataFrame | None:
    """(key, mails, cases, parts) of the keys that take more of the join than an average task: how many rows either side
    has, and over how many parts the mails are to be dealt. The key is a text, null for the group without a key.

    Sketches of frequent items, merged over the tasks, propose keys of either side; an exact count of those confirms them.
    Both read the key column alone. There are fewer of them than ``tasks``, which are the shuffle partitions if not given.
    A key under ``least`` rows of the join (``MIN_HEAVY``) is not worth it. None where the keys' types do not allow it.
    """
    if _family(mails.schema[left_on].dataType) != _family(meta.schema[right_on].dataType) or not _family(mails.schema[left_on].dataType):
        return None
    spark = mails.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = MIN_HEAVY if least is None else least
    k = min(max(2 * tasks, 16), MAX_ITEMS // 4)
    sides = [df.select(F.lit(i).alias("side"), F.col(f"`{c}`").cast("string").alias("key")) for i, (df, c) in
             enumerate(((mails, left_on), (meta, right_on)))]
    seen = {r["side"]: r for r in sides[0].union(sides[1]).groupBy("side").agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(key, {k}, {4 * k})").alias("top")).collect()}  # k keys a side
    often = [{r["item"]: r["count"] for r in seen[i]["top"]} if i in seen else {} for i in (0, 1)]
    # a key outside the sketch is no more frequent than its last one
    rest = [min(top.values()) if len(top) == k else 1 for top in often]
    names = [{"key": x} for x in {*often[0], *often[1]} if (x is not None or null_keys == "match")
             and often[0].get(x, rest[0]) * max(1, often[1].get(x, rest[1])) >= least]
    wanted = spark.createDataFrame(names, "key string")

    def counted(side: DataFrame, name: str) -> DataFrame:
        met = side.join(F.broadcast(wanted.withColumnRenamed("key", "w")), F.col("key").eqNullSafe(F.col("w")), "left_semi")
        return met.groupBy("key").agg(F.count("*").alias(name))

    if not names:
        return spark.createDataFrame([], "key string, mails long, cases long, parts long")
    total = seen[0]["n"] if 0 in seen else 0
    one, two = counted(sides[0], "mails"), counted(sides[1], "cases").withColumnRenamed("key", "other")
    both = one.join(two, F.col("key").eqNullSafe(F.col("other")), "left").select("key", "mails", F.coalesce("cases", F.lit(0)).alias("cases"))
    both = saved(both.withColumn("rows", F.col("mails") * F.greatest("cases", F.lit(1))), "frequent_keys")
    whole = total + (both.agg(F.sum(F.col("rows") - F.col("mails"))).first()[0] or 0)
    fair = F.greatest(F.lit(whole / tasks), F.lit(1.0))
    parts = F.ceil(F.col("rows") / fair)
    finer = F.least(SPREAD * parts, F.floor(F.col("mails") / F.greatest("cases", F.lit(1))))  # copies of cases cost less than mails
    return both.filter((F.col("rows") > fair) & (F.col("rows") >= least) & (F.col("mails") > 1)).select(
        "key", "mails", "cases", F.least("mails", F.greatest(parts, finer)).alias("parts"))


def _from_row(df: DataFrame) -> Column:
    """A number made from a row, the same whenever its task runs again. Of long values only the beginning counts."""
    def short(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        return F.substring(c, 1, 32) if isinstance(f.dataType, (T.StringType, T.BinaryType)) else c

    return F.xxhash64(*[short(f) for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))])


def join_metadata(mails: DataFrame, meta: DataFrame, left_on: str = X.MAIL_KEY, right_on: str = X.META_KEY,
                  how: str = "inner", null_keys: str = "match", salts: int | None = None) -> DataFrame:
    """Equi-join on differently named keys; both keys stay.

    A missing key matches a missing key (``null_keys="match"``) or nothing (``"drop"``). The join is one hash exchange
    per side, or a broadcast when the optimiser measures a small side. The mails of a case that takes more than its share
    are dealt over many tasks and its case rows are copied to each; which cases do is found beforehand (``heavy_keys``), the
    group without a key being one like any other. ``salts`` saves the search: above 1 it deals all cases over that many tasks,
    with 1 none.
    """
    if how not in HOWS:
        raise ValueError(f"how must be one of {HOWS}, not {how!r}")
    if null_keys not in ("match", "drop"):
        raise ValueError(f"null_keys must be 'match' or 'drop', not {null_keys!r}")

    def on(left: DataFrame, right: DataFrame):
        l, r = left[left_on], right[right_on]
        return l.eqNullSafe(r) if null_keys == "match" else l == r

    heavy = heavy_keys(mails, meta, left_on, right_on, null_keys) if salts is None else None
    if heavy is not None:
        heavy = saved(heavy, "heavy_keys")
    if (heavy is None or heavy.isEmpty()) if salts is None else salts <= 1:
        return mails.join(meta, on(mails, meta), how)
    salt, copy, parts = (f"__{name}_{uuid.uuid4().hex}" for name in ("salt", "copy", "parts"))  # no caller has a column of this name

    def with_parts(df: DataFrame, key: str) -> DataFrame:
        if heavy is None:
            return df.withColumn(parts, F.lit(salts).cast("long"))
        known = heavy.select(F.col("key").alias(f"{parts}_key"), F.col("parts").alias(parts))  # fewer than shuffle partitions
        met = df.join(F.broadcast(known), F.col(f"`{key}`").cast("string").eqNullSafe(F.col(f"{parts}_key")), "left")
        return met.withColumn(parts, F.coalesce(parts, F.lit(1).cast("long"))).drop(f"{parts}_key")

    # the salt comes from the row itself, so a task that runs twice deals its rows the same way
    dealt = with_parts(mails, left_on).withColumn(salt, F.pmod(_from_row(mails), F.col(parts))).drop(parts)
    copies = with_parts(meta, right_on).withColumn(copy, F.explode(F.sequence(F.lit(0).cast("long"), F.col(parts) - 1))).drop(parts)
    same = on(dealt, copies) & (dealt[salt] == copies[copy])
    joined = dealt.join(copies, same, "left" if how in ("left", "outer") else "inner").drop(salt, copy)
    if how in ("inner", "left"):
        return joined
    keys = mails.select(left_on).distinct()
    unmatched = meta.join(keys, on(keys, meta), "left_anti")
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in mails.schema]
    return joined.unionAll(unmatched.select(*blank, *[F.col(f"`{c}`") for c in meta.columns]))


def language_table(spark: SparkSession, extra: dict[str, str] | None = None) -> DataFrame:
    """(code, name) for two-letter and three-letter codes; ``extra`` adds codes outside the built-in list."""
    rows = [line.split(" ", 2) for line in X.LANGUAGES.strip().splitlines()]
    names = {three: name for _, three, name in rows} | {two: name for two, _, name in rows} | (extra or {})
    return small_table(spark, [{"code": c, "lang_name": n} for c, n in sorted(names.items())],
                       "code: string, lang_name: string")


def language_names(df: DataFrame, code_col: str = "Language", name_col: str = "LangName",
                   extra: dict[str, str] | None = None) -> DataFrame:
    """Add the English name of a language code; an unlisted or missing code is Unknown."""
    names = language_table(df.sparkSession, extra)  # a fixed list: its size does not depend on the data
    joined = df.join(F.broadcast(names), df[code_col].cast("string") == names["code"], "left")
    rest = [df[f"`{c}`"] for c in df.columns if c != name_col]
    return joined.select(*rest, F.coalesce(names["lang_name"], F.lit(X.UNKNOWN_NAME)).alias(name_col))
