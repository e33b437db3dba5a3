"""Searching, filtering, counting and paging through cleaned mails."""

from __future__ import annotations

import re

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailprep import fixed as X
from mailprep.functions import text as tx
from mailprep.operators.ranks import first_rows, row_at

_BETWEEN_CHARACTERS = r"(?![\x{dc00}-\x{dfff}])"  # Java would also try the middle of a surrogate pair
BLOCK = 256  # pieces of a cut text whose lengths are summed up together, at most
ALL = "<All>"
MISSING = "<Missing>"


def _translated(pattern: str) -> str:
    """Named groups, their references and the end of text, as the engine writes them."""
    name = lambda m: re.sub("[^A-Za-z0-9]", "u", m[1])

    def one(m: re.Match) -> str:
        token = m[0]
        if token == r"\Z":
            return r"\z"
        if token.startswith("(?P<"):
            return f"(?<{name(re.match(r'[(][?]P<(.*)>', token))}>"
        if token.startswith("(?P="):
            return rf"\k<{name(re.match(r'[(][?]P=(.*)[)]', token))}>"
        return token

    return re.sub(r"\\.|\(\?P<\w+>|\(\?P=\w+\)", one, pattern, flags=re.DOTALL)


def _checked(pattern: str) -> str:
    """The pattern in the engine's own dialect, tried out there; a broken one is an error at once."""
    whole = "(?iUd)" + _translated(pattern)
    spark = SparkSession.active()
    try:
        spark.range(1).select(F.lit("").rlike(whole)).first()
    except PySparkException as e:
        raise ValueError(f"invalid regular expression: {pattern!r}") from e
    return whole


def _search(query: str, regex: bool, literal: bool, column: str) -> Column | None:
    query = query.strip()
    if not query:
        return None
    if literal:
        return F.coalesce(F.contains(F.lower(column), F.lower(F.lit(query))), F.lit(False))
    found = (tx.body_as_text(column) if regex else F.col(column)).rlike(_checked(query))
    return F.coalesce(found, F.lit(False))


def _apply(df: DataFrame, condition: Column | None) -> DataFrame:
    return df if condition is None else df.filter(condition)


def search_regex(df: DataFrame, pattern: str, column: str = X.BODY) -> DataFrame:
    """Rows in which the pattern occurs, in any case. A blank pattern keeps all rows, a broken one is an error."""
    return _apply(df, _search(pattern, True, False, column))


def search_text(df: DataFrame, query: str, literal: bool = False, column: str = X.BODY) -> DataFrame:
    """Plain search in any case. Unless ``literal``, signs such as the dot keep their regex meaning."""
    return _apply(df, _search(query, False, literal, column))


def _max_length(n: int | str | None, column: str) -> Column | None:
    if n is None or str(n).strip() == "":
        return None
    try:
        return F.char_length(column) <= int(str(n).strip())
    except ValueError as e:
        raise ValueError("the length limit must be a whole number") from e


def max_length(df: DataFrame, n: int | str, column: str = X.CLEAN_BODY) -> DataFrame:
    return _apply(df, _max_length(n, column))


def _choice(column: str, value: str | None) -> Column | None:
    if value == ALL:
        return None
    missing = value is None or value == MISSING
    return F.col(column).isNull() if missing else F.col(column) == value


def filter_complaint_type(df: DataFrame, value: str | None, column: str = X.COMPLAINT_TYPE) -> DataFrame:
    return _apply(df, _choice(column, value))


def filter_priority(df: DataFrame, value: str | None, column: str = "Priority") -> DataFrame:
    return _apply(df, _choice(column, value))


def _language(value: str | None, code_col: str, name_col: str) -> Column | None:
    return F.col(name_col) == X.UNKNOWN_NAME if value == X.UNKNOWN_NAME else _choice(code_col, value)


def filter_language(df: DataFrame, value: str | None, code_col: str = "Language",
                    name_col: str = "LangName") -> DataFrame:
    """Rows of one language code; the choice Unknown goes by the language name."""
    return _apply(df, _language(value, code_col, name_col))


def explore(df: DataFrame, query: str = "", regex: bool = False, literal: bool = False,
            max_chars: int | str | None = None, complaint_type: str | None = ALL, language: str | None = ALL,
            priority: str | None = ALL, body: str = X.BODY, clean: str = X.CLEAN_BODY,
            type_col: str = X.COMPLAINT_TYPE, code_col: str = "Language", name_col: str = "LangName",
            priority_col: str = "Priority") -> DataFrame:
    """All filters at once. The cheap column filters come first, so that a Parquet scan can take them over."""
    conditions = [_choice(type_col, complaint_type), _language(language, code_col, name_col),
                  _choice(priority_col, priority), _max_length(max_chars, clean),
                  _search(query, regex, literal, body)]
    for condition in conditions:
        df = _apply(df, condition)
    return df


def facet_counts(df: DataFrame, type_col: str = X.COMPLAINT_TYPE, name_col: str = "LangName",
                 code_col: str = "Language", priority_col: str = "Priority") -> DataFrame:
    """Rows per complaint type, language and priority in one pass: (facet, value, code, n)."""
    by = [type_col, name_col, priority_col]
    counted = df.groupingSets([[c] for c in by], *by).agg(
        F.grouping(type_col).alias("g_type"), F.grouping(name_col).alias("g_name"),
        F.count("*").alias("n"), F.min(code_col).alias("min_code"))
    is_type, is_name = F.col("g_type") == 0, F.col("g_name") == 0
    facet = F.when(is_type, "complaint_type").when(is_name, "language").otherwise("priority")
    value = F.when(is_type, F.col(type_col)).when(is_name, F.col(name_col)).otherwise(F.col(priority_col))
    return (counted.select(facet.alias("facet"), value.alias("value"),
                           F.when(is_name, F.col("min_code")).alias("code"), "n")
            .filter("facet <> 'language' OR value IS NOT NULL")
            .orderBy("facet", F.desc("n"), "value"))


def page(df: DataFrame, key: str, n: int, after: object = None, before: object = None) -> DataFrame:
    """``n`` rows in key order: the first ones, those after a key, or those just before a key."""
    if before is not None:
        return first_rows(df.filter(F.col(key) < F.lit(before)), key, n, last=True)
    return first_rows(df if after is None else df.filter(F.col(key) > F.lit(after)), key, n)


def last_page(df: DataFrame, key: str, n: int) -> DataFrame:
    return first_rows(df, key, n, last=True)


def record_at(df: DataFrame, key: str, k: int) -> DataFrame:
    """Record ``k`` of the filtered rows (from 1) with its position and their number; outside is an error."""
    return row_at(df, key, k)


def match_spans(df: DataFrame, key: str, query: str, regex: bool = False, column: str = X.BODY) -> DataFrame:
    """Where the query occurs: (key, start, end) in characters from 0, for every hit that is not empty.

    Hits are marked in the text and the text is cut at the marks. Lengths are summed up inside the row, by blocks of as
    many pieces as the text has blocks (up to ``BLOCK``), so a hit takes few additions, nothing is shuffled and keys may repeat.
    """
    if not query.strip():
        return df.select(key, F.lit(0).alias("start"), F.lit(0).alias("end")).limit(0)
    opening, closing = "\ufdd0", "\ufdd1"  # code points that no text may contain
    pattern = _checked(query) if regex else "(?iu)" + re.escape(query)
    flags, body = pattern.split(")", 1)
    whole = rf"{flags}){_BETWEEN_CHARACTERS}(?:{body})"  # an empty hit must not fall inside a character
    text = F.replace(F.replace(F.col(column), F.lit(opening), F.lit("\ufffd")), F.lit(closing), F.lit("\ufffd"))
    marked = F.replace(F.regexp_replace(text, whole, f"{opening}$0{closing}"),
                       F.lit(opening + closing), F.lit(""))  # drop empty hits
    pieces = F.split(marked, opening)
    lengths = F.transform(pieces, lambda p: F.struct(
        (F.greatest(F.instr(p, closing), F.lit(1)) - 1).alias("hit"),
        (F.char_length(p) - F.when(F.contains(p, F.lit(closing)), 1).otherwise(0)).alias("all")))

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda s, p: s + p["all"])

    def block(i: Column) -> Column:
        return F.slice("lengths", (i * F.col("width") + 1).cast("int"), F.col("width"))

    width = F.least(F.ceil(F.sqrt(F.size("lengths"))).cast("int"), F.lit(BLOCK))
    numbers = F.sequence(F.lit(0), F.floor((F.size("lengths") - 1) / F.col("width")).cast("int"))
    cut = df.filter(F.col(column).rlike(pattern)).select(key, F.explode(F.array(lengths)).alias("lengths")).withColumn("width", width)
    cut = cut.select(key, "lengths", "width", F.explode(F.array(F.transform(numbers, lambda i: total(block(i))))).alias("sums"))
    cut = cut.select(key, F.posexplode(F.transform(F.col("sums"), lambda _, i: F.struct(
        F.aggregate(F.slice("sums", F.lit(1), i), F.lit(0), lambda s, x: s + x).alias("start"),
        block(i).alias("pieces")))).alias("no", "block"))
    cut = cut.select(key, "no", F.posexplode(F.transform(F.col("block.pieces"), lambda p, i: F.struct(
        p["hit"].alias("hit"), (F.col("block.start") + total(F.slice(F.col("block.pieces"), F.lit(1), i))).alias("start"))))
        .alias("i", "at"))
    return (cut.filter("no + i > 0 AND at.hit > 0")
            .select(key, F.col("at.start").alias("start"), (F.col("at.start") + F.col("at.hit")).alias("end")))
