"""Projections and predicates on the shape of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailprep import fixed as X
from mailprep.functions import text as tx
from mailprep.functions.dialect import strip
from mailprep.operators.ranks import first_rows, row_at
from mailprep.session import small_table


def normalize_nulls(df: DataFrame, tokens: Sequence[str] = X.EMPTY_TOKENS) -> DataFrame:
    """Whole cells that equal one of ``tokens`` become null, in every text column."""
    def cell(f: T.StructField):
        c = F.col(f"`{f.name}`")
        return F.when(~c.isin(*tokens), c).alias(f.name) if isinstance(f.dataType, T.StringType) else c

    return df.select([cell(f) for f in df.schema])


def filled_columns(df: DataFrame, columns: list[str]) -> set[str]:
    """Those of ``columns`` that hold a value."""
    if not columns:
        return set()
    # positional names: columns whose names differ in case only must stay apart
    seen = df.select([F.max(F.col(f"`{c}`").isNotNull()).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    return {c for c, any_value in zip(columns, seen) if any_value}


def all_null(df: DataFrame, probe_rows: int = 1000) -> list[str]:
    """Columns without any value. A few rows already clear most columns, so that the pass over the whole
    table reads only the columns still in doubt."""
    flags = [F.col(f"`{c}`").isNotNull().alias(f"c{i}") for i, c in enumerate(df.columns)]
    # take() opens one partition first and more only when needed; a limit inside a plan would touch all of them
    probe = df.select(flags).take(probe_rows)
    doubtful = [c for i, c in enumerate(df.columns) if not any(r[i] for r in probe)]
    filled = filled_columns(df, doubtful)
    return [c for c in doubtful if c not in filled]


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Normalise nulls, then drop the columns in which no value is left. Looks at the data at once."""
    clean = normalize_nulls(df)
    empty = set(all_null(clean))
    return clean.select([F.col(f"`{c}`") for c in clean.columns if c not in empty])


def find_all_null_columns(df: DataFrame) -> DataFrame:
    """The names of the columns that hold no value, as a table."""
    return small_table(df.sparkSession, [{"column": c} for c in all_null(df)], "column: string")


def drop_duplicate_columns(df: DataFrame) -> DataFrame:
    """Keep the first of the columns that share a name."""
    by_position = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    first: dict[str, int] = {}
    for i, name in enumerate(df.columns):
        first.setdefault(name, i)
    return by_position.select([F.col(f"c{i}").alias(name) for name, i in first.items()])


def prefix_columns(df: DataFrame, prefix: str = X.META_PREFIX) -> DataFrame:
    return df.toDF(*[prefix + c for c in df.columns])


def select_existing(df: DataFrame, wanted: Sequence[str] = tuple(X.KEPT_COLUMNS), body: str = X.BODY) -> DataFrame:
    """The wanted columns that exist, in the wanted order. A table without a body column is an error."""
    if body not in df.columns:
        raise ValueError(f"column {body!r} not found")
    return df.select([c for c in wanted if c in df.columns])


def derive_complaint_label(df: DataFrame, type_col: str = X.COMPLAINT_TYPE, label: str = X.COMPLAINT) -> DataFrame:
    """1 when a complaint type is given, 0 when it is missing or "not applicable"."""
    kind = F.col(type_col)
    none = kind.isNull() | (F.lower(strip(kind)) == X.NOT_APPLICABLE)
    return df.withColumn(label, F.when(none, 0).otherwise(1).cast("long"))


def with_body_text(df: DataFrame, column: str = X.BODY) -> DataFrame:
    """The body as text; a missing one becomes the word nan."""
    return df.withColumn(column, tx.body_as_text(column))


def pick(df: DataFrame, key: str, index: int) -> DataFrame:
    """The row at ``index`` (from 0) in key order; outside the table is an error."""
    return row_at(df, key, index + 1)


def limit(df: DataFrame, n: int, key: str | None = None) -> DataFrame:
    """The first ``n`` rows, in key order when a key is given."""
    return first_rows(df, key, n) if key else df.limit(n)


def with_clean_text(df: DataFrame, source: str = X.BODY, target: str = X.CLEAN_BODY) -> DataFrame:
    """Add the cleaned text.

    Cleaning is costly and must run once per row, but a filter on the result would be pushed below the
    projection and run it again. A one-element explode keeps such filters above.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c != target]
    return df.select(*rest, F.explode(F.array(tx.clean_text(source))).alias(target))


def filter_short(df: DataFrame, column: str = X.CLEAN_BODY, threshold: int = X.MIN_LENGTH_DEFAULT) -> DataFrame:
    """Rows whose text has at least ``threshold`` characters."""
    if column not in df.columns:
        raise ValueError(f"column {column!r} not found")
    return df.filter(F.char_length(column) >= threshold)
