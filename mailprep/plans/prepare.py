"""From mail and case tables to the cleaned snapshot."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailprep import fixed as X
from mailprep.operators import schema as C
from mailprep.operators.joins import join_metadata
from mailprep.operators.language import detect_language
from mailprep.session import saved, small_table
from mailprep.sources.delimited import read_delimited, write_delimited


def merge(mails: DataFrame, meta: DataFrame, wanted: Sequence[str], salts: int | None = None,
          dropped: list[dict] | None = None) -> DataFrame:
    """Prune empty and repeated columns, join mails to their case, derive the complaint label.

    The join is written once and read from there. A column that loses its last value in the join is dropped as well.
    The names of the columns without a value are added to ``dropped``, with the table that held them; of the joined table
    only the wanted columns are looked at.
    """
    def told(table: str, names: Iterable[str]) -> None:
        if dropped is not None:
            dropped.extend({"table": table, "column": c} for c in names)

    def filled(df: DataFrame, table: str) -> DataFrame:
        left = C.drop_all_null_columns(df)
        told(table, [c for c in dict.fromkeys(df.columns) if c not in left.columns])
        return C.drop_duplicate_columns(left)

    mails = filled(mails, "mails")
    meta = C.prefix_columns(filled(meta, "cases"))
    if X.BODY not in mails.columns:
        raise ValueError(f"column {X.BODY!r} not found")
    kept = [c for c in wanted if c in (*mails.columns, *meta.columns)]
    joined = C.derive_complaint_label(join_metadata(mails, meta, salts=salts)).select(
        [c for c in wanted if c == X.COMPLAINT or c in kept])
    merged = saved(joined, "merged")
    empty = set(C.all_null(merged))
    told("merged", [c for c in merged.columns if c != X.COMPLAINT and c in empty])
    return merged.select([c for c in merged.columns if c == X.COMPLAINT or c not in empty])


def prepare(mails: DataFrame, meta: DataFrame, model: DataFrame | None = None, keep: tuple[str, ...] = (),
            threshold: int = X.MIN_LENGTH_PREPARE, salts: int | None = None, dropped: list[dict] | None = None) -> DataFrame:
    """The cleaned snapshot: merge, clean the bodies, drop short mails, detect languages when given a model.

    ``keep`` carries further columns along, such as a unique mail key for splitting. Bodies are cleaned and judged
    where the join leaves them; only the wanted columns of the mails cross the network. The mails of very large cases are dealt over
    many tasks; ``salts`` as in ``join_metadata``, ``dropped`` as in ``merge``.
    """
    merged = C.select_existing(merge(mails, meta, [*keep, *X.KEPT_COLUMNS], salts, dropped), [*keep, *X.KEPT_COLUMNS])
    cleaned = C.with_clean_text(C.with_body_text(merged))
    long_enough = C.filter_short(cleaned, threshold=threshold)  # before the languages: fewer rows to judge
    return long_enough if model is None else detect_language(long_enough, model)


def prepare_files(spark: SparkSession, mails_path: str, meta_path: str, model: DataFrame | None = None,
                  keep: tuple[str, ...] = (), multi_line: bool = True, first: int | None = None,
                  pick: int | None = None, empty_columns: str | None = None) -> DataFrame | None:
    """The same from two delimited files; None when one is missing. Each file is parsed once and kept as a table.

    ``first`` takes so many mails, in the order of the first column of ``keep`` if there is one; ``pick`` takes the
    one mail at that place (from 0) of that order. ``empty_columns`` names a folder for the report of the columns without
    a value in the mails, the cases and the merged table: (table, column).
    """
    mails, meta = read_delimited(spark, mails_path, multi_line=multi_line), read_delimited(spark, meta_path, multi_line=multi_line)
    if mails is None or meta is None:
        print("Missing dataset files.")
        return None
    mails, meta = saved(mails, "mails"), saved(meta, "cases")
    if pick is not None:
        if not keep:
            raise ValueError("one mail is picked by the order of a key: name it in keep")
        mails = C.pick(mails, keep[0], pick).drop("position", "total")
    elif first is not None:
        mails = C.limit(mails, first, keep[0] if keep else None)
    dropped: list[dict] = []
    done = prepare(mails, meta, model, keep, dropped=dropped)
    if empty_columns is not None:
        write_delimited(small_table(spark, dropped, "table: string, column: string"), empty_columns)
    return done
