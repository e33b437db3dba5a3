"""Command line: python -m mailprep prepare|train-complaints|train-types|train-languages|profile|explore ..."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from mailprep import fixed as X
from mailprep.operators import explore as E
from mailprep.operators.language import language_model
from mailprep.operators.profile import profile
from mailprep.plans import prepare as A
from mailprep.plans import train as B
from mailprep.session import saved
from mailprep.sources import search_index
from mailprep.sources.snapshot import read_order, read_snapshot, record_of, write_ordered, write_snapshot

DETAILS = (X.COMPLAINT_TYPE, X.COMPLAINT, "Language", "LangName", "Priority")


def record(rows: DataFrame, args: argparse.Namespace, order: DataFrame | None, filtered: bool) -> DataFrame:
    """Record k of N: its position, its details, the original and the cleaned text. In an ordered snapshot one file is
    read for it, after the filtered rows of each file were counted."""
    if order is None:
        found = E.record_at(rows, args.key, args.record)
    else:
        found = record_of(rows, args.key, args.record, None if filtered else order)
    return found.select("position", "total", args.key,
                        *[c for c in (*DETAILS, X.BODY, X.CLEAN_BODY) if c in found.columns and c != args.key])


def found(rows: DataFrame, args: argparse.Namespace, order: DataFrame | None = None, index: DataFrame | None = None) -> DataFrame:
    """What the explore job writes."""
    plain = E.explore(rows, "", False, False, args.max_chars, args.type, args.language, args.priority, body=args.body)
    rows = search_index.search(plain, index, args.query, args.regex, args.literal, args.body)
    if args.spans:
        return E.match_spans(rows, args.key, args.query, args.regex, args.body)
    if args.facets:
        return E.facet_counts(rows)
    if args.page:
        return E.page(rows, args.key, args.page, args.after, args.before)
    if args.record:
        all_rows = args.query.strip() == "" and not args.max_chars and {args.type, args.language, args.priority} == {E.ALL}
        return record(rows, args, order, not all_rows)
    return rows


def parsed(given: list[str] | None = None) -> argparse.Namespace:
    top = argparse.ArgumentParser(prog="mailprep")
    sub = top.add_subparsers(dest="job", required=True)
    job = sub.add_parser("prepare", help="delimited mails and case data to a cleaned snapshot")
    job.add_argument("mails")
    job.add_argument("meta")
    job.add_argument("out")
    job.add_argument("--key", help="unique mail column to carry along for training")
    job.add_argument("--languages", help="saved language model table")
    job.add_argument("--train-on", help="labelled texts (text, lang) to make a language model of, if none is saved")
    job.add_argument("--empty-columns", help="folder for the report of columns without a value")
    job.add_argument("--ordered", action="store_true", help="write the snapshot in key order, with a filter of trigrams per file")
    job.add_argument("--single-line", action="store_true", help="no field holds a line feed: split large files")
    job.add_argument("--first", type=int, help="only the first mails, in key order if there is a key")
    job.add_argument("--pick", type=int, help="only the mail at this place (from 0) in key order")
    for name in ("train-complaints", "train-types"):
        job = sub.add_parser(name, help="classifier and reports from a snapshot")
        job.add_argument("snapshot")
        job.add_argument("key", help="unique mail column")
        job.add_argument("out")
    job = sub.add_parser("train-languages", help="language model from labelled texts")
    job.add_argument("texts", help="table with a text and a language column")
    job.add_argument("out")
    job.add_argument("--text", default="text")
    job.add_argument("--lang", default="lang")
    job = sub.add_parser("profile", help="profile of a snapshot, as a table")
    job.add_argument("snapshot")
    job.add_argument("out")
    job = sub.add_parser("explore", help="filter, search and page through a snapshot")
    job.add_argument("snapshot")
    job.add_argument("out")
    job.add_argument("--query", default="")
    job.add_argument("--regex", action="store_true")
    job.add_argument("--literal", action="store_true")
    job.add_argument("--body", default=X.BODY, choices=[X.BODY, X.CLEAN_BODY], help="searched text: the original or the cleaned one")
    job.add_argument("--max-chars")
    job.add_argument("--type", default=E.ALL, help="complaint type, or <Missing>")
    job.add_argument("--language", default=E.ALL)
    job.add_argument("--priority", default=E.ALL)
    what = job.add_mutually_exclusive_group()
    what.add_argument("--facets", action="store_true", help="counts per type, language and priority instead of rows")
    what.add_argument("--spans", action="store_true", help="places of the hits: key, start and end in characters")
    what.add_argument("--page", type=int, help="so many rows in key order")
    what.add_argument("--record", type=int, help="the row at this position")
    job.add_argument("--key", help="unique mail column for pages, records and spans")
    job.add_argument("--after", help="the page after this key")
    job.add_argument("--before", help="the page before this key")
    args = top.parse_args(given)
    if args.job == "prepare" and args.ordered and args.key is None:
        top.error("--ordered needs a --key")
    if args.job == "explore" and args.key is None and (args.spans or args.page or args.record):
        top.error("--spans, --page and --record need a --key")
    return args


def main() -> None:
    args = parsed()
    spark = SparkSession.builder.appName(f"mailprep {args.job}").getOrCreate()
    if args.job == "prepare":
        model = read_snapshot(spark, args.languages) if args.languages else None
        if model is None and args.train_on:
            model = saved(language_model(read_snapshot(spark, args.train_on), "text", "lang"), "languages")
        table = A.prepare_files(spark, args.mails, args.meta, model, keep=(args.key,) if args.key else (),
                                multi_line=not args.single_line, first=args.first, pick=args.pick,
                                empty_columns=args.empty_columns)
        if table is not None and args.ordered:
            write_ordered(table, args.out, args.key)
            for column in (X.BODY, X.CLEAN_BODY):
                search_index.write_index(spark, args.out, column)
        elif table is not None:
            write_snapshot(table, args.out)
    elif args.job == "profile":
        write_snapshot(profile(read_snapshot(spark, args.snapshot)), args.out)
    elif args.job == "train-languages":
        write_snapshot(language_model(read_snapshot(spark, args.texts), args.text, args.lang), args.out)
    elif args.job == "explore":
        rows = found(read_snapshot(spark, args.snapshot), args, read_order(spark, args.snapshot),
                     search_index.read_index(spark, args.snapshot, args.body))
        write_snapshot(rows, args.out)
    else:
        train = B.train_complaints if args.job == "train-complaints" else B.train_complaint_types
        train(read_snapshot(spark, args.snapshot), args.key, args.out)
    spark.stop()


if __name__ == "__main__":
    main()
