"""Delimited text files, read in splits also where quoted cells hold line feeds.

A split may begin inside a quoted cell. Whether one does is not told from the split alone, but each split can say how it
would end if it began outside, and how if it began inside; these answers are put together in order of the splits of a file.
After that every split knows how it begins, and reads the records that begin in it to their end.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailprep import fixed as X
from mailprep.session import saved

QUOTE = b'"'
MAX_BROADCAST_SPLITS = 100_000    # splits that begin or end inside a cell, or belong to a file with another header
MAX_BROADCAST_BYTES = 256 << 20   # of the cells that run over splits


# --- splits -------------------------------------------------------------------------------------------------

def inside_after(line: bytes, inside: bool, sep: bytes) -> bool:
    """Whether a quoted cell is open after a line, given whether one was before. A quote opens a cell only at its start."""
    at = 0
    while True:
        if not inside:
            if line[at:at + 1] != QUOTE:
                at = line.find(sep, at) + len(sep)
                if at < len(sep):
                    return False
                continue
            at += 1
        end = line.find(QUOTE, at)
        while end >= 0 and line[end + 1:end + 2] == QUOTE:
            end = line.find(QUOTE, end + 2)
        if end < 0:
            return True
        at = line.find(sep, end + 1) + len(sep)  # what follows the quote belongs to the cell
        if at < len(sep):
            return False
        inside = False


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, value) of every line, in order within a split. ``split`` is where in the file it begins."""
    raw = spark.read.text(path, lineSep="\n")
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                      F.col("value").cast("binary").alias("value"))


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Parts of batches that lie in one split, with (file, split)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        file, split = batch["file"], batch["split"].to_numpy()
        cut = (split[1:] != split[:-1]) | pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False).astype(bool)
        edges = [0, *(np.flatnonzero(cut) + 1).tolist(), n]
        for a, b in zip(edges[:-1], edges[1:]):
            yield (file[a].as_py(), int(split[a])), batch.slice(a, b - a)


def _quoted(values: pa.Array) -> np.ndarray:
    """Places of the lines that hold a quote."""
    return np.flatnonzero(pc.count_substring(values, '"').to_numpy(zero_copy_only=False))


def _walk(values: pa.Array, inside: bool, sep: bytes) -> np.ndarray:
    """After each line, whether a quoted cell is open."""
    out, at = np.zeros(len(values), bool), 0
    for i in _quoted(values).tolist():
        out[at:i] = inside
        inside, at = inside_after(values[i].as_py(), inside, sep), i
    out[at:] = inside
    return out


def _split_answers(lines: DataFrame, sep: str, multi_line: bool) -> DataFrame:
    """(file, split, outside, inside, header) of every split: whether a cell is open at its end if none was at its
    beginning, and if one was; ``header`` is the first record of a file's first split that is not empty."""
    mark = sep.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, outside, inside, header, open_ = None, False, True, None, False
        for place, part in _stretches(batches):
            if place != now:
                if now:
                    yield answer(now, outside, inside, header)
                now, outside, inside, header, open_ = place, False, True, None, place[1] == 0
            values = part["value"]
            if open_:  # the header is still to be read
                for value in values.to_pylist():
                    if header is None and value in (b"", b"\r"):
                        continue
                    before = header is not None
                    header = header + b"\n" + value if before else value
                    if not (multi_line and inside_after(value, before, mark)):
                        open_ = False
                        break
            if multi_line:
                for i in _quoted(values).tolist():
                    line = values[i].as_py()
                    same = outside == inside
                    outside = inside_after(line, outside, mark)
                    inside = outside if same else inside_after(line, inside, mark)
        if now:
            yield answer(now, outside, inside, header)

    def answer(place: tuple, outside: bool, inside: bool, header: bytes | None) -> pa.RecordBatch:
        row = {"file": place[0], "split": place[1], "outside": outside, "inside": inside and multi_line, "header": header}
        return pa.RecordBatch.from_pylist([row], schema=schema)

    schema = pa.schema([("file", pa.string()), ("split", pa.int64()), ("outside", pa.bool_()), ("inside", pa.bool_()), ("header", pa.binary())])
    return lines.mapInArrow(run, "file string, split long, outside boolean, inside boolean, header binary")


def _begins(answers: DataFrame) -> DataFrame:
    """``answers`` with ``begins``: whether a split begins inside a cell, and ``ends``: whether it ends in one.

    The last split that ends alike either way settles it; those since then that turn it over are counted.
    """
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    swaps = F.coalesce(F.sum(F.when(F.col("outside") & ~F.col("inside"), 1).otherwise(0)).over(before), F.lit(0))
    known = F.when(F.col("outside") == F.col("inside"), F.struct(F.col("outside").cast("int").alias("v"), F.col("swaps").alias("s")))
    out = answers.withColumn("swaps", swaps).withColumn("last", F.last(known, ignorenulls=True).over(before))
    turned = F.coalesce(F.col("last.v"), F.lit(0)) + F.col("swaps") - F.coalesce(F.col("last.s"), F.lit(0))
    out = out.withColumn("begins", turned % 2 == 1)
    return out.withColumn("ends", F.when(F.col("begins"), F.col("inside")).otherwise(F.col("outside"))).drop("swaps", "last")


def _marked(lines: DataFrame, splits: DataFrame, how: str) -> DataFrame:
    """Lines with what is known of their split. The lines of a split stay together and in order."""
    few = splits.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("more")), F.lit(0)).alias("b")).first()
    if few["n"] <= MAX_BROADCAST_SPLITS and few["b"] <= MAX_BROADCAST_BYTES:
        return lines.join(F.broadcast(splits), ["file", "split"], how)
    placed = lines.withColumn("at", F.monotonically_increasing_id())  # ascends within a split
    return placed.join(splits, ["file", "split"], how).sortWithinPartitions("file", "split", "at").drop("at")


def _heads(lines: DataFrame, sep: str) -> DataFrame:
    """(file, split, head, closed): what the given lines of splits that begin inside a cell have up to the end of that
    record, and whether it ends there."""
    mark = sep.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, head, open_ = None, [], True
        for place, part in _stretches(batches):
            if place != now:
                if now:
                    yield batch(now, head, not open_)
                now, head, open_ = place, [], True
            if open_:
                after = _walk(part["value"], True, mark)
                end = int(np.argmin(after)) + 1 if not after.all() else len(after)
                open_ = bool(after.all())
                head += part["value"].slice(0, end).to_pylist()
        if now:
            yield batch(now, head, not open_)

    def batch(place: tuple, head: list[bytes], closed: bool) -> pa.RecordBatch:
        row = {"file": place[0], "split": place[1], "head": b"\n".join(head), "closed": closed}
        return pa.RecordBatch.from_pylist([row], schema=schema)

    schema = pa.schema([("file", pa.string()), ("split", pa.int64()), ("head", pa.binary()), ("closed", pa.bool_())])
    return lines.select("file", "split", "value").mapInArrow(run, "file string, split long, head binary, closed boolean")


def _tails(special: DataFrame, heads: DataFrame) -> DataFrame:
    """``special`` with ``more``: what the record that is open at the end of a split has in the next ones, up to the first
    in which it ends."""
    rank = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, 0)  # one row per split
    opens = (F.col("ends") & (~F.col("begins") | F.coalesce("closed", F.lit(False)))).cast("int")
    rows = special.drop("more").join(heads, ["file", "split"], "left").withColumn("opens", opens)
    rows = rows.withColumn("chain", F.sum("opens").over(rank))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("split", "head"))), lambda x: x["head"].cast("string"))
    tails = (rows.filter("begins").groupBy("file", (F.col("chain") - F.col("opens")).alias("chain"))
             .agg(F.array_join(parts, "\n").cast("binary").alias("more")).withColumn("opens", F.lit(1)))
    return rows.drop("head", "closed").join(tails, ["file", "chain", "opens"], "left").drop("chain", "opens")


def _records(lines: DataFrame, sep: str, multi_line: bool) -> DataFrame:
    """(kind, record) of every record that begins in a split, without the headers. Lines carry ``begins``, ``kind`` and ``more``,
    the rest of the last record, which are null where nothing special is known of a split."""
    mark = sep.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, inside, skip, pending, last = None, False, False, [], (None, None)
        for place, part in _stretches(batches):
            if place != now:
                if pending:
                    yield batch([whole(pending, last[1])], last[0])
                now, inside, pending = place, bool(part["begins"][0].as_py()), []
                skip = inside or place[1] == 0  # the first record is another split's, or the header
                last = (part["kind"][0].as_py(), part["more"][0].as_py())
                header = place[1] == 0
            values = part["value"]
            after = _walk(values, inside, mark) if multi_line else np.zeros(len(values), bool)
            inside = bool(after[-1])
            if skip:
                start = 0
                while header and start < len(values) and values[start].as_py() in (b"", b"\r"):
                    start += 1
                ends = np.flatnonzero(~after[start:])
                if start == len(values) or not len(ends):
                    header = header and start == len(values)
                    continue
                skip = False
                values, after = values.slice(start + int(ends[0]) + 1), after[start + int(ends[0]) + 1:]
            if not len(values):
                continue
            if not pending and not after.any():
                yield batch(values, last[0])
                continue
            out = []
            for value, more in zip(values.to_pylist(), after.tolist()):
                pending.append(value)
                if not more:
                    out.append(b"\n".join(pending))
                    pending = []
            yield batch(out, last[0])
        if pending:
            yield batch([whole(pending, last[1])], last[0])

    def whole(lines_: list[bytes], more: bytes | None) -> bytes:
        return b"\n".join(lines_ if more is None else [*lines_, more])

    def batch(records: pa.Array | list, kind: int | None) -> pa.RecordBatch:
        records = pa.array(records, pa.binary()) if isinstance(records, list) else records
        return pa.RecordBatch.from_arrays([pa.array([kind or 0] * len(records), pa.int32()), records], ["kind", "record"])

    return lines.mapInArrow(run, "kind int, record binary")


# --- files --------------------------------------------------------------------------------------------------

def _names(header: bytes, sep: str) -> list[str]:
    """The column names as written; a repeated name gets .1, .2 ... added."""
    cells = next(csv.reader(io.StringIO(header.decode("utf-8", "replace"), newline=""), delimiter=sep), [])
    names: list[str] = []
    for i, name in enumerate(cells):
        name, copy = name or f"Unnamed: {i}", 0
        unique = name
        while unique in names:
            copy += 1
            unique = f"{name}.{copy}"
        names.append(unique)
    return names


def _cells(record: Column, names: list[str], order: list[str], sep: str, file: str) -> Column:
    # Two more columns tell long rows from short ones: a row in order is one field short of this schema, so that
    # _bad is set and _extra is empty.
    fields = [f"c{i}" for i in range(len(names))]
    schema = ", ".join(f"{f} string" for f in [*fields, "_extra", "_bad"])
    parsed = F.from_csv(record, schema, {
        "sep": sep, "multiLine": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "nullValue": "",
        "ignoreTrailingWhiteSpace": "false", "maxCharsPerColumn": "-1", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    problem = F.raise_error(F.lit(f"a row of {file} or a file like it has more than {len(names)} fields"))

    def cell(row: Column, name: str) -> Column:
        value = row[fields[names.index(name)]]
        return F.when(~value.isin(*X.MISSING_CELLS), value).alias(name)

    def checked(row: Column) -> Column:
        too_long = F.when(row["_extra"].isNotNull() | row["_bad"].isNull(), problem).cast("boolean")
        return F.when(F.coalesce(too_long, F.lit(True)), F.struct(*[cell(row, n) for n in order]))

    return F.get(F.transform(F.array(parsed), checked), 0)


def read_delimited(spark: SparkSession, path: str, sep: str = ";", multi_line: bool = True) -> DataFrame | None:
    """A file with a header, or a folder of such files, all columns text, missing-value words read as null.

    Every file is read by its own header, and all headers by one job; files with the same columns in another order are
    put together by name, and a file with other columns is an error that names it. Short rows are filled up with nulls,
    empty lines are left out. A row with too many fields fails the job. A missing file is reported and gives None.

    Files are read in splits of ``spark.sql.files.maxPartitionBytes`` even if a quoted cell holds line feeds and runs over
    splits; ``multi_line`` False takes every line as a record. In a file whose header ends in CR LF, CR LF in cells is
    read as LF. The files must not change between the call and the use of the result.
    """
    try:
        lines = _lines(spark, path)
        answers = saved(_split_answers(lines, sep, multi_line), "splits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        print(f"File not found: {path}")
        return None
    headers = answers.filter("header is not null").groupBy("header").agg(F.count("*").alias("files"), F.min("file").alias("file"))
    headers = [r.asDict() for r in headers.collect()]  # one row per header
    if not headers:
        return spark.createDataFrame([], T.StructType())
    order = _names(bytes(min(headers, key=lambda h: h["file"])["header"]).rstrip(b"\r"), sep)
    headers.sort(key=lambda h: -h["files"])
    for h in headers:
        h["names"], h["crlf"] = _names(bytes(h["header"]).rstrip(b"\r"), sep), bytes(h["header"]).endswith(b"\r")
        if set(h["names"]) != set(order):
            raise ValueError(f"{h['file']} has other columns than the files before it: {sorted(set(h['names']) ^ set(order))}")
    kinds = F.coalesce(*[F.when(F.col("header") == F.lit(bytes(h["header"])), i) for i, h in enumerate(headers)])
    told = _begins(answers).withColumn("kind", F.max(kinds).over(Window.partitionBy("file")))
    special = saved(told.filter("begins or ends or kind > 0"), "splits").withColumn("more", F.lit(None).cast("binary"))
    if multi_line and not special.filter("begins").isEmpty():
        heads = saved(_heads(_marked(lines, special.filter("begins").select("file", "split", "more"), "inner"), sep), "heads")
        special = saved(_tails(special, heads), "splits")
    marked = _marked(lines, special.select("file", "split", "begins", "kind", "more"), "left")
    rows = _records(marked.select("file", "split", "value", "begins", "kind", "more"), sep, multi_line)
    record = F.col("record").cast("string")
    unix = F.regexp_replace(F.regexp_replace(record, "\r$", ""), "\r\n", "\n")
    text = record
    for i, h in enumerate(headers):
        if h["crlf"]:
            text = F.when(F.col("kind") == i, unix).otherwise(text)
    rows = rows.select("kind", text.alias("record")).filter("record != ''")
    cells = F.coalesce(*[F.when(F.col("kind") == i, _cells(F.col("record"), h["names"], order, sep, h["file"])) for i, h in enumerate(headers)])
    # the explode keeps a record from being parsed once per column
    return rows.select(F.explode(F.array(cells)).alias("row")).select(*[F.col(f"row.`{n}`").alias(n) for n in order])


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.csv(path, sep=sep, header=True, quote='"', escape='"', emptyValue="", nullValue="", quoteAll=False,
                 ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
