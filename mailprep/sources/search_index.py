"""Which files of a snapshot a search can leave out: a filter of trigrams per file.

The three-character pieces of a file's texts set bits of a filter of fixed size. A search whose pattern cannot match
without certain pieces skips the files that lack one of them. In files of very many unlike texts most bits are set, so
this pays for rare strings such as numbers and names, and for snapshots in many files.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailprep import fixed as X
from mailprep.functions import text as tx
from mailprep.operators import explore as E
from mailprep.session import small_table
from mailprep.sources.snapshot import FILE, read_snapshot

INDEX = "_trigrams2-"  # the folder of a column's index; readers of the table pass over it. The number tells the hash
BITS = 1 << 18         # of a file's filter
PART = 1 << 15         # bits of one row of it, as the engine's bitmaps have
STEP_CHARS = 1 << 18   # of a text that are hashed at once
FILTERS = pa.schema([("file", pa.string()), ("part", pa.int64()), ("bits", pa.binary())])


def _folded(c: Column) -> Column:
    """Letters that match each other in any case become one; only those that match an ASCII letter matter here."""
    return F.lower(reduce(lambda t, x: F.replace(t, F.lit(x[0]), F.lit(x[1])), zip("\u0130\u0131\u017f\u212a", "iisk"), c))


def _positions(text: str) -> np.ndarray:
    """The bits of the trigrams of a folded text."""
    signs = np.frombuffer(text.encode("utf-32-le"), "<u4").astype("u8")
    if len(signs) < 3:
        return np.zeros(0, "i8")
    h = ((signs[:-2] << np.uint64(42)) | (signs[1:-1] << np.uint64(21)) | signs[2:]) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (h >> np.uint64(64 - BITS.bit_length() + 1)).astype("i8")


def _filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (file, text) as the filters of their files, one row (file, part, bits) per part of a file and batch. Bit b of a
    part is bit b % 8 of byte b / 8, as the engine's bitmaps have it."""
    for batch in batches:
        texts, rows = batch["text"], []
        for file, run in groupby(enumerate(batch["file"].to_pylist()), key=lambda x: x[1]):
            marks = np.zeros(BITS, "u1")
            for i, _ in run:
                text = texts[i].as_py().decode("utf-8", "replace")
                for a in range(0, len(text), STEP_CHARS):
                    marks[_positions(text[a:a + STEP_CHARS + 2])] = 1
            parts = np.packbits(marks.reshape(-1, PART), axis=1, bitorder="little")
            rows += [{"file": file, "part": i, "bits": bits.tobytes()} for i, bits in enumerate(parts) if i == 0 or bits.any()]
        yield pa.RecordBatch.from_pylist(rows, schema=FILTERS)


def write_index(spark: SparkSession, path: str, column: str = X.BODY) -> None:
    """The filter of every file of a snapshot: (file, part, bits). The trigrams of a batch of texts are marked where the
    texts are; only filters leave a task. A file of short texts alone has an empty filter."""
    rows = read_snapshot(spark, path).select(F.col(FILE).alias("file"), _folded(tx.body_as_text(column)).cast("binary").alias("text"))
    marked = rows.mapInArrow(_filters, "file string, part long, bits binary")
    marked.groupBy("file", "part").agg(F.bitmap_or_agg("bits").alias("bits")).write.parquet(f"{path}/{INDEX}{column}")


def read_index(spark: SparkSession, path: str, column: str = X.BODY) -> DataFrame | None:
    try:
        return spark.read.parquet(f"{path}/{INDEX}{column}")
    except AnalysisException:
        return None


def needed(query: str, literal: bool = False) -> list[str]:
    """Strings that every hit holds, in any case.

    Of a pattern these are the stretches of plain characters that are neither optional nor repeated. Patterns with
    alternatives, groups, flags or quoted parts give none: they search all files.
    """
    query = query.strip()
    if literal:
        return [query]
    if any(sign in query for sign in ("|", "(", "[]", "[^]")):
        return []
    sets = r"\[[^\[\]\\&]+\]"
    if "[" in re.sub(rf"\\.|{sets}", "", query, flags=re.DOTALL) or re.search(r"\\[^.\-+*?$^/\[\]{}dDwWsSbB]", query):
        return []
    found = [""]
    for sign, repeated in re.findall(rf"(\\.|{sets}|.)((?:[*+?]|\{{[^}}]*\}})*)", query, flags=re.DOTALL):
        plain = sign[1:] if len(sign) == 2 and sign[0] == "\\" and not sign[1].isalpha() else sign
        if repeated or len(plain) != 1 or (plain == sign and sign in ".^$"):
            found.append("")
        else:
            found[-1] += plain
    return [f for f in found if f]


def _pieces(spark: SparkSession, strings: list[str]) -> DataFrame:
    """The bits that a file with all these strings has set: (part, byte, bit). Pieces beyond ASCII are not asked for."""
    rows = small_table(spark, [{"s": s} for s in strings], "s: string").select(_folded(F.col("s")).alias("s"))
    pieces = sorted({r["s"][i:i + 3] for r in rows.collect() for i in range(len(r["s"]) - 2) if r["s"][i:i + 3].isascii()})
    at = sorted({int(_positions(s)[0]) for s in pieces})
    return small_table(spark, [{"part": a // PART, "byte": a % PART // 8, "bit": a % 8} for a in at], "part: long, byte: int, bit: int")


def without(index: DataFrame, strings: list[str]) -> DataFrame:
    """The files whose filter proves that no text holds all of ``strings``: (file)."""
    asked = _pieces(index.sparkSession, strings)  # as many rows as the query has trigrams
    n = asked.count()
    if n == 0:
        return index.select("file").limit(0)
    byte = F.conv(F.hex(F.substring("bits", F.col("byte") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(F.coalesce(byte, F.lit(0)), F.col("bit")) == 1
    hits = index.join(F.broadcast(asked), "part").groupBy("file").agg(F.count_if(is_set).alias("n")).filter(F.col("n") == n)
    return index.select("file").distinct().join(hits, "file", "left_anti")


def search(rows: DataFrame, index: DataFrame | None, query: str, regex: bool = False, literal: bool = False,
           column: str = X.BODY) -> DataFrame:
    """``search_regex`` or ``search_text`` on a snapshot as read, or with filters, opening only files that can have hits.

    Files that the index does not know are searched. The names of skipped files go through the driver, which lists
    all files of a scan anyway.
    """
    strings = [] if index is None else needed(query, literal and not regex)
    if any(len(s) > 2 for s in strings):
        names = [r["file"] for r in without(index, strings).collect()]
        if names:
            rows = rows.filter(~F.col(FILE).isin(names))
    return E.search_regex(rows, query, column) if regex else E.search_text(rows, query, literal, column)
