"""Byte-level BPE by rank files, in overlapping chunks, and its inverse."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailprep.llm.common import filled, nothing, steps
from mailprep.session import saved

CHUNK = 1 << 15    # characters of a chunk
MARGIN = 3         # characters that a pre-token may look at beyond its own
OVERLAP = 1 << 10  # characters that a chunk reads beyond its end, where the next one must resynchronise


@lru_cache(maxsize=4)
def encoding(ranks_file: str, pattern: str) -> tiktoken.Encoding:
    """The tokenizer of a rank file (one base64 token and its rank per line); once per worker."""
    with open(ranks_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def _compiled(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


def boundaries(text: str, pattern: str, start: int, stop: int) -> list[int]:
    """Starts of the pre-tokens of ``text`` from ``start``, a pre-token boundary, up to the first one at or after ``stop``."""
    out = [start]
    for m in _compiled(pattern).finditer(text, start):
        out.append(m.end())
        if m.end() >= stop:
            break
    return out


def _safe(text: str, at: int) -> bool:
    """Whether a text may be cut at this boundary without changing the pre-token before it: not after white space."""
    return at > 0 and not text[at - 1].isspace()


def _digests(name: str, ranks_file: str, pattern: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(ranks_file, pattern)
        for f in frames:
            texts, rest = filled(f[name]), f.drop(columns=[name])
            for a, b in steps(texts):
                ids = [np.asarray(enc.encode_ordinary(t), "<u4").tobytes() for t in texts[a:b]]
                yield rest.iloc[a:b].assign(ids=ids)
    return run


def encode(docs: DataFrame, ranks_file: str, pattern: str, key: str = "doc_id", text: str = "text",
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Token ids of every text: (key, ids), ids as little-endian unsigned 32-bit integers in one binary value.

    Texts of one chunk are encoded where they lie. Longer ones are cut in three steps: overlapping chunks go out to all
    tasks and are pre-tokenised, each from its own start; per text, the boundaries of neighbours are matched in the
    overlaps and pieces are formed; the pieces go out to all tasks and are encoded. Only boundaries and ids, never
    texts, come together per document, in chunk order.
    Null text is the empty text, which has no ids. Repeated rows each give a row. Special tokens are plain text.
    """
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    short = (rows.filter(F.length("_text") <= chunk)
             .mapInPandas(_digests("_text", ranks_file, pattern), f"_key {rows.schema['_key'].dataType.simpleString()}, ids binary"))
    longer = _long_texts(rows.filter(F.length("_text") > chunk), ranks_file, pattern, chunk, overlap)
    return short.union(longer).select(F.col("_key").alias(key), "ids")


def _long_texts(rows: DataFrame, ranks_file: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    spark, kind = rows.sparkSession, rows.schema["_key"].dataType.simpleString()
    # the row number is fixed by writing it, so repeated keys and rows stay apart
    rows = saved(rows.withColumn("_row", F.monotonically_increasing_id()), "bpe_long")
    if rows.isEmpty():
        return nothing(spark, f"_key {kind}, ids binary")
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    starts = F.posexplode(F.sequence(F.lit(0), F.length("_text") - 1, F.lit(chunk)))
    chunks = (rows.select("_row", "_text", starts.alias("_k", "_at"))
              .select("_row", "_k", "_at", F.expr(f"substring(_text, _at + 1, {chunk + overlap})").alias("_piece"))
              .repartition(n, "_row", "_k"))

    def own(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # of each chunk: the boundaries after its start, up to where its successor starts to be read, and in the overlap
        for f in frames:
            head, tail = [], []
            for t, at in zip(f["_piece"], f["_at"]):
                # a pre-token near the chunk's end may go on beyond it, or turn out to be a contraction
                found = [b for b in boundaries(t, pattern, 0, len(t)) if b < len(t) - MARGIN and _safe(t, b)]
                head.append([int(at + b) for b in found if b <= overlap])
                tail.append([int(at + b) for b in found if b >= chunk])
            yield f[["_row", "_k"]].assign(head=head, tail=tail)

    marks = chunks.mapInPandas(own, "_row long, _k int, head array<int>, tail array<int>")
    ordered = F.array_sort(F.collect_list(F.struct("_k", "head", "tail")))
    pieces = marks.groupBy("_row").agg(ordered.alias("chunks")).withColumn("cuts", _stitched("chunks"))
    # where a chunk doesn't resynchronise, nothing after it is proven: those rare texts are followed through in one go
    joined = rows.join(pieces.select("_row", "cuts"), "_row")
    ends = F.concat(F.slice("cuts", F.lit(2), F.size("cuts")), F.array(F.length("_text")))
    spans = joined.select("_row", "_key", "_text", F.posexplode(F.arrays_zip(F.col("cuts").alias("from"), ends.alias("to")))
                          .alias("_k", "_span"))
    cut = spans.select("_row", "_key", "_k", F.expr("substring(_text, _span.from + 1, _span.to - _span.from)").alias("_text"))
    ids = (cut.repartition(n, "_row", "_k")
           .mapInPandas(_digests("_text", ranks_file, pattern), f"_row long, _key {kind}, _k int, ids binary"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("_k", "ids"))), lambda x: F.hex(x["ids"]))
    return ids.groupBy("_row").agg(F.first("_key").alias("_key"), F.unhex(F.array_join(parts, "")).alias("ids")) \
        .select("_key", "ids")


def _stitched(column: str):
    """Cuts of a text from its chunks in order: each chunk is entered at the first boundary that it shares with the
    one before it. A chunk that was not entered has no proven boundaries, so its successor is not entered either."""
    first = F.struct(F.array(F.lit(0)).alias("cuts"), F.lit(True).alias("true"))

    def step(state, i):
        before, here = F.element_at(F.col(column), i), F.element_at(F.col(column), i + 1)
        met = F.array_min(F.array_intersect(before["tail"], here["head"]))
        ok = state["true"] & met.isNotNull()
        return F.struct(F.when(ok, F.array_append(state["cuts"], met)).otherwise(state["cuts"]).alias("cuts"),
                        ok.alias("true"))

    return F.when(F.size(column) < 2, F.array(F.lit(0))).otherwise(
        F.aggregate(F.sequence(F.lit(1), F.size(column) - 1), first, step)["cuts"])


def decode(encoded: DataFrame, ranks_file: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """(key, ids, bytes): the tokens' raw bytes one after the other. Null ids give empty bytes."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(ranks_file, pattern)
        for f in frames:
            ids = [b"" if x is None else x for x in f["ids"]]
            for a, b in steps(ids):
                yield f.iloc[a:b].assign(bytes=[enc.decode_bytes(np.frombuffer(x, "<u4").tolist()) for x in ids[a:b]])

    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(key, "ids").mapInPandas(run, f"`{key}` {kind}, ids binary, bytes binary")


def digests(decoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256)."""
    return decoded.select(key, F.floor(F.length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("bytes", 256).alias("decoded_sha256"))
