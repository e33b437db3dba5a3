"""A corpus made ready for training: five stages, each over all that the one before kept.

    run(spark, sf_dir)

reads the documents, applies the stages and writes and rereads the result of each but the last in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailprep.llm import bpe_codec, jaccard_join, language_id, source_mix, suffix_dedup
from mailprep.llm.common import reachable
from mailprep.session import broadcast_if_small, saved, scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

RANKS = "byte_bpe_multi_50k.tiktoken"
MAX_SENT = 1_000_000  # row numbers that go to every task
BATCH_ROWS = "2000"  # rows that a Python worker takes at once; texts are long


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told from their text; those without a letter or with no clear language go.

    The model is fitted on the documents' own labels. ``lang`` stays as it is given.
    """
    told = language_id.identify(docs, language_id.fit(docs))
    return told.filter((F.col("lang_pred") != language_id.NONE) & ~F.col("ambiguous")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id, one without an id only if no other is
    there. Every row is a document of its own, whatever its id; documents without words stay."""
    rows = saved(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    with scratch(spark):  # the join's own tables take room from the stages that follow
        groups = jaccard_join.near_duplicates(rows.select("_row", "text"), "_row")
        ids = rows.select("_row", F.struct(F.col("doc_id").isNull(), "doc_id", "_row").alias("order"))
        first = ids.join(groups, "_row").groupBy("component_id").agg(F.min("order")["_row"].alias("first"), F.count("*").alias("n"))
        gone = groups.join(first.filter("n > 1"), "component_id").filter("_row != first").select("_row")
        gone = saved(gone, "gone", lasting=True)
    # texts stay where they are unless very many rows go
    return rows.join(broadcast_if_small(gone, MAX_SENT), "_row", "left_anti").select(*docs.columns)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the passages of 200 bytes and more that stand elsewhere too.

    A character of which a passage takes a part goes as a whole. A null text stays null.
    """
    done = suffix_dedup.dedup(docs, whole=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept").cast("string")).otherwise(F.col("text"))
    done = done.withColumn("text", text)
    return done.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix takes them, repeats as rows of their own, in training order."""
    return source_mix.sequence(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids, decoded_sha256): token ids of every row and what they decode to."""
    args = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    rows = docs.select(F.struct("doc_id", "source").alias("row"), "text")
    # written in between: both steps in one task would keep two Python workers for it
    done = bpe_codec.decode(saved(bpe_codec.encode(rows, *args, key="row"), "encoded"), *args, key="row")
    return done.select("row.doc_id", "row.source", F.floor(F.length("ids") / 4).alias("n_tokens"), "ids",
                       F.sha2("bytes", 256).alias("decoded_sha256"))


def _stage(fn: Stage) -> Stage:
    @wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        reachable(spark)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return fn(spark, docs, sf_dir)

    return run


STAGES = [("language ID", _stage(languages)), ("n-gram Jaccard join", _stage(near_duplicates)),
          ("suffix-array dedup", _stage(repeats)), ("mixing sources to target weights", _stage(mixture)),
          ("byte-level BPE", _stage(tokens))]

ORACLE_SQL = None  # SQL expresses neither the language model nor the removal of repeated passages; tests do it by hand


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
