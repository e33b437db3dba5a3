"""The pipeline's operators over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailprep.llm import (bpe_codec, imatch, jaccard_join, language_id, merkle, quality_lm, simhash_join, source_mix,
                          suffix_dedup, token_counts, topk_search, url_filter, word_runs)
from mailprep.llm.common import reachable, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RANKS = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        reachable(spark)
        return fn(spark, sf)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_topk_search(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 best rows for every twentieth vector."""
    return topk_search.top_k(table(spark, sf, "embeddings"), 20, F.col("vec_id") % 20 == 0)


@query
def op2_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Perplexity of every document under the text of all documents labelled good, and whether it stays."""
    docs = table(spark, sf, "documents")
    good = quality_lm.trusted_texts(docs, table(spark, sf, "labels").filter("quality = 1"))
    return quality_lm.judge(docs, good, keep=["doc_id", "lang"])


@query
def op3_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf, "documents"))


@query
def op4_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = language_id.fit(docs.filter(~held_out))
    told = language_id.identify(docs.withColumn("held_out", held_out).drop("lang"), model)
    return told.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"), "ambiguous")


@query
def op5_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf, "documents"), public_tokenizers.path(PIECES))


@query
def op6_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, sf, "pages"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op7_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    return source_mix.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "position")


@query
def op8_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    args = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    ids = bpe_codec.encode(table(spark, sf, "documents"), *args)
    return bpe_codec.digests(bpe_codec.decode(ids, *args))


@query
def op9_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    done = suffix_dedup.dedup(table(spark, sf, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op10_imatch(spark: SparkSession, sf: str) -> DataFrame:
    return imatch.fingerprint(table(spark, sf, "documents"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query
def op11_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's place in the manifest, and the root that a fifth of them make when their capitals are lost."""
    return merkle.tampering(table(spark, sf, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], "doc_id", "source",
                            {"text": F.translate("text", UPPER, LOWER)}, F.crc32(F.col("doc_id").cast("string")) % 5 == 0)


@query
def op12_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash_join.near_duplicates(table(spark, sf, "documents"))


def with_loops(text: Column, key: Column) -> Column:
    """Every tenth text by the hash of its key with its words from some place on repeating in a loop."""
    h = F.crc32(key.cast("string"))
    g = F.floor(h / 10)

    def looped(w: Column) -> Column:
        a = g % F.size(w)
        p = 1 + F.floor((F.size(w) - a) / (3 + g % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.when(F.size(w) > 0, F.array_join(F.transform(w, lambda _, i: F.get(w, place(i))), " ")).otherwise(text)

    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    return F.when(h % 10 == 0, F.get(F.transform(F.array(words), looped), 0)).otherwise(text)


@query
def op13_word_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The runs of words of every document, a tenth of them looped, and digests of what is left without the repeats."""
    docs = table(spark, sf, "documents").select("doc_id", with_loops(F.col("text"), F.col("doc_id")).alias("text"))
    done = word_runs.word_runs(docs)
    more = lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a)
    best = F.reduce("runs", F.get("runs", F.lit(0)), more)
    line = lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))
    lines = F.transform("runs", line)
    done = done.withColumn("best", best)
    return done.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                       F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                       F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
                       F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
