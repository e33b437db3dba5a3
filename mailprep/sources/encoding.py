"""Guessing the encodings of text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed values: byte-order marks, longest first ---
MARKS = [("FFFE0000", "UTF-32"), ("0000FEFF", "UTF-32"), ("EFBBBF", "UTF-8-SIG"), ("FFFE", "UTF-16"), ("FEFF", "UTF-16")]


def _answer(encoding: str, confidence: float) -> Column:
    return F.struct(F.lit(encoding).alias("encoding"), F.lit(confidence).alias("confidence"))


def _judged(files: DataFrame, plain: Column, valid: Column) -> DataFrame:
    """The answer for files with (path, head), head being the first bytes in hexadecimal."""
    guess = F.when(plain, _answer("ascii", 1.0)).when(valid, _answer("utf-8", 0.99)).otherwise(_answer("Windows-1252", 0.73))
    for mark, name in reversed(MARKS):
        guess = F.when(F.startswith("head", F.lit(mark)), _answer(name, 1.0)).otherwise(guess)
    return files.select("path", guess.alias("g")).select("path", "g.encoding", "g.confidence")


def encoding_census(spark: SparkSession, glob: str, sample_bytes: int | None = None) -> DataFrame:
    """Encoding and confidence of every file, judged by all of it, or by its first ``sample_bytes`` bytes. Empty files
    are left out.

    Whole files are read in splits, by lines: no character reaches over a line feed, so a file is what all its lines are.
    A single line may have up to 2 GiB, with ``sample_bytes`` a file.
    """
    if sample_bytes:
        return _sampled(spark, glob, sample_bytes)
    valid = F.is_valid_utf8("value")
    lines = spark.read.text(glob, lineSep="\n").select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"), "value")
    first = F.min(F.when(F.col("split") == 0, F.struct("at", F.hex(F.substring(F.col("value").cast("binary"), 1, 4)).alias("head"))))
    files = lines.groupBy("path").agg(
        F.every(valid).alias("valid"), F.every(valid & (F.char_length("value") == F.octet_length("value"))).alias("plain"),
        first["head"].alias("head"), F.sum(F.octet_length("value") + F.lit(1).cast("long")).alias("bytes"), F.max("size").alias("size"))
    # the reader of lines leaves out a UTF-8 mark, and it is missing from the sum of bytes then
    marked = F.col("bytes") <= F.col("size") - 2
    files = files.withColumn("head", F.when(marked, F.concat(F.lit("EFBBBF"), F.coalesce("head", F.lit("")))).otherwise(F.col("head")))
    return _judged(files, F.col("plain"), F.col("valid"))


def _sampled(spark: SparkSession, glob: str, sample_bytes: int) -> DataFrame:
    files = spark.read.format("binaryFile").load(glob).select("path", "length", F.substring("content", 1, sample_bytes).alias("start"))
    # the sample may end inside a character of up to four bytes
    whole = F.is_valid_utf8(F.col("start").cast("string"))
    valid = whole
    for n in (1, 2, 3):
        shorter = F.substring(F.col("start"), F.lit(1), F.octet_length("start") - n)
        valid = valid | ((F.col("length") > sample_bytes) & F.is_valid_utf8(shorter.cast("string")))
    plain = whole & (F.char_length(F.col("start").cast("string")) == F.octet_length("start"))
    return _judged(files.withColumn("head", F.hex(F.substring("start", 1, 4))), plain, valid)
