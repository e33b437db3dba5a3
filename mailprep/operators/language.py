"""Language detection with a character-trigram model, and the language report.

Training is one map-side combined count. The model is a table with one row per language and trigram. For scoring it has
one row per trigram with the weights of all languages. While that is counted to be small, mails are judged where they
are, and nothing moves; else the trigrams of a sentence meet it under the sentence's number.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailprep import fixed as X
from mailprep.functions import text as tx
from mailprep.functions.dialect import let, percent_text, strip
from mailprep.operators.joins import language_names
from mailprep.session import saved

MAX_LOCAL_WEIGHTS = 16_000_000  # 64 MB; a larger model is joined
STEP_CHARS = 1 << 18            # of sentences that are scored at once; a longer one is taken alone
NO_LETTERS = r"[^\p{L}]+"
SCALE = 10_000                  # weights are whole ten-thousandths, so that sums do not depend on their order


def _plain(c: Column) -> Column:
    """Lower-case letters only; every other run becomes one space."""
    return F.trim(F.regexp_replace(F.lower(c), NO_LETTERS, " "))


def trigrams(plain: Column) -> Column:
    """The trigrams of plain words, each word with a space before and after it."""
    signs = F.split(F.concat(F.lit(" "), plain, F.lit(" ")), "")

    def grams(p: Column) -> Column:
        def gram(first: Column, i: Column) -> Column:
            middle = F.get(p, i + 1)  # a space in the middle would span two words
            return F.when(middle != " ", F.concat(first, middle, F.get(p, i + 2)))

        return F.when(F.size(p) >= 3, F.array_compact(F.transform(F.slice(p, F.lit(1), F.size(p) - 2), gram)))

    return F.coalesce(let(signs, grams), F.array().cast("array<string>"))


def language_model(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """Train: rows (lang, gram, n, total, vocabulary, weight) with weight = ln((n + 1) / (total + vocabulary)), in 1/SCALE.

    ``total`` counts the language's trigrams, ``vocabulary`` the different ones of all languages. Words are counted
    first, so that the trigrams of a word are made once and not at each of its places.
    """
    words = (df.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
             .select(F.col(lang_col).alias("lang"),
                     F.explode(F.split(F.lower(F.col(text_col)), NO_LETTERS)).alias("word"))
             .groupBy("lang", "word").agg(F.count("*").alias("n")))
    seen = saved(words.select("lang", "n", F.explode(trigrams(F.col("word"))).alias("gram"))
                 .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")  # read three times
    totals = seen.groupBy("lang").agg(F.sum("n").alias("total"))
    vocabulary = seen.select("gram").distinct().agg(F.count("*")).scalar()
    return (seen.join(totals, "lang").withColumn("vocabulary", vocabulary)
            .select("lang", "gram", "n", "total", "vocabulary", _weight(F.col("n")).alias("weight")))


def _weight(n: Column | int) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return F.round(F.log((n + 1) / (F.col("total") + F.col("vocabulary"))) * SCALE).cast("int")


def dense_model(model: DataFrame) -> tuple[list[str], list[int], DataFrame]:
    """The languages by name, what a trigram nobody has seen weighs in each, and rows (gram, more): one weight per language
    and trigram, above the one of an unseen trigram."""
    languages = model.groupBy("lang").agg(F.max("total").alias("total"), F.max("vocabulary").alias("vocabulary")).select(
        "lang", _weight(0).alias("unseen")).orderBy("lang").collect()  # one row per language
    names = [r["lang"] for r in languages]
    by_lang = F.map_from_entries(F.collect_list(F.struct("lang", (F.col("weight") - _weight(0)).alias("more"))))
    rows = model.groupBy("gram").agg(by_lang.alias("m")).select(
        "gram", F.array(*[F.coalesce(F.try_element_at("m", F.lit(n)), F.lit(0)) for n in names]).alias("more"))
    return names, [r["unseen"] for r in languages], rows


class LocalModel:
    """A dense model as arrays, to score sentences where they are: trigrams as sorted numbers, weights by trigram."""

    def __init__(self, names: list[str], unseen: list[int], rows: pa.Table):
        texts = rows["gram"].to_pylist()
        fits = [i for i, t in enumerate(texts) if len(t) == 3]
        codes = np.array([(ord(t[0]) << 42) | (ord(t[1]) << 21) | ord(t[2]) for t in (texts[i] for i in fits)], "i8")
        weights = np.array(rows["more"].combine_chunks().flatten(), "i4").reshape(len(texts), len(names))[fits]
        order = np.argsort(codes)
        self.names, self.unseen = np.array([*names, None], object), np.array(unseen, "i8")
        self.codes, self.weights = codes[order], weights[order]

    def scores(self, plain: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of each plain sentence: how many trigrams it has, and its weight sums by language."""
        sizes = np.array([len(t) + 2 for t in plain], "i8")
        signs = np.frombuffer("".join(f" {t} " for t in plain).encode("utf-32-le"), "<u4").astype("i8")
        at = np.flatnonzero(signs[1:-1] != ord(" "))  # a space in the middle would span two words or two sentences
        gram = (signs[at] << 42) | (signs[at + 1] << 21) | signs[at + 2]
        owner = np.repeat(np.arange(len(plain)), sizes)[at]
        count = np.bincount(owner, minlength=len(plain))
        sums = count[:, None] * self.unseen[None, :]
        if len(self.codes):
            place = np.minimum(np.searchsorted(self.codes, gram), len(self.codes) - 1)
            seen = self.codes[place] == gram
            place, owner = place[seen], owner[seen]
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else []
            if len(first):
                sums[owner[first]] += np.add.reduceat(self.weights[place].astype("i8"), first, axis=0)
        return count, sums

    def languages(self, plain: pd.Series) -> pd.Series:
        """The language with the largest sum of each plain sentence, the first by name on a tie; none without a trigram."""
        texts = [t if isinstance(t, str) else "" for t in plain.tolist()]
        best = np.full(len(texts), len(self.names) - 1)
        start, size = 0, 0
        for end, t in enumerate([*texts, None]):
            if t is None or size + len(t) > STEP_CHARS and end > start:
                if end > start and len(self.names) > 1:
                    count, sums = self.scores(texts[start:end])
                    best[start:end] = np.where(count > 0, sums.argmax(1), len(self.names) - 1)
                start, size = end, 0
            size += len(t or "")
        return pd.Series(self.names[best])


def _joined(rows: DataFrame, name: str, number: str, dense: tuple[list[str], list[int], DataFrame]) -> DataFrame:
    """(number, code) of rows (name, number) against a model of any size: a sentence's trigrams are counted under its
    number, meet the model one row each, and their weights are summed by language. No text is exchanged."""
    names, unseen, model = dense
    counted = rows.select(number, F.explode(trigrams(F.col(name))).alias("gram")).groupBy(number, "gram").agg(F.count("*").alias("n"))
    met = counted.join(model, "gram", "left")
    sums = [F.sum(F.col("n") * (F.coalesce(F.get("more", F.lit(i)), F.lit(0)).cast("long") + F.lit(u))) for i, u in enumerate(unseen)]
    by_number = met.groupBy(number).agg(F.array(*sums).alias("sums"))
    best = F.array_position("sums", F.array_max("sums")).cast("int")  # the first of equals
    return by_number.select(number, F.get(F.array(*[F.lit(n) for n in names]), best - 1).alias("code"))


def _with_code(df: DataFrame, text: Column, model: DataFrame, target: str) -> DataFrame:
    """``df`` with the language code of a text, judged by its last full sentence; unknown without any trigram.

    A model of up to ``MAX_LOCAL_WEIGHTS`` weights goes to every task, and rows are judged where they are: nothing is
    exchanged. For a larger one the rows are written once with a number, and codes come back by number.
    """
    name, number = (f"__{x}_{uuid.uuid4().hex}" for x in ("plain", "number"))  # no caller has a column of this name
    rest = [F.col(f"`{c}`") for c in df.columns if c != target]
    plain = F.nullif(_plain(tx.last_valid_sentence(tx.clean_crlf(text))), F.lit(""))
    dense = dense_model(model)
    names, unseen, rows = dense
    unknown = F.lit(X.UNKNOWN_CODE)
    if not names:
        return df.select(*rest, unknown.alias(target))
    if rows.count() * len(names) <= MAX_LOCAL_WEIGHTS:
        local = LocalModel(names, unseen, rows.toArrow())

        @F.pandas_udf("string")
        def code(sentence: pd.Series) -> pd.Series:
            return local.languages(sentence)

        # the explode keeps later filters from running the function again
        return df.select(*rest, F.explode(F.array(F.coalesce(code(plain), unknown))).alias(target))
    # the explode keeps the sentence from being made again at each use
    keyed = saved(df.select("*", F.explode(F.array(plain)).alias(name), F.monotonically_increasing_id().alias(number)), "judged")
    codes = _joined(keyed.select(name, number), name, number, dense)
    return keyed.join(codes, number, "left").select(*rest, F.coalesce("code", unknown).alias(target))


def detect_language(df: DataFrame, model: DataFrame, text_col: str = X.CLEAN_BODY,
                    extra_names: dict[str, str] | None = None) -> DataFrame:
    """Add Language and LangName, judged by the last full sentence of each text.

    ``model`` is read more than once: give a saved table (``language_model`` written with ``saved``).
    """
    if text_col not in df.columns:
        raise ValueError(f"column {text_col!r} not found")
    return language_names(_with_code(df, tx.body_as_text(text_col), model, "Language"), extra=extra_names)


def detect_language_or_unknown(df: DataFrame, model: DataFrame, text_col: str = X.CLEAN_BODY,
                               target: str = "Language") -> DataFrame:
    """Add the language code alone; a blank or missing text is unknown."""
    text = F.col(text_col).cast("string")
    return _with_code(df, F.when(strip(text) != "", text), model, target)


def language_distribution(df: DataFrame, column: str = "LangName", threshold: int = X.OTHER_THRESHOLD) -> DataFrame:
    """Mails per language with their share; languages under ``threshold`` mails are summed up as Other, last."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("name")).count()
    minor = F.col("count") < threshold
    merged = (counts.groupBy(minor.alias("is_other"), F.when(minor, "Other").otherwise(F.col("name")).alias("Language"))
              .agg(F.sum("count").alias("EmailCount")))
    total = F.sum("EmailCount").over(Window.partitionBy())  # one row per reported language
    return (merged.withColumn("Percentage", percent_text(F.col("EmailCount"), total))
            .orderBy("is_other", F.desc("EmailCount"), "Language").drop("is_other"))
