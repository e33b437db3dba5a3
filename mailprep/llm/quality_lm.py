"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailprep.llm.bloom import bloom_of
from mailprep.llm.common import filled, steps
from mailprep.session import saved

ORDER = 5            # bytes of an n-gram; up to 7 fit into a long
HOT_GRAMS = 1 << 17  # that many of the most frequent n-grams go to all tasks; all others meet in a join
STEPS = 1000         # steps of a log-perplexity in which quantiles are counted
FENCE = 3.0          # a document is dropped beyond the trusted third quartile plus so many interquartile ranges
PRIOR = 8            # texts that the quartiles of all languages weigh against those of one
SHORT = 2            # orders up to it have at most 65,536 n-grams, which go to all tasks
MANY = 10_000        # languages up to that many go to all tasks


def grams_of(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams (as whole numbers) that end at each byte of some texts, and how many each text has.

    Texts are lower-cased; zero bytes stand before the first byte. A text has as many n-grams as bytes.
    """
    raw = [t.lower().encode() for t in texts]
    gap = bytes(order - 1)
    data = np.frombuffer(gap + gap.join(raw), "u1").astype("i8")
    lengths = np.array([len(r) for r in raw], "i8")
    n = len(data) - (order - 1)
    gram = np.zeros(max(n, 0), "i8")
    for i in range(order):
        gram = (gram << 8) | data[i:i + max(n, 0)]
    # of the grams that end at each position, those that end in a gap belong to no text
    starts = np.concatenate([[0], np.cumsum(lengths + order - 1)[:-1]]) if len(raw) else np.zeros(0, "i8")
    inside = np.arange(lengths.sum()) + np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) \
        if len(raw) else np.zeros(0, "i8")
    return gram[inside.astype("i8")], lengths


def count_grams(docs: DataFrame, text: str = "text", order: int = ORDER, parts: int = 1, part: Column | None = None) -> DataFrame:
    """(gram, n0, n1, ...): n-gram counts of the texts of each of some ``parts``, ``part`` being the number of a row's part.
    Tasks count their own first."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: list = [None] * parts
        for f in frames:
            for k in range(parts):
                texts = filled(f["_text"][f["_part"] == k])
                for a, b in steps(texts):
                    g, n = np.unique(grams_of(texts[a:b], order)[0], return_counts=True)
                    new = pd.Series(n, g)
                    total[k] = new if total[k] is None else total[k].add(new, fill_value=0)
        for k, t in enumerate(total):
            if t is not None:
                yield pd.DataFrame({"gram": t.index.to_numpy("i8"), "part": k, "n": t.to_numpy("i8")})

    rows = docs.select(F.col(text).alias("_text"), (F.lit(0) if part is None else part).cast("int").alias("_part"))
    own = rows.mapInPandas(run, "gram long, part int, n long")
    return own.groupBy("gram").agg(*[F.sum(F.when(F.col("part") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(parts)])


def _suffix(order: int) -> Column:
    return F.col("gram").bitwiseAND((1 << (8 * order)) - 1)


def _numbers(table: DataFrame) -> range:
    """The numbers of the models whose counts a table holds."""
    return range(sum(c != "gram" for c in table.columns))


def model(counts: DataFrame, order: int = ORDER) -> list[tuple[DataFrame, DataFrame]]:
    """The tables of as many models as ``counts`` has count columns, lowest order first: (gram, less0, ...) and per
    context (ctx, total0, spare0, ...).

    Order n below the highest counts in how many different ways an n-gram continues to the left. ``less`` is the count
    less its discount; ``spare`` is the share of its total that a context leaves to the order below. The three
    discounts of each order and model come from how many n-grams have counts of one to four.
    """
    tables, models, level = [], _numbers(counts), counts
    for n in range(order, 0, -1):
        level = saved(level, f"grams{n}")
        seen = level.agg(*[F.count(F.when(F.col(f"n{k}") == i, 1)).alias(f"{k}_{i}") for k in models for i in (1, 2, 3, 4)]).first()
        off = {}
        for k in models:
            n1, n2, n3, n4 = (seen[f"{k}_{i}"] for i in (1, 2, 3, 4))
            y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5
            # also where small tables leave a class empty, a discount takes something and leaves something
            d = [min(max(i - (i + 1) * y * (b / a) if a else i * 0.5, 0.1), i - 0.1) for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
            c = F.col(f"n{k}")
            off[k] = F.when(c == 0, 0.0).when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2])
        contexts = level.groupBy(F.shiftright("gram", 8).alias("ctx")).agg(
            *[F.sum(f"n{k}").alias(f"total{k}") for k in models],
            *[F.try_divide(F.sum(off[k]), F.sum(f"n{k}")).alias(f"spare{k}") for k in models])
        tables.insert(0, (level.select("gram", *[(F.col(f"n{k}") - off[k]).alias(f"less{k}") for k in models]), contexts))
        level = level.groupBy(_suffix(n - 1).alias("gram")).agg(
            *[F.count(F.when(F.col(f"n{k}") > 0, 1)).alias(f"n{k}") for k in models])
    return tables


def log_probabilities(grams: DataFrame, tables: list, order: int = ORDER) -> DataFrame:
    """(gram, logp0, logp1, ...) of distinct ``grams`` (gram) under each model, by joins with the count tables, all sharded
    by n-gram or context. Each order is written out before the next one.

    p(w | context) = cut + spare * p(w | shorter context), down to a uniform share of the 256 bytes. A context that was
    never seen passes everything on.
    """
    models = _numbers(tables[0][0])
    out = grams.select("gram", *[F.lit(1.0 / 256).alias(f"p{k}") for k in models])
    for n, (seen, contexts) in enumerate(tables, 1):
        if n <= SHORT:
            seen, contexts = F.broadcast(seen), F.broadcast(contexts)
        else:  # sorted on both sides, so that no table of a join comes to the driver
            seen, contexts = seen.hint("merge"), contexts.hint("merge")
        key = F.col("gram").bitwiseAND((1 << (8 * n)) - 1)
        out = out.withColumn("_g", key).withColumn("_c", F.shiftright(key, 8))
        out = out.join(seen.withColumnRenamed("gram", "_g"), "_g", "left")
        out = out.join(contexts.withColumnRenamed("ctx", "_c"), "_c", "left")
        p = [F.coalesce(F.try_divide(f"less{k}", f"total{k}"), F.lit(0.0)) + F.coalesce(f"spare{k}", F.lit(1.0)) * F.col(f"p{k}")
             for k in models]
        out = saved(out.select("gram", *[p[k].alias(f"p{k}") for k in models]), f"grams_p{n}")
    return out.select("gram", *[F.log(f"p{k}").alias(f"logp{k}") for k in models])


def trusted_texts(docs: DataFrame, ids: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(text, lang) of the documents whose key is in ``ids``. A filter of bounded size holds most others back, so that little
    more than the trusted texts moves to the join that decides."""
    hashed = F.xxhash64(F.col(key))
    wanted = docs.sparkSession.sparkContext.broadcast(bloom_of(ids.select(hashed.alias("id")), "id"))

    @F.pandas_udf("boolean")
    def has(column: pd.Series) -> pd.Series:
        return pd.Series(wanted.value.has(column.to_numpy("i8")))

    near = docs.select(key, text, lang).filter(has(hashed))
    return near.join(ids.select(key).distinct(), key, "left_semi").select(text, lang)


def score(docs: DataFrame, trusted: DataFrame, text: str = "text", order: int = ORDER,
          keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all, unless given) with (n_bytes, log_perplexity); a model is made from the
    texts of ``trusted``. Columns of ``docs`` that are named like these two give way to them.

    Null and empty texts have no perplexity. Without trusted text every byte is equally likely. Repeated rows each give
    a row.
    """
    columns = _others(docs.columns if keep is None else keep, ("n_bytes", "log_perplexity"))
    rows = docs.select(F.lit(0).alias("_model"), F.col(text).alias("_text"), *_carried(columns))
    done = _scored(rows, count_grams(trusted, text, order), order)
    return done.select(*_named(columns), F.col("_n").alias("n_bytes"), "log_perplexity")


def _others(columns: list[str], taken: tuple[str, ...]) -> list[str]:
    return [c for c in columns if c.lower() not in taken]


def _carried(columns: list[str]) -> list[Column]:
    return [F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(columns)]


def _named(columns: list[str]) -> list[Column]:
    return [F.col(f"_k{i}").alias(c) for i, c in enumerate(columns)]


def _scored(rows: DataFrame, counts: DataFrame, order: int) -> DataFrame:
    """``rows`` (_model, _text, others) without the text, with (_n, log_perplexity) under the model of the row's number.

    All n-grams of the rows are counted, and their probabilities under all models found in sharded joins. The most
    frequent ones, ``HOT_GRAMS`` at most, go to all tasks as short arrays, so the heavy keys of the next join never move;
    every other n-gram of a document is sent to the shard that holds its probabilities, counted per document.
    """
    spark = rows.sparkSession
    models = _numbers(counts)
    wanted = saved(count_grams(rows, "_text", order), "grams_wanted")
    logs = [f"logp{k}" for k in models]
    known = saved(log_probabilities(wanted, model(counts, order), order).join(wanted.hint("merge"), "gram"), "gram_logp")
    hot = known.orderBy(F.desc("n0"), "gram").limit(HOT_GRAMS).select("gram", *logs).toArrow().sort_by("gram")
    arrays = hot["gram"].to_numpy().astype("i8"), np.stack([hot[c].to_numpy() for c in logs], axis=1).astype("f8")
    shared = spark.sparkContext.broadcast(arrays)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = shared.value
        table = _Lookup(keys)
        for batch in batches:
            ids, which, kept = batch.column(0), batch.column(1), batch.columns[3:]
            numbers = which.to_numpy()
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for a, b in steps(texts):
                g, n = grams_of(texts[a:b], order)
                at = table.find(g)
                found = np.where(at >= 0, values[at, np.repeat(numbers[a:b], n)] if len(values) else 0.0, 0.0)
                ends = np.cumsum(n)
                total = np.concatenate([[0.0], np.cumsum(found)])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), which.slice(a, b - a), pa.array(n), pa.array(total[ends] - total[ends - n]),
                     pa.nulls(b - a, pa.int64()), *[c.slice(a, b - a) for c in kept]], names)
                rest = np.flatnonzero(at < 0)
                if len(rest):
                    pairs = pd.DataFrame({"o": np.repeat(np.arange(a, b), n)[rest], "g": g[rest]}).value_counts().reset_index()
                    owner = pa.array(pairs["o"].to_numpy("i8"))
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(owner), which.take(owner), pa.array(pairs["count"].to_numpy("i8")),
                         pa.nulls(len(pairs), pa.float64()), pa.array(pairs["g"].to_numpy("i8")),
                         *[pa.nulls(len(pairs), c.type) for c in kept]], names)

    # the row number is fixed by writing it with the row's other columns
    rows = rows.select(F.monotonically_increasing_id().alias("_id"), F.col("_model").cast("int").alias("_model"), "_text",
                       *[c for c in rows.columns if c not in ("_model", "_text")])
    made = T.StructType([T.StructField("_id", T.LongType()), T.StructField("_model", T.IntegerType()),
                         T.StructField("_n", T.LongType()), T.StructField("_sum", T.DoubleType()),
                         T.StructField("_gram", T.LongType()), *rows.schema.fields[3:]])
    names = made.names
    parts = saved(rows.mapInArrow(run, made), "doc_grams")
    own = F.coalesce(*[F.when(F.col("_model") == k, F.col(f"logp{k}")) for k in models])
    rare = (parts.filter("_gram is not null").select("_id", "_model", "_n", "_gram")
            .join(known.select(F.col("gram").alias("_gram"), *logs).hint("merge"), "_gram")
            .groupBy("_id").agg(F.sum(F.col("_n") * own).alias("_rare")))
    done = parts.filter("_gram is null").join(rare.hint("merge"), "_id", "left")
    total = F.col("_sum") + F.coalesce("_rare", F.lit(0.0))
    entropy = F.when(F.col("_n") > 0, F.round(-total / F.col("_n"), 9))
    return done.select("_model", *names[5:], "_n", entropy.alias("log_perplexity"))


class _Lookup:
    """Places of whole numbers in a sorted array, through a table of hashed slots."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.shift = np.uint64(64 - max(4, int(np.ceil(np.log2(max(len(keys), 1)))) + 3))
        self.slots = np.full(1 << (64 - int(self.shift)), -1, "i4")
        self.slots[self._hash(keys)] = np.arange(len(keys), dtype="i4")

    def _hash(self, g: np.ndarray) -> np.ndarray:
        return (g.astype("u8") * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def find(self, g: np.ndarray) -> np.ndarray:
        """The place of each number, -1 for those that are not in the array."""
        if not len(self.keys):
            return np.full(len(g), -1, "i4")
        at = self.slots[self._hash(g)]
        missed = np.flatnonzero((at < 0) | (self.keys[at] != g))
        if len(missed):  # another key took the slot, or there is none
            place = np.minimum(np.searchsorted(self.keys, g[missed]), len(self.keys) - 1)
            at[missed] = np.where(self.keys[place] == g[missed], place, -1)
        return at


def quartiles(scored: DataFrame, lang: str = "lang") -> DataFrame:
    """(_lang, _low, _high, _texts): the quartiles of the log-perplexity per language, as the upper ends of their steps,
    and how many texts they come from.

    Texts are counted per step first, so a language that holds most of them is a few thousand counts.
    """
    bins = (scored.filter("log_perplexity is not null")
            .groupBy(F.col(lang).alias("_lang"), F.ceil(F.col("log_perplexity") * STEPS).alias("bin")).agg(F.count("*").alias("n")))
    upto = F.sum("n").over(Window.partitionBy("_lang").orderBy("bin"))
    total = F.sum("n").over(Window.partitionBy("_lang"))
    at = bins.select("_lang", "bin", "n", (upto / total).alias("share"))
    return at.groupBy("_lang").agg((F.min(F.when(F.col("share") >= 0.25, F.col("bin"))) / STEPS).alias("_low"),
                                   (F.min(F.when(F.col("share") >= 0.75, F.col("bin"))) / STEPS).alias("_high"),
                                   F.sum("n").alias("_texts"))


def thresholds(held: DataFrame, lang: str = "lang") -> tuple[DataFrame, float | None]:
    """(_lang, _top) of the languages of ``held`` (language, log_perplexity), and the threshold of all its texts together,
    None without any: the third quartile plus ``FENCE`` interquartile ranges.

    Where those of all texts are larger, a language's third quartile and range are drawn towards them, by the weight of
    ``PRIOR`` texts against its own: one rule at every size, which never takes a language below its own fence.
    """
    every = quartiles(held.withColumn(lang, F.lit(None).cast("string")), lang).first()
    if every is None:
        return quartiles(held, lang).select("_lang", F.lit(None).cast("double").alias("_top")), None
    weight = F.lit(float(PRIOR)) / (F.col("_texts") + PRIOR)

    def drawn(own: Column, of_all: float) -> Column:
        return own + F.greatest(F.lit(of_all) - own, F.lit(0.0)) * weight

    high, spread = every["_high"], every["_high"] - every["_low"]
    top = drawn(F.col("_high"), high) + drawn(F.col("_high") - F.col("_low"), spread) * FENCE
    return quartiles(held, lang).select("_lang", top.alias("_top")), high + spread * FENCE


def judge(docs: DataFrame, trusted: DataFrame, text: str = "text", lang: str = "lang",
          keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all, unless given) with (n_bytes, perplexity, threshold, keep). ``trusted`` has
    texts and their languages. Columns of ``docs`` that are named like these four give way to them.

    A language's threshold comes from the log-perplexities of its trusted texts (``thresholds``), each half of which is
    judged by a model of the other half; copies of a text are in one half, so no text is judged by a model that has read
    it, and no share of junk in ``docs`` moves the threshold. A language without trusted texts has the threshold of all
    trusted texts. Documents above it go, and so do null and empty texts, which have no perplexity. Without trusted text
    there is no threshold, and all other documents stay. Null languages are one language.

    The three models (all trusted texts, either half) are counted, joined and applied together.
    """
    columns = _others(docs.columns if keep is None else keep, ("n_bytes", "perplexity", "threshold", "keep"))
    half = F.pmod(F.xxhash64(text), F.lit(2))
    trusted = saved(trusted.filter(F.length(text) > 0).select(F.col(text).alias("_text"), F.col(lang).alias("_lang"),
                                                              half.cast("int").alias("_half")), "trusted")
    counts = count_grams(trusted, "_text", ORDER, 2, F.col("_half"))
    counts = counts.select("gram", (F.col("n0") + F.col("n1")).alias("n0"), F.col("n0").alias("n1"), F.col("n1").alias("n2"))
    rows = docs.select(F.lit(0).alias("_model"), F.col(text).alias("_text"), F.col(lang).alias("_lang"), *_carried(columns))
    other = F.when(F.col("_half") == 0, 2).otherwise(1)  # the model of the half that a text is not in
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields[3:]]
    every = rows.union(trusted.select(other.alias("_model"), "_text", "_lang", *blank))
    done = saved(_scored(every, counts, ORDER), "perplexity")
    limits, overall = thresholds(done.filter("_model > 0").select("_lang", "log_perplexity"), "_lang")
    limits = F.broadcast(limits) if limits.count() <= MANY else limits
    scored = done.filter("_model = 0").withColumnRenamed("_lang", "_own")
    top = F.coalesce("_top", F.lit(overall).cast("double"))
    stays = F.col("log_perplexity").isNotNull() & (top.isNull() | (F.col("log_perplexity") <= top))
    return (scored.join(limits, F.col("_own").eqNullSafe(F.col("_lang")), "left")
            .select(*_named(columns), F.col("_n").alias("n_bytes"), F.exp("log_perplexity").alias("perplexity"),
                    F.exp(top).alias("threshold"), F.coalesce(stays, F.lit(False)).alias("keep")))
