"""Language identification with error-correcting output codes over character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailprep.llm.common import filled, give_back, steps

CELLS_LOG2 = 16            # n-grams are hashed into this many cells; bounds the model
ORDERS = (1, 2, 3)         # n-gram lengths
MAX_TRAIN_ROWS = 40_000    # the model is fitted on a hash-drawn sample of about this many labelled rows at most
BITS_PER_DOUBLING = 10     # codeword length of many languages, in units of log2(languages)
SHARED = 0.01              # share of the languages' common distribution in each of them: unseen n-grams tell nothing
AMBIGUOUS = 0.5            # a best score up to this is flagged
GAP_SHARE = 0.5            # the gap between the nearest codewords that scores AMBIGUOUS, as a share of the usual gap
STEP_CHARS = 1 << 15       # text that is scored at once; every n-gram of it takes a row of weights
NONE = "und"
LETTER = regex.compile(r"\p{L}")
_FACTORS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], "u4")


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """A k x bits matrix of +1 and -1, rows far apart: all splits up to seven languages, drawn ones beyond."""
    if k < 2:
        return np.ones((k, 1), "i1")
    if k <= 7:
        splits = np.arange(1, 1 << (k - 1))
        return np.where((splits[None, :] >> np.arange(k)[:, None]) & 1, 1, -1).astype("i1")
    draw, best = np.random.default_rng(seed), None
    bits = int(np.ceil(BITS_PER_DOUBLING * np.log2(k)))
    for _ in range(50):
        c = np.where(draw.random((k, bits)) < 0.5, 1, -1).astype("i1")
        near = (c.astype(int) @ c.T.astype(int))[~np.eye(k, dtype=bool)].max()
        if abs(c.sum(axis=0)).max() < k and (best is None or near < best[0]):
            best = (near, c)
    return best[1]


def cells_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Cells of all n-grams of some texts, and where each text begins in that row; every text has at least one cell.

    Texts are lower-cased, digits are one sign and the texts are set off by so many line feeds that n-grams know their
    ends and none holds signs of two texts.
    """
    gap = "\n" * (max(ORDERS) - 1)
    lower = [t.lower() for t in texts]
    codes = np.frombuffer(gap.join(["", *lower, ""]).encode("utf-32-le"), "<u4")
    lengths = np.array([len(t) + len(gap) for t in lower])
    codes = np.where((codes >= 48) & (codes <= 57), np.uint32(48), codes)
    n, mix, out = len(codes), np.zeros(len(codes), "u4"), []
    for order in ORDERS:
        mix = mix[:n - order + 1] * np.uint32(31) + codes[order - 1:] * _FACTORS[order - 1]
        cells = (mix * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - CELLS_LOG2)
        out.append(np.concatenate([cells, np.zeros(n - len(cells), "u4")]))
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    # every position carries its n-grams of all lengths
    return np.stack(out, axis=1)[:lengths.sum()], starts


def _drawn(n_rows: int, key: Column, limit: int) -> Column:
    """Whether a row is in the sample: a share of the rows by a hash of the key, about ``limit`` rows at any size."""
    share = min(1.0, limit / max(1, n_rows))
    return F.pmod(F.xxhash64(key), F.lit(1 << 20)) < int(share * (1 << 20))


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        max_rows: int = MAX_TRAIN_ROWS) -> dict:
    """A model from labelled rows; rows without text or label are left out. No rows: a model of no language.

    Tasks add up n-gram counts per language; a model has languages x 2^16 counts. Every bit of the codewords is a
    binary naive Bayes classifier: languages with +1 against those with -1.
    """
    rows = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).filter(
        "text is not null and lang is not null")
    rows = rows.filter(_drawn(rows.count(), F.col("key").cast("string"), max_rows))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for f in frames:
            for name, group in f.groupby("lang"):
                texts = group["text"].tolist()
                total = sums.setdefault(name, np.zeros(1 << CELLS_LOG2, "i8"))
                for a, b in steps(texts):
                    total += np.bincount(cells_of(texts[a:b])[0].ravel(), minlength=1 << CELLS_LOG2)
        for name, total in sums.items():
            at = np.flatnonzero(total)
            yield pd.DataFrame({"lang": name, "cell": at, "n": total[at]})
        give_back()

    counts = (rows.mapInPandas(count, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
              .toPandas())
    langs = sorted(counts["lang"].unique())
    c = np.zeros((len(langs), 1 << CELLS_LOG2))
    c[pd.Categorical(counts["lang"], langs).codes, counts["cell"].astype(int)] = counts["n"]
    model = weighted(langs, c)
    return model | {"gap": usual_gap(rows, model)} if len(langs) > 1 else model


def weighted(langs: list[str], c: np.ndarray) -> dict:
    """The model of n-gram counts ``c`` (languages x cells), without its usual gap."""
    code = codewords(len(langs))
    if not langs:
        return {"langs": langs, "code": code, "weights": np.zeros((1 << CELLS_LOG2, 0), "f4"), "trust": np.zeros(0), "scale": np.zeros(0)}
    own = c / np.maximum(c.sum(axis=1, keepdims=True), 1)
    common = 0.999 * own.mean(axis=0) + 0.001 / c.shape[1]
    per_lang = (1 - SHARED) * own + SHARED * common
    weights = np.zeros((1 << CELLS_LOG2, code.shape[1]), "f4")
    for b in range(code.shape[1]):
        up, down = code[:, b] > 0, code[:, b] < 0
        if up.any() and down.any():
            weights[:, b] = np.log(per_lang[up].mean(axis=0)) - np.log(per_lang[down].mean(axis=0))
    # how far a bit tells its languages apart decides its weight in decoding, and is the unit of its margins
    scale = np.maximum((own @ weights * code).min(axis=0), 1e-3)
    return {"langs": langs, "code": code, "weights": weights, "trust": scale / scale.sum(), "scale": scale}


def decoded(model: dict, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The best language's index, by the weighted logistic loss of the bits against each codeword, and how far the loss
    of the second best is from it. Margins are means over the n-grams, so they do not grow with the text."""
    cells, starts = cells_of(texts)
    per_place = model["weights"][cells[:, 0]] + model["weights"][cells[:, 1]] + model["weights"][cells[:, 2]]
    sums = np.add.reduceat(per_place, starts, axis=0, dtype="f8")
    means = sums / (len(ORDERS) * np.diff(np.append(starts, len(cells))))[:, None]
    margins = means / model["scale"]
    loss = (np.logaddexp(0, -margins[:, None, :] * model["code"][None, :, :]) * model["trust"]).sum(axis=2)
    near = np.sort(loss, axis=1)
    return loss.argmin(axis=1), near[:, 1] - near[:, 0]


def usual_gap(rows: DataFrame, model: dict) -> float:
    """The median gap between the two nearest codewords over the labelled rows of the fit."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            texts = [t for t in f["text"] if LETTER.search(t)]
            for a, b in steps(texts, STEP_CHARS):
                yield pd.DataFrame({"gap": decoded(shared.value, texts[a:b])[1]})
        give_back()

    seen = rows.select("text").mapInPandas(run, "gap double").toPandas()["gap"]
    return float(seen.median()) if len(seen) else 0.0


def scores(model: dict, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The best language's index and its score: 0 where the two nearest codewords are equally far, ``AMBIGUOUS`` where
    the gap between them is ``GAP_SHARE`` of the usual one, towards 1 beyond."""
    if len(model["langs"]) < 2 or not texts:
        return np.zeros(len(texts), int), np.ones(len(texts))
    best, gap = decoded(model, texts)
    return best, 1 - (1 - AMBIGUOUS) ** (gap / max(model["gap"] * GAP_SHARE, 1e-9))


def identify(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with (lang_pred, lang_score, ambiguous), which replace columns of these names.

    Only the text is looked at, the whole of it. Null texts and texts without a letter get ``und`` and score 0, as do
    all texts under a model of no language; they are ambiguous. Repeated rows get the same answer, an empty table an
    empty result. The model has a fixed number of cells, so it goes to all tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, lang_score double")
    def told(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in map(filled, columns):
            pred, score = np.full(len(texts), NONE, object), np.zeros(len(texts))
            at = np.array([i for i, t in enumerate(texts) if m["langs"] and LETTER.search(t)], int)
            some = [texts[i] for i in at]
            for a, b in steps(some, STEP_CHARS):
                best, value = scores(m, some[a:b])
                pred[at[a:b]], score[at[a:b]] = [m["langs"][i] for i in best], value
            yield pd.DataFrame({"lang_pred": pred, "lang_score": score})
        give_back()

    out = docs.drop("lang_pred", "lang_score", "ambiguous").withColumn("_told", told(F.col(text)))
    return (out.withColumn("lang_pred", F.col("_told.lang_pred")).withColumn("lang_score", F.col("_told.lang_score"))
            .drop("_told").withColumn("ambiguous", F.col("lang_score") <= AMBIGUOUS))
