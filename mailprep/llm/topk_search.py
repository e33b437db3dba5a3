"""Exact top-k inner products with block-at-a-time pruning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailprep.session import saved

BLOCK = 256            # rows of a document-range block
BLOCKS_PER_SHARD = 64  # blocks that one task holds
QUERIES = 512          # queries that meet a shard at once


def whole(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component, or null for vectors that are null or hold a null or non-finite component."""
    d = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(d, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), F.transform(d, lambda x: F.floor(x * scale)))


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    """Vectors as rows of one matrix; shorter ones are filled up with zeros, which changes no product."""
    out = np.zeros((len(rows), width), "i8")
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def _products(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Exact inner products: in floating point while every sum stays below 2^53, else in whole numbers."""
    if q.size and m.size and float(np.abs(q).max()) * float(np.abs(m).max()) * q.shape[1] < 2 ** 53:
        return (q.astype("f8") @ m.T.astype("f8")).astype("i8")
    return q @ m.T


def search_shard(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, m: np.ndarray, k: int, block: int = BLOCK) -> list:
    """The k best rows of a shard for each query: (query row, id, score).

    The shard's rows are blocks of neighbours. The maxima and minima of every term (component) in a block bound the
    score of any of its rows. A query meets the blocks by falling bound and stops at the first one whose bound is below
    its k-th score. Queries that meet the same block in the same round are scored together through its forward index.
    """
    n_blocks = -(-len(ids) // block)
    edges = np.arange(0, len(ids), block)
    high, low = np.maximum.reduceat(m, edges, axis=0), np.minimum.reduceat(m, edges, axis=0)
    bounds = _products(np.maximum(q, 0), high) + _products(np.minimum(q, 0), low)
    turns = np.argsort(-bounds, axis=1, kind="stable")
    top_s = np.zeros((len(q), 0), "i8")
    top_i = np.zeros((len(q), 0), "i8")
    open_q = np.arange(len(q))
    found: list[tuple[np.ndarray, np.ndarray]] = [(top_i[i], top_s[i]) for i in range(len(q))]
    for turn in range(n_blocks):
        if not len(open_q):
            break
        at = turns[open_q, turn]
        kth = np.array([found[i][1][k - 1] if len(found[i][1]) >= k else np.iinfo("i8").min for i in open_q])
        still = bounds[open_q, at] >= kth
        open_q, at = open_q[still], at[still]
        for b in np.unique(at):
            who = open_q[at == b]
            part = slice(b * block, (b + 1) * block)
            got = _products(q[who], m[part])
            for row, i in zip(got, who):
                other = ids[part] != q_ids[i]
                s, d = np.concatenate([found[i][1], row[other]]), np.concatenate([found[i][0], ids[part][other]])
                if len(s) > 4 * k:  # rows below the k-th score can't come back; ties are settled by the id
                    keep = s >= np.partition(s, -k)[-k]
                    s, d = s[keep], d[keep]
                best = np.lexsort((d, -s))[:k]
                found[i] = d[best], s[best]
    return [(i, d, s) for i in range(len(q)) for d, s in zip(*found[i])]


def top_k(vectors: DataFrame, k: int, is_query: Column, key: str = "vec_id", vector: str = "embedding",
          scale: int = 64) -> DataFrame:
    """(query_id, rank, key, score): the k best other rows of every query row, ties to the smaller key.

    Rows are cut into shards by ranges of the key, queries into groups; every pair of a shard and a group is a task's
    work, and only its k best rows per query leave it. Which shard holds a row does not change the result.
    Null keys and vectors with null or non-finite components take no part. Vectors of other lengths count as filled up
    with zeros. Repeated rows each take a place; a query leaves out all rows of its own key. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    rows = saved(vectors.select(F.col(key).cast("long").alias("id"), whole(F.col(vector), scale).alias("v"),
                                F.coalesce(is_query, F.lit(False)).alias("q"))
                 .filter("id is not null and v is not null"), "vectors")
    n, width = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    size = BLOCK * BLOCKS_PER_SHARD
    shards, groups = max(1, -(-n // size)), max(1, -(-rows.filter("q").count() // QUERIES))
    cuts = rows.agg(F.percentile_approx("id", [i / shards for i in range(1, shards)] or [1.0], 100000)).first()[0] or []
    cuts = sorted(set(cuts)) if shards > 1 else []
    shard = F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]), lambda c: c < F.col("id"))) if cuts else F.lit(0)
    placed = rows.withColumn("shard", shard)
    docs = placed.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"), "shard", "id", "v", F.lit(False).alias("q"))
    asks = rows.filter("q").select(F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("grp"),
                                   F.explode(F.sequence(F.lit(0), F.lit(len(cuts)))).alias("shard"), "id", "v", "q")

    def run(f: pd.DataFrame) -> pd.DataFrame:
        q, d = f[f["q"]].sort_values("id"), f[~f["q"]].sort_values("id")
        q_ids, ids = q["id"].to_numpy("i8"), d["id"].to_numpy("i8")
        got = search_shard(q_ids, _matrix(q["v"], width), ids, _matrix(d["v"], width), k) if len(q) and len(d) else []
        return pd.DataFrame({"query": [q_ids[i] for i, _, _ in got], "id": [x for _, x, _ in got],
                             "score": [s for _, _, s in got], "copy": [i for i, _, _ in got]}).astype("i8")

    found = docs.unionByName(asks).groupBy("grp", "shard").applyInPandas(run, "query long, id long, score long, copy long")
    order = Window.partitionBy("query", "copy").orderBy(F.desc("score"), "id")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select(F.col("query").alias("query_id"), "rank", F.col("id").alias(key), "score")
