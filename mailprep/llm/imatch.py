"""I-Match fingerprints over several randomised lexicon subsets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailprep.llm.common import filled

SHARES = tuple(range(1, 12))   # subsets keep one term in 2^share
PER_SHARE = 8                  # subsets of each share
LEAST_SEEN = 3                 # so many subsets of a share must hold a term for the share to speak alone
MIN_SHARE, MAX_SHARE = 0.002, 0.2  # band of the document frequency, as shares of all documents
PARTS_PER_TASK = 4


def terms(text: str) -> list[int]:
    """The distinct words of a text, as sorted 64-bit hashes."""
    return sorted(map(xxhash.xxh64_intdigest, set(text.lower().encode().split())))


def lexicon(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Terms in the band of document frequencies, as sorted hashes.

    All documents count. Tasks count their own first and send each shard sorted arrays of hashes and counts.
    A document of w distinct words adds w to the sum of all frequencies, and each term here takes at least
    ``MIN_SHARE`` of the documents, so there are at most (mean distinct words / MIN_SHARE) terms at any corpus size:
    the list may go to the driver and to all tasks.
    """
    n_docs = docs.count()
    low, high = max(2, MIN_SHARE * n_docs), MAX_SHARE * n_docs
    shards = min(1 << 15, PARTS_PER_TASK * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            counts: dict[bytes, int] = {}
            for t in filled(f[text]):
                for w in set(t.lower().encode().split()):
                    counts[w] = counts.get(w, 0) + 1
            h = np.fromiter(map(xxhash.xxh64_intdigest, counts), "u8", len(counts))
            order = np.argsort(h)
            h, n = h[order], np.fromiter(counts.values(), "u4", len(counts))[order]
            shard = (h >> np.uint64(48)).astype("i8") * shards >> 16
            edges = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(h) else [0]
            yield pd.DataFrame([(int(shard[a]), h[a:b].tobytes(), n[a:b].tobytes()) for a, b in zip(edges[:-1], edges[1:])],
                               columns=["shard", "term", "n"])

    def count(f: pd.DataFrame) -> pd.DataFrame:
        h, at = np.unique(np.concatenate([np.frombuffer(x, "<u8") for x in f["term"]]), return_inverse=True)
        n = np.bincount(at, np.concatenate([np.frombuffer(x, "<u4") for x in f["n"]]))
        return pd.DataFrame({"term": h[(n >= low) & (n <= high)].view("i8")})

    sent = docs.select(text).mapInPandas(send, "shard int, term binary, n binary")
    rows = sent.groupBy("shard").applyInPandas(count, "term long").toPandas()
    return np.sort(rows["term"].to_numpy("i8").view("u8"))


class Fingerprints:
    """Fingerprints of texts: per subset of the lexicon, a hash of the text's terms in it, or 0 if it has none."""

    def __init__(self, lexicon: np.ndarray):
        self.place = {t: i for i, t in enumerate(lexicon.tolist())}
        self.hashes, self.member = lexicon, self._drawn(lexicon)

    @staticmethod
    def _drawn(hashes: np.ndarray) -> np.ndarray:
        """Per term, its membership of each subset, drawn from the hash and the subset's number."""
        columns = [s for s in SHARES for _ in range(PER_SHARE)]
        member = np.zeros((len(hashes), len(columns)), bool)
        for j, share in enumerate(columns):
            drawn = (hashes ^ np.uint64(j + 1)) * np.uint64(0x9E3779B97F4A7C15)
            drawn = (drawn ^ drawn >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
            member[:, j] = drawn >> np.uint64(64 - share) == 0
        return member

    def of(self, text: str) -> np.ndarray:
        """A text without a term of the lexicon is told by all its words, and one without words by zeros alone."""
        words = terms(text)
        at = [i for i in map(self.place.get, words) if i is not None]
        hashes = self.hashes[at] if at else np.array(words, "u8")
        member = self.member[at] if at else self._drawn(hashes)
        # the sorted distinct terms are chained: each hash is turned by the count of terms before it in the subset
        turned = hashes[:, None] * (2 * np.cumsum(member, axis=0, dtype="u8") + np.uint64(1))
        turned ^= turned >> np.uint64(29)
        return (np.where(member, turned, np.uint64(0))).sum(axis=0, dtype="u8")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal hashes among the subsets in which either text has a term: overall, or in the share of subsets that
    agrees most. Small subsets tell how much two texts have in common, large ones whether they differ at all. Texts
    without any term are alike."""
    seen = (a != 0) | (b != 0)
    if not seen.any():
        return 1.0
    equal = ((a == b) & seen).reshape(len(SHARES), PER_SHARE).sum(axis=1)
    seen = seen.reshape(len(SHARES), PER_SHARE).sum(axis=1)
    enough = seen >= LEAST_SEEN
    return float(max([equal.sum() / seen.sum(), *(equal[enough] / seen[enough])]))


def edited(text: str, following: str) -> str:
    """The text with its last half (rounded down) replaced by as much of the start of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _in_order(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, int | None]:
    """Rows (part, key, text, extra): parts are ranges of the key, and each but the last ends with a copy (extra) of the
    first row of the next one; the last ends with a copy of the very first row. Nulls come first."""
    spark = docs.sparkSession
    n = PARTS_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = isinstance(docs.schema[key].dataType, T.IntegralType)
    rows = docs.select((F.col(key).cast("long") if whole else F.col(key)).alias("key"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType
    if whole:
        cuts = rows.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 10000)).first()[0] or []
    else:  # any ordered key: the least one of each range that the engine would make
        ranges = rows.select("key").filter("key is not null").repartitionByRange(n, "key")
        cuts = [r["least"] for r in ranges.groupBy(F.spark_partition_id()).agg(F.min("key").alias("least")).collect()]
    cuts = sorted(set(cuts))
    # the number of cuts that a key lies above
    part = F.lit(0)
    if cuts:
        array = F.array(*[F.lit(c).cast(kind) for c in cuts])
        part = F.coalesce(F.size(F.filter(array, lambda c: c < F.col("key"))), F.lit(0))
    rows = rows.withColumn("part", part)
    firsts = {r["part"]: r["first"] for r in
              rows.groupBy("part").agg(F.min(F.struct("key"))["key"].alias("first")).collect()}
    parts = sorted(firsts)
    copies = [F.when((F.col("part") == p) & F.col("key").eqNullSafe(F.lit(firsts[p]).cast(kind)), F.lit(q))
              for p, q in zip(parts, [parts[-1]] + parts[:-1])] if parts else []
    to = F.coalesce(*copies) if copies else F.lit(None).cast("int")
    out = rows.select("key", "text", F.inline(F.array(F.struct(F.col("part"), F.lit(False).alias("extra")),
                                                      F.struct(to.alias("part"), F.lit(True).alias("extra")))))
    return out.filter("part is not null"), n


def fingerprint(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are to each other and to the next one's.

    Returns (key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next). Documents follow
    each other by key, null first, equal keys by text. One shuffle sends the texts to ranges of keys; a range also gets
    the first row of the next. A lone document follows itself. Null text is empty; all empty texts share a
    fingerprint. An empty table gives an empty result. The key has any ordered type; whole numbers come back as long.
    """
    words = lexicon(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(words)
    rows, n = _in_order(docs, key, text)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool, last = Fingerprints(shared.value), None  # last: the row that waits for its successor
        for f in frames:
            out = []
            for part, k, t, extra in zip(f["part"], f["key"], f["text"], f["extra"]):
                if last and last[0] == part:
                    changed = edited(last[2], t)
                    own, other, after = last[3], tool.of(changed), tool.of(t)
                    out.append((last[1], len(last[2]), hashlib.sha256(changed.encode()).hexdigest(), own.tobytes().hex(),
                                other.tobytes().hex(), likeness(own, other), likeness(own, after)))
                    last = None if extra else (part, k, t, after)
                else:
                    last = None if extra else (part, k, t, tool.of(t))
            done = pd.DataFrame(out, columns=["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                              "near_edited", "near_next"])
            yield done.astype({"key": "Int64"}) if kind == "bigint" else done

    kind = rows.schema["key"].dataType.simpleString()
    schema = (f"key {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    done = (rows.repartition(n, "part").sortWithinPartitions("part", "extra", F.asc_nulls_first("key"), "text")
            .mapInPandas(run, schema))
    return done.withColumnRenamed("key", key)
