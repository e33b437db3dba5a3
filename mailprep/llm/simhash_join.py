"""Near-duplicate groups by SimHash, with fingerprints compared in bit slices.

Fingerprints that differ in few bits agree in one band of bits and meet in its bucket. There they lie as 64 bit planes,
one word for the same bit of 64 fingerprints; a fingerprint meets a word of others at once, and carry-save counters of
three bits hold the 64 distances. Words whose distances all exceed the radius are left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailprep.llm.common import components, filled, steps
from mailprep.session import broadcast_if_small, saved

WORDS = 4               # of a shingle
SEED = 42
BITS = 64
RADIUS = 4              # fingerprints link up to so many differing bits; the counters hold up to 7
TILE = 4096             # fingerprints of a bucket that are compared in one go; larger ones are dealt out
DEPTH = 3               # a bucket that stays larger is split by further bands so often
MAX_BROADCAST = 200_000
STEP_WORDS = 1 << 16    # shingles that are hashed before their bits are counted
SPLIT_BYTES = 1 << 20
SLICE = 1 << 17         # (fingerprint, word) meetings at a time
CHECKS = 8              # planes between two looks at which words are still of use
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


# --- fingerprints -------------------------------------------------------------------------------------------

def _words(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text, A-Z as a-z, in lists of bounded size; each begins with the last three of the one before."""
    start, kept = 0, []
    while start < len(raw):
        stop = start + SPLIT_BYTES
        while stop < len(raw) and raw[stop] not in b" \t\n\v\f\r":
            stop += 1
        kept = kept + raw[start:stop].lower().split()
        yield kept
        start, kept = stop, kept[-(WORDS - 1):]


def fingerprint(text: str) -> int:
    """The SimHash of a text's 4-word shingles, repeats included: a bit is set that over half of their hashes have.

    Fewer words make one shingle of the whole sequence; no words make zero.
    """
    ones, total, short = np.zeros(BITS, "i8"), 0, []
    for ws in _words(text.encode()):
        short = ws
        if len(ws) < WORDS:
            continue
        joined = b" ".join(ws)
        ends = np.cumsum(np.fromiter(map(len, ws), "i8", len(ws)) + 1) - 1
        starts = np.concatenate([[0], ends[:-WORDS] + 1]).tolist()
        stops = ends[WORDS - 1:].tolist()
        for at in range(0, len(starts), STEP_WORDS):
            hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[at:at + STEP_WORDS], stops[at:at + STEP_WORDS])]
            ones += _count(hashes)
            total += len(hashes)
    if not total and short:
        ones, total = _count([xxhash.xxh64_intdigest(b" ".join(short), SEED)]), 1
    return int(np.packbits(2 * ones > total).view(">u8")[0])


def _count(hashes: list[int]) -> np.ndarray:
    """How many hashes have each bit, the highest first."""
    bits = np.unpackbits(np.array(hashes, ">u8").view("u1")).reshape(-1, BITS)
    return bits.sum(0, dtype="i8")


def fingerprints(docs: DataFrame, text: str = "text", target: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each text as a long instead of the text; a column ``target`` is replaced."""
    rest = [c for c in docs.columns if c not in (text, target)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            texts = filled(f["text"])
            for a, b in steps(texts):
                prints = np.array([fingerprint(t) for t in texts[a:b]], "u8").view("i8")
                yield f.iloc[a:b][["row"]].assign(value=prints)

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest] or [F.lit(0).alias("_")]).alias("row"),
                       F.col(f"`{text}`").cast("string").alias("text"))
    done = rows.mapInPandas(run, f"row {rows.schema['row'].dataType.simpleString()}, value long")
    return done.select(*[F.col(f"row.`{c}`").alias(c) for c in rest], F.col("value").alias(target))


# --- comparison ---------------------------------------------------------------------------------------------

def _planes(prints: np.ndarray) -> np.ndarray:
    """The bits of a multiple of 64 fingerprints as (64 planes, words): bit i of a word is that of its i-th one."""
    bits = np.unpackbits(prints.astype(">u8").view("u1")).reshape(-1, 64, BITS)
    rows = np.ascontiguousarray(bits.transpose(2, 0, 1))
    return np.packbits(rows, axis=2, bitorder="little").reshape(BITS, -1).view("<u8")


def near(planes: np.ndarray, lanes: np.ndarray, prints: np.ndarray, who: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, ...]:
    """Which fingerprints ``prints[who]`` come near which lanes of the ``word`` they meet: (who, word, lanes) of the
    meetings with a lane within the radius. ``lanes`` tells the lanes of a word that are in use."""
    one = np.zeros(len(who), "u8")
    two, four, over = one.copy(), one.copy(), ~lanes[word]
    for p in range(BITS):
        own = (prints[who] >> np.uint64(BITS - 1 - p)) & np.uint64(1)
        carry = planes[p][word] ^ (np.uint64(0) - own)
        one, carry = one ^ carry, one & carry
        two, carry = two ^ carry, two & carry
        four, carry = four ^ carry, four & carry
        over |= carry | (four & (two | one))  # beyond 7, or 5 to 7
        if p % CHECKS == CHECKS - 1 and p > 2 * CHECKS:
            left = np.flatnonzero(over != _ALL)
            if len(left) < len(who):
                who, word, one, two, four, over = (x[left] for x in (who, word, one, two, four, over))
    return who, word, ~over


def _roots(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining a and b: the smallest index of each group."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return label
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (label[label] != label).any():
            label = label[label]


def tied(buckets: np.ndarray, prints: np.ndarray, queries: np.ndarray | None = None) -> np.ndarray:
    """Rows (a, b) of fingerprints that tie those of a bucket together as far as links between them do.

    All pairs of a bucket are compared; with ``queries`` only those with one of the marked ones. A group of n gets
    n - 1 rows, however many links it has.
    """
    order = np.lexsort((prints, buckets))
    buckets, prints = buckets[order], prints[order]
    start = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
    size = np.diff(np.append(start, len(buckets)))
    n_words = -(-size // 64)
    first = np.cumsum(n_words) - n_words
    place = np.repeat(first * 64 - start, size) + np.arange(len(prints))  # of each in the padded lanes
    padded, member = np.zeros(64 * n_words.sum(), "u8"), np.zeros(64 * n_words.sum(), "i8")
    padded[place], member[place] = prints, np.arange(len(prints))
    used = np.zeros(len(padded), "u1")
    used[place] = 1
    lanes = np.packbits(used.reshape(-1, 64), axis=1, bitorder="little").view("<u8").ravel()
    planes = _planes(padded)
    asks = np.flatnonzero(np.repeat(size, size) > 1)
    if queries is not None:
        asks = asks[queries[order][asks]]
    meets, words = np.repeat(n_words, size)[asks], np.repeat(first, size)[asks]
    label, at = np.arange(len(prints)), 0
    bound = np.cumsum(meets)
    while at < len(asks):
        done = bound[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(bound, done + SLICE, "right")))
        m = meets[at:stop]
        who = np.repeat(asks[at:stop], m)
        word = np.repeat(words[at:stop] - (np.cumsum(m) - m), m) + np.arange(len(who))
        who, word, hits = near(planes, lanes, prints, who, word)
        for part in range(0, len(who), SLICE // 64):
            w, k, h = (x[part:part + SLICE // 64] for x in (who, word, hits))
            i, lane = np.nonzero(np.unpackbits(h.view("u1").reshape(-1, 8), axis=1, bitorder="little"))
            a, b = w[i], member[64 * k[i] + lane]
            label = _roots(label, a[a != b], b[a != b])
        at = stop
    joined = np.flatnonzero(label != np.arange(len(prints)))
    return np.stack([prints[label[joined]], prints[joined]], 1).view("i8")


# --- the join -----------------------------------------------------------------------------------------------

def bands(used: int) -> list[int]:
    """The bits of ``used`` and one band more, per band: the other bits, dealt out to RADIUS + 1 bands.

    Fingerprints that agree on ``used`` and differ in at most RADIUS bits agree on one of these, too.
    """
    free = [i for i in range(BITS) if not used >> i & 1]
    return [used | sum(1 << i for i in free[j::RADIUS + 1]) for j in range(RADIUS + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _in_bands(rows: DataFrame, masks: list[int]) -> DataFrame:
    """Rows (mask, value, fp) of rows (mask, fp): a bucket is a mask and the bits that its fingerprints have there."""
    finer = F.create_map(*[x for m in masks for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(b)) for b in bands(m)]))])
    return rows.select("fp", F.explode(finer[F.col("mask")]).alias("mask")).select(
        "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp")


def _compared(rows: DataFrame, count: int, *group: str) -> DataFrame:
    """(a, b) that tie the fingerprints of each group of rows (..., fp, asks) that links tie. ``asks`` marks those that
    meet all others."""
    spark = rows.sparkSession
    shards = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), count // (8 * TILE))

    def run(f: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(tied(f["bucket"].to_numpy("i8"), f["fp"].to_numpy("i8").view("u8"), f["asks"].to_numpy("?")), columns=["a", "b"])

    bucket = F.xxhash64(*group)  # two buckets of one number are compared as one, which finds no wrong link
    dealt = rows.select(bucket.alias("bucket"), "fp", "asks").withColumn("shard", F.pmod("bucket", F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(run, "a long, b long")


def links(prints: DataFrame, name: str = "simhash") -> DataFrame:
    """(node, component) of the distinct fingerprints of ``prints`` (fp) that have a link, as ``components`` gives them.

    A bucket of more than ``TILE`` fingerprints is dealt over several tiles, each of which ties what it can. If several
    groups are left in it then, it is cut by further bands, and at the last level all that are not in its largest group
    meet all others.
    """
    rows, masks, found = prints.withColumn("mask", F.lit(0).cast("long")), [0], None
    for level in range(DEPTH):
        rows = saved(_in_bands(rows, masks), f"{name}_buckets")
        masks = [b for m in masks for b in bands(m)]
        sizes = rows.groupBy("mask", "value").agg(F.count("*").alias("m")).filter(F.col("m") > TILE)
        hot = saved(sizes, f"{name}_hot")
        tiles = F.coalesce(F.ceil(F.col("m") / TILE), F.lit(1))
        dealt = rows.join(broadcast_if_small(hot, MAX_BROADCAST), ["mask", "value"], "left").withColumn(
            "tile", F.pmod(F.xxhash64("fp", F.lit(level)), tiles))
        met = saved(_compared(dealt.withColumn("asks", F.lit(True)), rows.count(), "mask", "value", "tile"), f"{name}_links")
        found = met if found is None else found.union(met)
        groups = components(found, f"{name}_groups")
        named = (rows.join(broadcast_if_small(hot, MAX_BROADCAST), ["mask", "value"])
                 .join(groups.withColumnRenamed("node", "fp"), "fp", "left")
                 .withColumn("grp", F.coalesce("component", "fp")))
        mixed = named.groupBy("mask", "value").agg(F.min("grp").alias("low"), F.max("grp").alias("high")).filter("low != high")
        rows = saved(named.join(broadcast_if_small(saved(mixed.select("mask", "value"), f"{name}_mixed"), MAX_BROADCAST),
                                ["mask", "value"]).select("mask", "value", "m", "fp", "grp"), f"{name}_left")
        if rows.isEmpty():
            return groups
    return components(found.union(saved(_rest(rows), f"{name}_links")), f"{name}_groups")


def _rest(rows: DataFrame) -> DataFrame:
    """All links between groups in rows (mask, value, m, fp, grp) of large buckets: tiles of a bucket meet tiles of those
    of its members that are not in its largest group."""
    by_group = rows.groupBy("mask", "value", "grp").agg(F.count("*").alias("k"))
    largest = by_group.groupBy("mask", "value").agg(F.max(F.struct("k", "grp"))["grp"].alias("main"), F.sum("k").alias("all"),
                                                    F.max("k").alias("k"))
    rows = rows.join(largest, ["mask", "value"])
    tiles, chunks = F.ceil(F.col("m") / TILE), F.ceil((F.col("all") - F.col("k")) / TILE)
    place = F.xxhash64("fp", F.lit(DEPTH))
    span = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    asked = rows.select("mask", "value", "fp", F.pmod(place, tiles).alias("tile"), span(chunks).alias("chunk"), F.lit(False).alias("asks"))
    asking = rows.filter("grp != main").select("mask", "value", "fp", span(tiles).alias("tile"), F.pmod(place, chunks).alias("chunk"),
                                               F.lit(True).alias("asks"))
    both = asked.union(asking)
    return _compared(both, both.count(), "mask", "value", "tile", "chunk")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint, component_id) of every row: 16 hexadecimal digits, and the smallest key that links reach.

    Texts link when their fingerprints differ in at most ``RADIUS`` bits. Equal fingerprints are one node, so copies are
    never compared. Null, empty and white-space texts have the fingerprint zero and link like any other. Every row has
    the component of its own text; rows of one key and unlike texts are not tied by their key. Null keys are no
    component's smallest; without any other key it is null. An empty table gives an empty result.
    """
    rows = saved(fingerprints(docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")), target="fp"), "prints")
    least = saved(rows.groupBy("fp").agg(F.min("key").alias("least")), "print_keys")
    groups = links(least.select("fp"))
    named = least.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn("grp", F.coalesce("component", "fp"))
    top = named.groupBy("grp").agg(F.min("least").alias("component_id"))
    of_print = named.select("fp", "grp").join(top, "grp").select("fp", "component_id")
    done = rows.join(of_print, "fp")
    return done.select(F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
