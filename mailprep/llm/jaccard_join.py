"""Near-duplicate groups by a Jaccard join of word shingles over parity sketches.

A document's shingles are hashed into the blocks of a sketch, and every shingle turns over one bit of its block, so the
blocks in which two sketches differ are at most as many as the shingles that only one of the documents has. Documents
that are alike enough can differ in so few blocks that some block with shingles must be equal: they meet there.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailprep.llm.bloom import bloom_of
from mailprep.llm.common import components, filled, give_back, nothing, small_batches, steps
from mailprep.session import broadcast_if_small, saved

WORDS = 5
PERCENT = 80            # documents link from this share of common shingles on
SKETCH_BITS = 512       # at least, of the short sketch that is compared before the sets are
KEYS_PER_SEND = 1 << 19
SHARDS_PER_TASK = 4
BATCH_ROWS = 1000       # texts, or pairs of sets, that a Python worker takes at once
MAX_SENT = 100_000      # rows of one or two numbers that go to every task instead of an exchange
DRAWS = 4               # stars drawn at once after the first round
WORTH = 0.5             # share of a round's pairs with near sketches that must link for another one

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xBF58476D1CE4E5B9))


_BASE = 0x9E3779B97F4A7C15
_VALUE = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype="u8")


def _mixed(h: np.ndarray, seed: int = 0) -> np.ndarray:
    h = (h ^ np.uint64(seed * 0x51ED27 + 1)) * _MIX[0]
    h = (h ^ (h >> np.uint64(32))) * _MIX[1]
    return h ^ (h >> np.uint64(29))


def _word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some texts in a row, and how many each text has. Words stand between ASCII white space;
    A-Z count as a-z. A word's hash is a stretch of one running sum over its bytes."""
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b" " + b" ".join(raw) + b" ", "u1")
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    data = data + np.where((data >= 65) & (data <= 90), 32, 0).astype("u1")
    begins, ends = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1, np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    total = np.concatenate([np.zeros(1, "u8"), np.cumsum(_VALUE[data] * np.cumprod(np.full(len(data), _BASE, "u8")))])
    back = np.cumprod(np.full(len(data), pow(_BASE, -1, 1 << 64), "u8"))
    h = _mixed((total[ends] - total[begins]) * back[begins])
    lengths = np.array([len(r) + 1 for r in raw], "i8")
    return h, np.diff(np.searchsorted(begins, np.concatenate([[0], np.cumsum(lengths)]) + 1))


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct hashes of the 5-word shingles of each text.

    Fewer words make one shingle of the whole sequence; no words make an empty set.
    """
    h, counts = _word_hashes(texts)
    rolled = np.zeros(len(h), "u8")
    full = len(h) - WORDS + 1
    if full > 0:
        s = h[:full].copy()
        for i in range(1, WORDS):
            s = _mixed(s, i) + h[i:i + full]
        rolled[:full] = _mixed(s, WORDS)
    out, start = [], 0
    for n in counts.tolist():
        if n >= WORDS:
            out.append(np.unique(rolled[start:start + n - WORDS + 1]))
        elif n:
            s = h[start:start + 1].copy()
            for i in range(1, n):
                s = _mixed(s, i) + h[start + i:start + i + 1]
            out.append(_mixed(s, 16 + n))
        else:
            out.append(np.zeros(0, "u8"))
        start += n
    return out


def set_id(shingles: np.ndarray) -> int:
    return int(np.frombuffer(xxhash.xxh64_digest(shingles.tobytes()), "<i8")[0])


def levels(n: int) -> list[int]:
    """The size bands in which a set of n shingles is compared: its own, and the next if a partner there may be larger.

    Band l compares pairs whose larger set has 2^l to 2^(l+1) - 1 shingles.
    """
    own = n.bit_length() - 1
    return [own, own + 1] if 100 * n >= PERCENT << (own + 1) else [own]


def blocks(level: int) -> int:
    """Blocks of a band's sketches. Small sets get so many that nearly every shingle has its own."""
    return 1 << 20 if level < 5 else int(0.58 * (1 << level)) + 16


def most_apart(n: int, level: int) -> int:
    """How many shingles at most only one of two linked sets has, for a set of n and any partner in the band."""
    partner = min((2 << level) - 1, 100 * n // PERCENT)
    return (n + partner) * (100 - PERCENT) // (100 + PERCENT)


def block_keys(shingles: np.ndarray, level: int, draw: int = 0) -> np.ndarray:
    """The non-empty blocks of a set's sketch in a band, each with its number and bits as one hash.

    A block has 2^32 bits. Which of them are turned is told by the XOR of their hashes, so a bit turned twice is off.
    """
    where = _mixed(shingles, 1000 * draw + 100 + level)
    block = ((where >> np.uint64(32)) * np.uint64(blocks(level))) >> np.uint64(32)
    order = np.argsort(block, kind="stable")
    block, bit = block[order], _mixed((where & np.uint64(0xFFFFFFFF))[order], 7)
    first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    parity = np.bitwise_xor.reduceat(bit, first)
    key = _mixed(parity ^ _mixed(block[first], 200 + level), 8)
    return (key & ~np.uint64(1)) | np.uint64(level & 1)  # the last bit tells a set's two bands apart


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The short parity sketch as packed bits: every shingle turns one. It has a bit per shingle at least, in a power
    of two, so that a wider one folds onto a narrower one."""
    width = max(SKETCH_BITS, 1 << (len(shingles) - 1).bit_length())
    turned = np.bincount((_mixed(shingles, 3) & np.uint64(width - 1)).astype("i8"), minlength=width) & 1
    return np.packbits(turned.astype("u1"))


def folded(bits: np.ndarray) -> list[int]:
    """A sketch folded to its narrowest width, as numbers. Two of these differ in no more bits than the sketches do."""
    words = bits.reshape(-1, SKETCH_BITS // 8)
    return np.bitwise_xor.reduce(words, axis=0).view("<i8").tolist()


def apart(a: np.ndarray, b: np.ndarray) -> int:
    """In how many bits two sketches differ, at most as many as the sets have shingles that are not common."""
    while len(a) > len(b):
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    while len(b) > len(a):
        b = b[:len(b) // 2] ^ b[len(b) // 2:]
    return int(np.bitwise_count(a ^ b).sum())


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if not len(a) or not len(b):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


def spare(shingles: np.ndarray, draw: int = 0) -> list[int]:
    """Per band of a set: by how many blocks more than one it is sure to share with any linked set there.

    Of its blocks with shingles, all but those that differ are equal.
    """
    return [len(block_keys(shingles, lv, draw)) - most_apart(len(shingles), lv) - 1 for lv in levels(len(shingles))]


def _met(docs: DataFrame, key: str, text: str, shards: int, draw: int) -> DataFrame:
    """Two kinds of rows. Of every document: (key, n, class, spare, sketch, text_id), n its set's size, class the set's
    hash. Of every block that several classes share: (block, class, shared) per class, shared being how many there are.

    Keys travel packed: a task sends each shard one row with its block keys, the classes and which key is whose. A
    shard sorts its keys; those of one class alone go. A block that very many documents share is a single run of it.
    """
    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, owners, classes, held, seen = [], [], [], 0, set()

        def packed() -> pd.DataFrame:
            key, owner = np.concatenate(keys), np.concatenate(owners)
            shard = (key >> np.uint64(48)).astype("i8") * shards >> 16
            order = np.argsort(shard, kind="stable")
            key, owner, shard = key[order], owner[order], shard[order]
            edges = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]]))
            names, rows = np.array(classes, "i8"), []
            for a, b in zip(edges[:-1], edges[1:]):
                who, at = np.unique(owner[a:b], return_inverse=True)
                rows.append((int(shard[a]), key[a:b].tobytes(), names[who].tobytes(),
                             at.astype("<u2" if len(who) < 1 << 16 else "<u4").tobytes()))
            return pd.DataFrame(rows, columns=["shard", "keys", "classes", "at"]).assign(**dict.fromkeys(sent_columns[4:]))

        for f in frames:
            texts, ids, names = filled(f["_text"]), f["_key"].tolist(), f["_id"].to_numpy("i8")
            for a, b in steps(texts):
                rows = []
                for i, s in enumerate(shingle_sets(texts[a:b]), a):
                    if not len(s):
                        rows.append((-1 - i % shards, None, None, None, ids[i], 0, 0, [], b"", [], names[i]))
                        continue
                    name, own = set_id(s), [block_keys(s, level, draw) for level in levels(len(s))]
                    left = [len(k) - most_apart(len(s), level) - 1 for k, level in zip(own, levels(len(s)))]
                    bits = sketch(s)
                    rows.append((-1 - i % shards, None, None, None, ids[i], len(s), name, left, bits.tobytes(), folded(bits), names[i]))
                    if name in seen:
                        continue
                    seen.add(name)
                    keys += own
                    n_keys = sum(map(len, own))
                    owners.append(np.full(n_keys, len(classes), "i4"))
                    held += n_keys
                    classes.append(name)
                yield pd.DataFrame(rows, columns=sent_columns)
                if held > KEYS_PER_SEND:
                    yield packed()
                    keys, owners, classes, held, seen = [], [], [], 0, set()
        if held:
            yield packed()
        del keys, owners, classes, seen
        give_back()

    def meet(f: pd.DataFrame) -> pd.DataFrame:
        if f["shard"].iloc[0] < 0:
            return f[met_columns[2:]].assign(block=None, shared=None)[met_columns]
        key = np.concatenate([np.frombuffer(x, "<u8") for x in f["keys"]])
        name = np.concatenate([np.frombuffer(c, "<i8")[np.frombuffer(at, f"<u{8 * len(at) // len(k)}")]
                               for k, c, at in zip(f["keys"], f["classes"], f["at"])])
        order = np.lexsort((name, key))
        key, name = key[order], name[order]
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (name[1:] != name[:-1])])
        key, name = key[fresh], name[fresh]
        start = np.concatenate([[True], key[1:] != key[:-1]])
        run = np.cumsum(start) - 1
        shared = np.bincount(run)[run]
        several = shared > 1
        out = pd.DataFrame({"block": key[several].view("i8"), "shared": shared[several], "class": name[several]})
        del key, name, order, fresh, start, run, shared, several
        give_back()
        return out.assign(**dict.fromkeys(["key", "n", "spare", "sketch", "fold", "text_id"]))[met_columns]

    of_doc = "key string, n long, class long, spare array<int>, sketch binary, fold array<long>, text_id long"
    sent_columns = ["shard", "keys", "classes", "at", "key", "n", "class", "spare", "sketch", "fold", "text_id"]
    met_columns = ["block", "shared", "key", "n", "class", "spare", "sketch", "fold", "text_id"]
    # keys travel as text, which keeps large numbers and nulls apart and exact
    rows = docs.select(F.col(key).cast("string").alias("_key"), F.col(text).alias("_text"), text_id(F.col(text)).alias("_id"))
    sent = rows.mapInPandas(send, f"shard int, keys binary, classes binary, at binary, {of_doc}")
    return sent.groupBy("shard").applyInPandas(meet, f"block long, shared long, {of_doc}")


def text_id(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _sets_of(docs: DataFrame, text: str, wanted: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, shingles) of the ``wanted`` classes (class), one row each. Only texts that may be the ones that stand
    for these classes are read into shingles again."""
    wanted = broadcast_if_small(wanted, MAX_SENT)
    ids = classes.join(wanted, "class").select("text_id")
    shared = docs.sparkSession.sparkContext.broadcast(bloom_of(ids, "text_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in batches:
            may = pa.array(shared.value.has(f.column("_id").to_numpy()))
            texts = [t or "" for t in f.column("_text").filter(may).to_pylist()]
            for a, b in steps(texts):
                rows = {set_id(s): s.tobytes() for s in shingle_sets(texts[a:b]) if len(s)}
                yield pa.record_batch([pa.array(list(rows), pa.int64()), pa.array(list(rows.values()), pa.binary())], ["class", "shingles"])
        give_back()

    # one Python worker a task: it drops most texts before it makes anything of them
    rows = docs.select(F.col(text).alias("_text"), text_id(F.col(text)).alias("_id")).mapInArrow(run, "class long, shingles binary")
    return rows.join(wanted, "class", "left_semi").dropDuplicates(["class"])


def _verified(pairs: DataFrame, docs: DataFrame, text: str, classes: DataFrame) -> tuple[DataFrame, int]:
    """The pairs (a, b) of classes that link, and how many were compared as sets. Sketches settle most pairs; sets travel
    only for those whose sizes and sketches are near enough."""
    def of(name: str, *columns: str) -> DataFrame:
        return classes.select(F.col("class").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])

    def near(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.loc[[apart(np.frombuffer(x, "u1"), np.frombuffer(y, "u1")) * (100 + PERCENT) <= (n + m) * (100 - PERCENT)
                         for x, y, n, m in zip(f["sketch_a"], f["sketch_b"], f["n_a"], f["n_b"])], ["a", "b"]]

    def sure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.loc[[linked(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")) for x, y in zip(f["sa"], f["sb"])], ["a", "b"]]
        give_back()

    sized = of("a", "n", "sketch").join(broadcast_if_small(pairs, MAX_SENT), "a").join(of("b", "n", "sketch"), "b").filter(
        f"100 * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b)")
    left = saved(sized.mapInPandas(near, "a long, b long"), "pairs_near")
    ends = saved(left.select(F.explode(F.array("a", "b")).alias("class")).distinct(), "pair_ends")
    sets = saved(_sets_of(docs, text, ends, classes), "shingle_sets")
    one, two = sets.toDF("a", "sa"), sets.toDF("b", "sb")
    met = one.join(broadcast_if_small(left, MAX_SENT), "a").join(two, "b")
    return saved(met.mapInPandas(sure, "a long, b long"), "links"), left.count()


def _rarest(met: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows (block, class, n) of the blocks in which a class has to be looked for.

    A set shares all but ``most_apart`` of its blocks with a linked one. So of both sets' blocks in one common order, the
    first ``most_apart`` + 1 hold a block that they share; the order is from rare to frequent. Blocks of one class alone come
    first and are not in ``met``: what is left to take is the number of shared blocks less ``spare``.
    """
    band = F.col("block").bitwiseAND(1)
    own = (F.length(F.bin("n")) - 1) % 2
    spare = F.when(band == own, F.get("spare", F.lit(0))).otherwise(F.get("spare", F.lit(1)))
    rows = met.join(classes.select("class", "n", "spare"), "class").withColumn("band", band).withColumn("left", spare)
    all_ = Window.partitionBy("class", "band")
    rows = rows.withColumn("place", F.row_number().over(all_.orderBy("shared", "block"))).withColumn("all", F.count("*").over(all_))
    return rows.filter("place <= all - left").select("block", "class", "n")


def _unlike(rows: DataFrame) -> DataFrame:
    """The rows of one of the blocks that hold the very same classes, for each such set of two classes and more. Near
    copies meet in very many blocks, which would all tell the same pairs."""
    seeds = [F.xxhash64("class", F.lit(i)).cast("decimal(20)") for i in range(2)]  # sums tell sets apart as class names do sets
    held = rows.groupBy("block").agg(F.count("*").alias("m"), F.min("class").alias("low"), F.max("class").alias("high"),
                                     *[F.sum(s).alias(f"sum{i}") for i, s in enumerate(seeds)]).filter("low != high")
    one = held.groupBy("m", "low", "high", "sum0", "sum1").agg(F.min("block").alias("block"))
    return rows.join(one.select("block"), "block")


def _named(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows (block, class, n, grp) of the blocks in which several groups meet."""
    named = rows.join(groups.withColumnRenamed("node", "class"), "class", "left").select(
        "block", "class", "n", F.coalesce("component", "class").alias("grp"))
    mixed = named.groupBy("block").agg(F.min("grp").alias("low"), F.max("grp").alias("high")).filter("low != high")
    return saved(named.join(mixed.select("block"), "block"), "blocks_mixed")


def _star_pairs(named: DataFrame, turn: int) -> DataFrame:
    """Every class of a block with a class of another group there, the first one in an order that is drawn anew each turn.
    Later turns find less, so they take several draws at once."""
    draws = [turn] if turn == 0 else range(1 + (turn - 1) * DRAWS, 1 + turn * DRAWS)
    one = [F.struct(F.xxhash64("class", F.lit(i)).alias("drawn"), "class", "grp", "n") for i in draws]
    both = named.join(named.groupBy("block").agg(F.array(*map(F.min, one)).alias("ones")), "block")
    # the class that a draw names meets those of other groups, the first of another group those of its own
    others = [F.min(F.when(F.col("grp") != F.col("ones")[i]["grp"], x)) for i, x in enumerate(one)]
    both = both.join(both.groupBy("block").agg(F.array(*others).alias("twos")), "block")
    ends = F.array(*[F.when(F.col("grp") != F.col("ones")[i]["grp"], F.col("ones")[i]).otherwise(F.col("twos")[i]) for i in range(len(one))])
    pairs = both.select("class", "n", F.explode(F.array_distinct(ends)).alias("to"))
    return pairs.filter(f"100 * least(n, to.n) >= {PERCENT} * greatest(n, to.n)").select(
        F.least("class", "to.class").alias("a"), F.greatest("class", "to.class").alias("b")).distinct()


def _all_pairs(named: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of classes that share a block and are in different groups. The largest group of a block meets the others only
    once, and not itself. Pairs whose folded sketches are too far apart are left out in the join itself; only here do these
    travel with the blocks."""
    sizes = named.groupBy("block", "grp").agg(F.count("*").alias("m"))
    main = sizes.groupBy("block").agg(F.max(F.struct("m", "grp"))["grp"].alias("main"))
    rows = named.join(classes.select("class", "fold"), "class").join(main, "block")
    rest = rows.filter("grp != main").select("block", F.col("class").alias("a"), F.col("grp").alias("ga"), F.col("n").alias("na"),
                                              *[F.get("fold", F.lit(i)).alias(f"fa{i}") for i in range(SKETCH_BITS // 64)])
    other = rows.select("block", F.col("class").alias("b"), F.col("grp").alias("gb"), F.col("n").alias("nb"),
                        *[F.get("fold", F.lit(i)).alias(f"fb{i}") for i in range(SKETCH_BITS // 64)], (F.col("grp") == F.col("main")).alias("big"))
    differ = " + ".join(f"bit_count(fa{i} ^ fb{i})" for i in range(SKETCH_BITS // 64))
    alike = (f"ga != gb and (big or a < b) and 100 * least(na, nb) >= {PERCENT} * greatest(na, nb)"
             f" and ({differ}) * {100 + PERCENT} <= (na + nb) * {100 - PERCENT}")
    return rest.join(other, "block").filter(alike).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id) of every row: its set's size and the smallest key that links reach.

    Documents link when their sets share ``PERCENT`` percent of the union. Equal sets are one class, so copies are
    never compared. Classes meet in their rarest blocks. There each is compared with a drawn class of another group, round by
    round while many link, which joins nearly all of a group with few comparisons; then all pairs are compared that meet
    in a block and are still in different groups. No pair inside a group is written out, and none across groups is left out.

    Null, empty and white-space texts have no shingles and are alone. Rows of one key are one document for links. A
    null key links nothing; its component is the smallest key of its group, null if there is none. An empty table
    gives an empty result.
    """
    with small_batches(docs.sparkSession, BATCH_ROWS):  # what is returned has no Python step left
        return _grouped(docs, key, text)


def _grouped(docs: DataFrame, key: str, text: str) -> DataFrame:
    shards = min(1 << 15, SHARDS_PER_TASK * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    for draw in count():  # a draw of blocks that fills too few for some set is drawn anew; one in billions of sets is
        found = saved(_met(docs, key, text, shards, draw), "blocks_met")
        met = found.filter("block is not null").select("block", "class", "shared")
        sizes = found.filter("block is null").select(
            F.col("key").cast(docs.schema[key].dataType).alias("_key"), "n", "class", "spare", "sketch", "fold", "text_id")
        if sizes.filter("array_min(spare) < 0").isEmpty():
            break
    one_of = F.min(F.struct("text_id", "n", "spare", "sketch", "fold")).alias("one")
    classes = saved(sizes.filter("n > 0").groupBy("class").agg(one_of).select("class", "one.*"), "classes")
    rows = saved(_unlike(saved(_rarest(met, classes), "blocks_rarest")), "blocks")
    groups = nothing(docs.sparkSession, "node long, component long")
    links = tried = nothing(docs.sparkSession, "a long, b long")
    for turn in count():
        found = _star_pairs(_named(rows, groups), turn)
        pairs = saved(found.join(broadcast_if_small(tried, MAX_SENT), ["a", "b"], "left_anti") if turn else found, "pairs")
        more, asked = _verified(pairs, docs, text, classes)
        links, tried = links.union(more), tried.union(pairs)
        joined = more.count()
        groups = broadcast_if_small(components(links, "groups"), MAX_SENT) if joined else groups
        if joined < WORTH * asked or not joined:
            break
    rest = _all_pairs(_named(rows, groups), classes).join(broadcast_if_small(tried, MAX_SENT), ["a", "b"], "left_anti")
    rest = saved(rest, "pairs")
    if not rest.isEmpty():
        links = links.union(_verified(rest, docs, text, classes)[0])
        groups = broadcast_if_small(components(links, "groups"), MAX_SENT)
    # rows of one key tie their classes together
    by_class = sizes.filter("n > 0").join(groups.withColumnRenamed("node", "class"), "class", "left").select(
        "_key", F.coalesce("component", "class").alias("grp"))
    members = saved(by_class.distinct(), "members")
    shared = members.filter("_key is not null").groupBy("_key").agg(F.min("grp").alias("low"), F.max("grp").alias("high"))
    tied = components(members.join(shared.filter("low != high"), "_key").select(F.col("low").alias("a"), F.col("grp").alias("b")),
                      "tied")
    members = members.join(tied.withColumnRenamed("node", "grp"), "grp", "left").select(
        "_key", "grp", F.coalesce("component", "grp").alias("top"))
    least = members.groupBy("top").agg(F.min("_key").alias("component_id"))
    of_group = members.select("grp", "top").distinct().join(least, "top").select("grp", "component_id")
    out = (sizes.join(groups.withColumnRenamed("node", "class"), "class", "left")
           .withColumn("grp", F.when(F.col("n") > 0, F.coalesce("component", "class")))
           .join(of_group, "grp", "left"))
    return out.select(F.col("_key").alias(key), F.col("n").alias("n_shingles"),
                      F.coalesce("component_id", "_key").alias("component_id"))
