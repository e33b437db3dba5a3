"""The Merkle manifest, SimHash groups and word runs against plain versions of themselves."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from mailprep.llm import merkle, queries, simhash_join, word_runs
from tests.conftest import SF_DIR

SPACE = r"[^\x20\x09-\x0D]+"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- Merkle manifest ----------------------------------------------------------------------------------------

def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def way(levels, i):
    out = []
    for nodes in levels[:-1]:
        start = i - i % 16
        out.append(("".join(nodes[start:i]), "".join(nodes[i + 1:start + 16])))
        i //= 16
    return out


def plain_manifest(rows):
    """Rows (doc_id, text, lang, source, n_chars) as the query returns them."""
    def leaf(r, text):
        return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (r[0], r[3], r[2], r[4], text)))

    by = {}
    for r in rows:
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
        low = None if r[1] is None else re.sub("[A-Z]", lambda m: m[0].lower(), r[1])
        by.setdefault(r[3], []).append(((r[0] is not None, r[0] or 0, leaf(r, r[1])), r[0], leaf(r, r[1]), leaf(r, low) if hit else None))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = [levels_of([x[2] for x in sorted(by[s], key=lambda x: x[0])]) for s in names]
    top = levels_of([t[-1][0] for t in trees])
    root, out = top[-1][0], []
    for g, (s, tree) in enumerate(zip(names, trees)):
        for i, (_, doc_id, own, other) in enumerate(sorted(by[s], key=lambda x: x[0])):
            path = way(tree, i) + way(top, g)
            node = other or own
            for a, b in path:
                node = sha(a + node + b)
            out.append((doc_id, own, tree[-1][0], root, sha("".join(a + b for a, b in path)), node, node == root))
    return out


def manifest_of(spark, docs):
    return merkle.tampering(docs, ["doc_id", "source", "lang", "n_chars", "text"], "doc_id", "source",
                            {"text": F.translate("text", queries.UPPER, queries.LOWER)},
                            F.crc32(F.col("doc_id").cast("string")) % 5 == 0)


def test_manifest_against_plain(spark, make):
    rows = [(i * 7 % 5003, f"Text {i}", "en", "hot") for i in range(5003)]  # more than one block
    rows += [(i, f"T{i}", None, f"s{i % 40}") for i in range(100)]
    rows += [(1, "A", "en", None), (None, None, None, None), (None, "", "en", "é"), (3, "X", "en", "z"), (3, "X", "en", "z"), (3, "Y", "en", "z")]
    got = [tuple(r) for r in manifest_of(spark, make(rows)).collect()]
    assert sorted(got, key=repr) == sorted(plain_manifest([(*r, None) for r in rows]), key=repr)
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 16, 17, 257])
def test_manifest_sizes(spark, make, n):
    rows = [(i, f"Text {i}", "en", "one") for i in range(n)]
    got = [tuple(r) for r in manifest_of(spark, make(rows)).collect()]
    assert sorted(got, key=repr) == sorted(plain_manifest([(*r, None) for r in rows]), key=repr)


def test_manifest_edges(spark, make):
    assert manifest_of(spark, make([])).collect() == []
    docs = make([(1, "A" * 3_000_000, "en", "a"), (2, "b", "en", "a")])
    clash = docs.withColumn("leaf", F.lit("x")).withColumn("pos", F.lit(1)).withColumn("grp", F.lit("g"))
    assert manifest_of(spark, clash).collect() == manifest_of(spark, docs).collect()


def test_versions_share_what_they_do_not_copy(spark):
    nodes = [sha(str(i)) for i in range(300)]
    block = merkle.Block(nodes, 300)
    copies = block.version(37, "f" * 64)
    changed = merkle.Block([*nodes[:37], "f" * 64, *nodes[38:]], 300)
    assert copies == [level[37 // 16 ** k] for k, level in enumerate(changed.levels)]
    differ = [(k, i) for k, (a, b) in enumerate(zip(block.levels, changed.levels)) for i in range(len(a)) if a[i] != b[i]]
    assert differ == [(k, 37 // 16 ** k) for k in range(len(copies))]  # a version is these nodes and all of the old others
    rows = spark.createDataFrame([("g", i, n, "f" * 64 if i == 37 else None) for i, n in enumerate(nodes)],
                                 "grp string, key long, leaf string, changed string")
    out = {r["key"]: r for r in merkle.proofs(merkle.build(rows)).collect()}
    assert out[37]["copies"] == copies and out[36]["copies"] is None
    assert [tuple(x) for x in out[255]["path"]] == way(levels_of(nodes), 255)


def test_every_row_is_folded_to_the_root(spark, make):
    """A manifest whose stored siblings do not lead to its root fails for all rows of that block, changed or not."""
    rows = spark.createDataFrame([(f"g{i % 2}", i, sha(str(i)), "f" * 64 if i % 5 == 0 else None) for i in range(100)],
                                 "grp string, key long, leaf string, changed string")
    made = merkle.build(rows)
    good = {r["key"]: r["folded_root"] for r in merkle.proof_digests(made).collect()}
    assert all((good[i] == made.root) == (i % 5 > 0) for i in range(100))
    swapped = F.transform("path", lambda p: F.struct(p["right"].alias("left"), p["left"].alias("right")))
    broken = made.blocks.withColumn("path", F.when(F.col("gid") == 0, swapped).otherwise(F.col("path")))
    got = {r["key"]: r["folded_root"] for r in merkle.proof_digests(merkle.Manifest(made.root, made.groups, broken)).collect()}
    of_group = {r["key"] for r in merkle.proof_digests(made).filter("gid = 0").collect()}
    assert len(of_group) == 50 and all((got[i] != good[i]) == (i in of_group) for i in range(100))


# --- SimHash ------------------------------------------------------------------------------------------------

@lru_cache(maxsize=None)
def plain_print(text):
    words = re.findall(SPACE, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    """{print: smallest print of its group}"""
    label = list(range(len(prints)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, x in enumerate(prints):
        for j in range(i):
            if (x ^ prints[j]).bit_count() <= 4:
                a, b = top(i), top(j)
                label[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(prints))]


def plain_near(rows):
    prints = sorted({plain_print(t) for _, t in rows})
    group = dict(zip(prints, plain_groups(prints)))
    least = {}
    for k, t in rows:
        if k is not None:
            g = group[plain_print(t)]
            least[g] = min(k, least.get(g, k))
    return sorted(((k, f"{plain_print(t):016x}", least.get(group[plain_print(t)])) for k, t in rows), key=repr)


def near_of(docs):
    return sorted((tuple(r) for r in simhash_join.near_duplicates(docs).collect()), key=repr)


def test_simhash_whole_table(spark):
    got = sorted((tuple(r) for r in queries.QUERIES["op12_simhash"](spark, SF_DIR).collect()), key=repr)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert got == plain_near(rows)


def test_simhash_edges(spark, make):
    rng = random.Random(2)
    base = [f"w{rng.randrange(9999)}" for _ in range(900)]
    rows = [(i, " ".join(base[:400 + i] + [f"x{i}"] + base[401 + i:])) for i in range(20)]
    rows += [(100, None), (101, ""), (102, " \t\n"), (None, None), (103, "one"), (104, "ONE"), (105, "one two three"), (106, "one  two\nthree"),
             (106, "another text of the same id"), (None, "alone with a null key"), (107, "É b c d e"), (108, "é b c d e"),
             (109, "long " * 20_000), (110, "Long\t" * 20_000)]
    docs = make(rows)
    got = near_of(docs)
    assert got == plain_near(rows)
    assert near_of(docs.withColumn("fp", F.lit(1)).withColumn("row", F.lit(2)).withColumn("value", F.lit("x")).withColumn("key", F.lit(3))) == got
    assert near_of(make([])) == []


@pytest.mark.parametrize("tile, depth", [(8, 3), (4, 1), (6, 2)])
def test_large_buckets(spark, monkeypatch, tile, depth):
    """Buckets beyond a tile: dealt out, cut finer, and at the end those outside the largest group against all."""
    monkeypatch.setattr(simhash_join, "TILE", tile)
    monkeypatch.setattr(simhash_join, "DEPTH", depth)
    rng = random.Random(tile)
    prints = set()
    for center in (rng.getrandbits(64) for _ in range(12)):
        near = center ^ sum(1 << b for b in rng.sample(range(64), 7))  # close to, but apart from the center's group
        for c in (center, near):
            prints |= {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for _ in range(12)}
    prints |= {rng.getrandbits(30) for _ in range(60)}  # many that agree in most bits
    signed = np.array(sorted(prints), "u8").view("i8").tolist()
    found = simhash_join.links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    got = {r["node"] & (2 ** 64 - 1): r["component"] for r in found.collect()}
    order = sorted(prints)
    want = plain_groups(order)
    mine = [got.get(x, f"alone {x}") for x in order]
    assert len(set(zip(mine, want))) == len(set(mine)) == len(set(want))


def test_bit_slices():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 63, 128, dtype="u8")
    prints[64:] = prints[:64] ^ (np.uint64(1) << rng.integers(0, 64, 64).astype("u8"))
    prints[100:] ^= np.uint64(0b1111 << 30)
    planes = simhash_join._planes(prints)
    who, word = np.repeat(np.arange(128), 2), np.tile(np.arange(2), 128)
    w, k, hits = simhash_join.near(planes, np.full(2, simhash_join._ALL), prints, who, word)
    got = {(int(a), 64 * int(b) + lane) for a, b, h in zip(w, k, hits) for lane in range(64) if int(h) >> lane & 1}
    assert got == {(i, j) for i in range(128) for j in range(128) if int(prints[i] ^ prints[j]).bit_count() <= 4}


# --- word runs ----------------------------------------------------------------------------------------------

def plain_runs(words):
    least = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                least.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in least.items())


def plain_rest(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def loops(rng, letters):
    words = [rng.choice(letters) for _ in range(rng.randrange(60))]
    for _ in range(rng.randrange(3)):
        unit = [rng.choice(letters) for _ in range(rng.randrange(1, 14))]
        at = rng.randrange(len(words) + 1)
        words[at:at] = unit * rng.randrange(2, 12)
    return words * rng.choice([1, 1, 1, 3])


def test_runs_against_plain(monkeypatch):
    rng = random.Random(4)
    for step in (1, 2, 13, 1 << 16):
        monkeypatch.setattr(word_runs, "APPEND", step)
        for _ in range(8 if step < 10 else 60):
            texts = [loops(rng, "abcdefgh"[:rng.choice([1, 2, 3, 8])]) for _ in range(rng.randrange(1, 4))]
            for words, (runs, rest) in zip(texts, word_runs.runs_of([" ".join(t) for t in texts])):
                assert runs == plain_runs(words) and rest.decode() == plain_rest(words, runs)


def test_a_wrong_hash_is_found_out(monkeypatch):
    """Overlap-free words fool a hash that adds up powers: they have no runs all the same."""
    words = ["a" if bin(i).count("1") % 2 else "b" for i in range(1 << 13)]
    assert word_runs.runs_of([" ".join(words)])[0][0] == plain_runs(words[:600]) == []
    words = words[:1 << 11] * 3 + ["c"] + words[:512] * 4
    assert word_runs.runs_of([" ".join(words)])[0][0] == [(0, 3 << 11, 1 << 11), ((3 << 11) + 1, 1 << 11, 512)]


def test_runs_edges(spark, make):
    once = " ".join(f"w{i}" for i in range(40))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a " * 23), (5, "a " * 24), (5, "a " * 24), (None, "x  Y\nx Y " * 12), (6, once),
            (7, f"{once} {once} {once}"), (8, "deep " * 1_500_000), (9, "a b " * 600_000 + once)]
    docs = make(rows).withColumn("runs", F.lit(1)).withColumn("row", F.lit("r"))
    got = {(r["doc_id"], len(r["collapsed"])): [tuple(x) for x in r["runs"]] for r in word_runs.word_runs(docs).collect()}
    assert got == {(1, 0): [], (2, 0): [], (3, 0): [], (4, 45): [], (5, 1): [(0, 24, 1)], (None, 3): [(0, 48, 2)], (6, len(once)): [],
                   (7, len(once)): [(0, 120, 40)], (8, 4): [(0, 1_500_000, 1)], (9, 4 + len(once)): [(0, 1_200_000, 2)]}
    done = word_runs.word_runs(docs)
    assert done.columns == ["doc_id", "lang", "source", "n_chars", "row", "runs", "collapsed"] and done.count() == len(rows)
    assert word_runs.word_runs(make([])).collect() == []


def test_loops(spark, make):
    """The looped texts of the query, made by hand."""
    rows = [(i, " ".join(f"w{i}x{k % 31}" for k in range(60 + i % 50))) for i in range(200)] + [(None, "a b"), (10, ""), (10, None)]
    got = [(r["doc_id"], r["t"]) for r in make(rows).select("doc_id", queries.with_loops(F.col("text"), F.col("doc_id")).alias("t")).collect()]
    want = []
    for key, text in rows:
        h = zlib.crc32(str(key).encode()) if key is not None else 1
        words = re.findall(SPACE, text or "")
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = " ".join(words[i] if i < a else words[a + (i - a) % p] for i in range(n))
        want.append((key, text))
    assert sorted(got, key=repr) == sorted(want, key=repr) and any(a != b for a, b in zip(sorted(rows, key=repr), sorted(want, key=repr)))
