"""The Jaccard join against all pairs."""

import random
import re
from itertools import combinations

import numpy as np

from mailprep.llm import jaccard_join as J

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets, up = [shingles(t) for _, t in rows], list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        same_id = rows[i][0] is not None and rows[i][0] == rows[j][0] and a and b
        if same_id or a & b and 100 * len(a & b) >= 80 * len(a | b):
            up[top(j)] = top(i)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[top(i)] = min(k, least.get(top(i), k))
    return sorted(((k, len(s), least.get(top(i)) if s else k) for i, ((k, _), s) in enumerate(zip(rows, sets))), key=repr)


def rows_of(seed):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(400)] + ["É", "ÀB", "Cd"]
    rows = []
    for group in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([1, 3, 5, 6, 9, 30, 120, 700]))]
        for _ in range(rng.choice([1, 2, 4, 9])):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append((len(rows) * 3 % 101 + group, " ".join(t)))
    rng.shuffle(rows)
    return rows


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_brute_force_and_edges(spark, make):
    passage = " ".join(f"common{i}" for i in range(40))
    rows = list({k: (k, t) for k, t in rows_of(1)}.values())
    rows += [(1000 + i, f"{passage} " + " ".join(f"own{i}x{j}" for j in range(20 + i % 7))) for i in range(40)]
    rows += [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "one"), (2004, "ONE"), (2005, "one two"),
             (2006, "x y z"), (None, "one two"), (None, None), (2007, "a b c d e f g h i j"),
             (2007, "k l m n o p q r s t"), (2008, "k l m n o p q r s t"), (2008, "k l m n o p q r s t")]
    assert collected(J.near_duplicates(make(rows))) == brute(rows)


def test_hot_blocks_are_met_elsewhere_or_kept(spark, make, monkeypatch):
    monkeypatch.setattr(J, "WORTH", 2)  # one star round; the rest is left to the join of all pairs
    rows = list({k: (k, t) for k, t in rows_of(2)}.values())
    assert collected(J.near_duplicates(make(rows))) == brute(rows)


def test_empty_table_and_clashing_columns(spark, make):
    assert J.near_duplicates(make([])).collect() == []
    docs = make([(1, "a b c"), (2, "a b c")]).withColumnRenamed("lang", "class").withColumnRenamed("source", "block")
    assert collected(J.near_duplicates(docs)) == [(1, 1, 1), (2, 1, 1)]


def test_linked_sets_always_share_a_block():
    rng = np.random.default_rng(3)
    for n in [1, 2, 4, 5, 6, 9, 17, 31, 32, 40, 63, 64, 100, 255, 256, 1000, 3000]:
        for _ in range(30):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype="u8"))
            drop, new = rng.integers(0, n // 5 + 2), rng.integers(0, n // 5 + 2)
            b = np.unique(np.append(a[drop:], rng.integers(0, 1 << 63, new, dtype="u8")))
            if J.linked(a, b):
                bands = set(J.levels(len(a))) & set(J.levels(len(b)))
                assert any(set(J.block_keys(a, v)) & set(J.block_keys(b, v)) for v in bands)
                assert J.apart(J.sketch(a), J.sketch(b)) <= len(np.setxor1d(a, b))
            assert min(J.spare(a)) >= 0


def test_many_near_copies_around_one_passage(spark, make):
    """Two thousand texts share a passage; some are near copies of each other, most are just not alike enough."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(2000):
        own = [f"o{i}x{k}" for k in range(rng.choice([3, 8, 14]))]
        rows.append((i, " ".join(own + passage)))
    rows += [(5000 + i, rows[i * 7][1] + f" end{i}") for i in range(60)]
    got = {r["doc_id"]: r["component_id"] for r in J.near_duplicates(make(rows)).collect()}
    sets = {k: set(zip(*[t.split()[j:] for j in range(5)])) for k, t in rows}
    label = {k: k for k, _ in rows}

    def top(k):
        while label[k] != k:
            k = label[k]
        return k

    short = [k for k in sets if len(sets[k]) <= 48]
    for n, a in enumerate(short):
        for b in short[:n]:
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                label[max(x, y)] = min(x, y)
    for a in sets:
        if a >= 5000:
            b = (a - 5000) * 7
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                label[max(x, y)] = min(x, y)
    assert got == {k: top(k) for k in sets}


def test_blocks_of_the_same_classes_count_once(spark, make, monkeypatch):
    """Near copies meet in very many blocks; blocks that hold the very same classes are one, and sketches stay behind."""
    seen, stars = [], J._star_pairs

    def kept(named, *more):
        seen.append((named.columns, named.select("block", "class").collect()))
        return stars(named, *more)

    monkeypatch.setattr(J, "_star_pairs", kept)
    rows = list({k: (k, t) for k, t in rows_of(4)}.values())
    assert collected(J.near_duplicates(make(rows))) == brute(rows)
    for columns, found in seen:
        held = {}
        for r in found:
            held.setdefault(r["block"], set()).add(r["class"])
        assert "fold" not in columns and len(held) <= 2 * len(set(map(frozenset, held.values())))  # once in each band


def test_empty_tables_take_no_python_worker(spark):
    from mailprep.llm.common import nothing

    empty = nothing(spark, "a long, b string")
    assert empty.dtypes == [("a", "bigint"), ("b", "string")] and empty.collect() == []
    assert "RDD" not in empty._jdf.queryExecution().toString()


def test_rounds_over_few_edges_need_no_exchange(spark, monkeypatch):
    """What is left of most rounds is small, and exchanges over as many tasks as the whole input has take far longer."""
    from mailprep.llm import common

    plans, saved = [], common.saved

    def kept(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return saved(df, name)

    monkeypatch.setattr(common, "saved", kept)
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101), (102, 101), (7, 7)], "a long, b long")
    want = sorted([(i, 0) for i in range(51)] + [(i, 100) for i in range(100, 103)])
    assert sorted(map(tuple, common.components(edges).collect())) == want
    assert len(plans) > 1 and not any(plans[1:])
    plans.clear()
    monkeypatch.setattr(common, "FEW_EDGES", 0)
    assert sorted(map(tuple, common.components(edges).collect())) == want and all(plans)


def test_later_rounds_draw_several_stars(spark):
    named = spark.createDataFrame([(b, c, 10, c // 4) for b in (1, 2) for c in range(40)], "block long, class long, n long, grp long")
    met = [collected(J._star_pairs(named, turn)) for turn in (0, 1, 2)]
    assert all(a // 4 != b // 4 for pairs in met for a, b in pairs)
    assert all({c for p in pairs for c in p} == set(range(40)) for pairs in met)
    assert len(met[0]) < 80 < 110 < min(len(met[1]), len(met[2])) and met[1] != met[2]
