"""URL filters, source mix and top-k search on small tables."""

import random
import statistics
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from mailprep.llm import source_mix, topk_search, url_filter
from mailprep.llm.common import components
from mailprep.llm.queries import RULES


def all_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- components ---------------------------------------------------------------------------------------------

@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(i, i + 1) for i in range(400, 460)] + [
        (500, i) for i in range(501, 560)] + [(7, 7), (None, 3), (2, None)]
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert all_rows(got) == sorted(((x, top(x)) for x in list(up)), key=repr)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- URL filters --------------------------------------------------------------------------------------------

def judged(spark, rows, redirects=None):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"])
            for r in url_filter.judge_urls(pages, RULES, redirects).collect()}


def test_rules(spark):
    urls = {1: "http://WWW.Example.com/en/a", 2: "http://x.example.com/en/a?b#c", 3: "http://example.com/en", 4: "http://a.net/fr/x",
            5: "http://net/es/", 6: "http://a.org/es/1", 7: None, 8: "no url", 9: "http://ÄB.com", 10: "http://com/", 11: "",
            12: "http://a.com?x/en/", 13: "http://xexample.com/en/1"}
    got = judged(spark, [(k, u, None) for k, u in urls.items()])
    assert got == {
        1: ("www.example.com", "/en/a", "www.example.com/en/", "allow"), 2: ("x.example.com", "/en/a", "example.com/en/", "block"),
        3: ("example.com", "/en", "com/", "allow"), 4: ("a.net", "/fr/x", "net/fr/", "block"),
        5: ("net", "/es/", "net/es/", "block"), 6: ("a.org", "/es/1", None, "allow"), 7: ("", "", None, "allow"),
        8: ("", "", None, "allow"), 9: ("Äb.com", "", None, "allow"), 10: ("com", "/", "com/", "allow"), 11: ("", "", None, "allow"),
        12: ("a.com", "", None, "allow"), 13: ("xexample.com", "/en/1", "com/", "allow")}


def test_aliases(spark):
    link = '<head><LINK href="{}" rel=canonical></head>'
    rows = [(1, "http://a.org/x", link.format("http://b.net/fr/1")),                     # to a blocked page that is not there
            (2, "http://c.org/y#top", "<link rel='canonical' href='/z'>"), (3, "http://C.org/z", None),
            (4, "http://d.org/", '<meta http-equiv="refresh" content="0; url=http://a.org/x">'),
            (5, "http://e.org/1", link.format("http://b.net/es/1")), (6, "http://e.org/2", link.format("http://e.org/1")),
            (7, "http://ok.com/", link.format("http://e.org/2")),                        # an allowed page in a blocked group
            (8, "http://f.org/", link.format("http://f.org/")), (9, "http://g.org/", "<link rel=stylesheet href=http://b.net/fr/1>"),
            (4, "http://d.org/", None)]
    got = judged(spark, rows)
    assert {k: v[3] for k, v in got.items()} == {1: "block", 2: "allow", 3: "allow", 4: "block", 5: "allow", 6: "allow", 7: "allow",
                                                 8: "allow", 9: "allow"}
    more = spark.createDataFrame([("http://g.org/", "http://b.net/fr/9")], "a string, b string")
    assert judged(spark, rows, more)[9][3] == "block"
    assert judged(spark, []) == {}


def test_extra_columns_do_not_clash(spark):
    pages = spark.createDataFrame([(1, "http://a.org/", None, "x", 2)], "page_id long, url string, html string, host string, node int")
    assert len(url_filter.judge_urls(pages, RULES).collect()) == 1


# --- source mix ---------------------------------------------------------------------------------------------

def filled_up(sizes):
    """Targets by cutting off and sharing again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    full, demand = set(), 1.5 * sum(sizes.values())
    while True:
        rest = demand - sum(2 * sizes[s] for s in full)
        total = sum(weight[s] for s in names if s not in full)
        share = {s: rest * weight[s] / total for s in names if s not in full} if total else {}
        above = {s for s, v in share.items() if v > 2 * sizes[s]}
        if not above:
            return {s: 2 * sizes[s] if s in full else share[s] for s in names}
        full |= above


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_takes(spark, make, seed):
    rng = random.Random(seed)
    sources = ["b", "a", "Z", "é", None][:rng.choice([1, 3, 5])]
    rows = [(i, "w " * rng.choice([0, 1, 5, 40, 300]), None, rng.choice(sources)) for i in range(120)] + [(500, None, None, sources[0])]
    got = [r.asDict() for r in source_mix.mix(make(rows)).collect()]
    sizes = {s: sum(r["size"] for r in got if r["source"] == s) for s in {r["source"] for r in got}}
    want = filled_up(sizes)
    for s in sizes:
        own = [r for r in got if r["source"] == s]
        assert all(r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s]) for r in own)
        assert sum(r["taken"] for r in own) == pytest.approx(want[s], abs=2)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got) and len(got) == len(rows)
    at = [r["position"] for r in got if r["position"] is not None]
    assert at == sorted(at) and all(0 <= x < 1 for x in at)
    assert got == [r.asDict() for r in source_mix.mix(make(rows)).collect()]


def test_schedule_moves_sources(spark, make):
    rows = [(i, "w " * 10, None, "abc"[i % 3]) for i in range(600)]
    mean = {}
    for r in source_mix.mix(make(rows)).collect():
        mean.setdefault(r["source"], []).extend(r["positions"])
    mean = {s: statistics.mean(v) for s, v in mean.items()}
    assert mean["a"] < mean["b"] < mean["c"]


def test_sequence(spark, make):
    rows = [(1, " a b  c d ", None, "x"), (2, "e f g h i", None, "y"), (3, None, None, "y"), (3, None, None, "y"), (4, "", None, None)]
    docs = make(rows)
    mixed = {r["doc_id"]: r["taken"] for r in source_mix.mix(docs).collect()}
    out = source_mix.sequence(docs)
    assert out.columns == docs.columns
    words = {}
    for r in out.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len((r["text"] or "").split())
    assert {k: words.get(k, 0) for k in mixed} == mixed
    assert source_mix.mix(make([])).collect() == [] and source_mix.sequence(make([])).collect() == []


def test_sequence_moves_texts_twice(spark, make):
    """Once to meet their places and once into training order; equal rows each keep their own copies."""
    rows = [(i % 7, f"a{i % 7} b c", str(i), "xy"[i % 2]) for i in range(60)] + [(None, "q r", str(i), None) for i in range(5)]
    out = source_mix.sequence(make(rows))
    plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    moved = [part for part in plan.split("\n\n") if " Exchange\n" in part and "text#" in part]
    assert len(moved) == 2
    taken = {}
    for r in source_mix.mix(make(rows)).collect():
        taken[r["doc_id"], r["source"]] = taken.get((r["doc_id"], r["source"]), 0) + r["taken"]
    got = {}
    for r in out.collect():
        got[r["doc_id"], r["source"]] = got.get((r["doc_id"], r["source"]), 0) + len(r["text"].split())
    assert got == {k: n for k, n in taken.items() if n}
    most = 2 * sum(len(t.split()) for _, t, *_ in rows)
    assert sum(got.values()) == pytest.approx(most * 0.75, abs=3) and max(Counter(r["lang"] for r in out.collect()).values()) <= 4


# --- top-k search -------------------------------------------------------------------------------------------

def brute_top(rows, k):
    v = {i: [int(np.floor(64 * float(x))) for x in e] for i, e in rows
         if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)}
    out = []
    for q in (i for i in v if i % 20 == 0):
        best = sorted((-sum(a * b for a, b in zip(v[q], v[d])), d) for d in v if d != q)[:k]
        out += [(q, n + 1, d, -s) for n, (s, d) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("block, shard", [(256, 64), (4, 3)])
def test_top_k(spark, monkeypatch, block, shard):
    monkeypatch.setattr(topk_search, "BLOCK", block)
    monkeypatch.setattr(topk_search, "BLOCKS_PER_SHARD", shard)
    rng = np.random.default_rng(block)
    rows = [(int(i), [float(x) for x in np.round(rng.normal(size=5), 1)]) for i in rng.permutation(90)]
    rows += [(100, None), (120, [1.0, None, 2.0, 0.0, 0.0]), (140, [float("nan")] * 5), (160, [float("inf")] + [0.0] * 4),
             (None, [1.0] * 5), (200, [0.5, 0.5]), (201, rows[0][1]), (202, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk_search.top_k(df, 7, F.col("vec_id") % 20 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(
        [(i, None if e is None else [None if x is None else np.float32(x) for x in e]) for i, e in rows], 7)
    assert topk_search.top_k(df.limit(0), 7, F.col("vec_id") % 20 == 0).collect() == []


def test_pruning_keeps_ties():
    m = np.zeros((600, 3), "i8")
    ids = np.arange(600)
    got = topk_search.search_shard(np.array([5]), np.array([[1, 2, 3]]), ids, m, 4, block=16)
    assert [d for _, d, _ in got] == [0, 1, 2, 3]
