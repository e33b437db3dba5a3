"""Removal of repeated strings against counting all of them, and the suffix order against sorting."""

import random
from collections import Counter

import numpy as np
import pytest

from mailprep.llm import induced as I
from mailprep.llm import suffix_dedup as S


def brute(rows, width=200):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i:i + width] for b in raw for i in range(len(b) - width + 1))
    out = []
    for (k, _), b in zip(rows, raw):
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if seen[b[i:i + width]] > 1:
                gone[i:i + width] = b"\1" * width
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((k, len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


def removed(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in df.collect()), key=repr)


def rows_of(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdefgh é\n") for _ in range(n))
    shared = [text(n) for n in (150, 199, 201, 260, 700)]
    rows = [(i, text(rng.randrange(300)) + rng.choice(shared) + text(rng.randrange(300)) + rng.choice(shared)) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "x" * 199), (103, "y" * 200), (104, "z" * 201), (105, "ab" * 500),
             (106, rows[0][1]), (107, rows[0][1]), (None, rows[1][1]), (108, shared[2]), (109, "é" * 150 + shared[0])]
    return rows


@pytest.mark.parametrize("hot", [500, 1])
def test_brute_force_and_edges(spark, make, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT", hot)
    monkeypatch.setattr(S, "SEGMENT", 700)
    rows = rows_of(hot)
    assert removed(S.dedup(make(rows))) == brute(rows)


def test_empty_table_and_clashing_columns(spark, make):
    assert S.dedup(make([])).collect() == []
    docs = make([(1, "q" * 300), (2, "short")]).withColumnRenamed("lang", "kept").withColumnRenamed("source", "name")
    assert removed(S.dedup(docs)) == [(1, 300, 300, 1, b""), (2, 5, 0, 0, b"short")]


def test_suffix_order():
    rng = random.Random(4)
    for _ in range(100):
        signs = rng.choice([b"a", b"ab", b"abc", bytes(range(97, 123))])
        pieces = [bytes(rng.choice(signs) for _ in range(rng.randint(1, 60))) for _ in range(rng.randint(1, 6))]
        text, _ = I.as_text(pieces)
        depth = rng.choice([3, 8, 20, 200])
        order = I.suffix_order(text, depth, memory=rng.choice([64, 1 << 26]))
        raw = text.tobytes()
        keys = [raw[i:i + depth] for i in order]
        assert sorted(order) == list(range(len(text))) and keys == sorted(keys)


def test_anchors_depend_on_the_window_alone():
    rng = random.Random(6)
    texts = [bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 900))) for _ in range(6)]
    texts += [texts[0][:450] + texts[1][-300:], b"a" * 500, b""]
    seen, met = set(), {}
    for x, p, q, a, h in zip(*S.anchors(texts)):
        for i in range(p, q + 1):
            assert (x, i) not in seen and met.setdefault(texts[x][i:i + 200], (a - i, h)) == (a - i, h)
            seen.add((x, i))
    assert len(seen) == sum(max(0, len(t) - 199) for t in texts)


def test_merged_spans():
    assert S.merged(np.array([[5, 9], [0, 2], [2, 4], [8, 12]])).tolist() == [[0, 4], [5, 12]]
    assert S.merged(np.zeros((0, 2), "i8")).tolist() == []


def test_hashes_in_parts_and_memory(monkeypatch):
    import tracemalloc

    import numpy as np

    from mailprep.llm import induced

    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, 5000).astype("u1")
    whole = induced.window_hashes(data, 32)
    monkeypatch.setattr(induced, "_HASHED", 700)
    assert (induced.window_hashes(data, 32) == whole).all()
    monkeypatch.undo()
    text = induced.as_text([bytes(rng.integers(97, 110, 2000).astype("u1")) for _ in range(700)])[0]
    tracemalloc.start()
    induced.repeated(text, np.arange(len(text)) < len(text) - 200, 200)
    most = tracemalloc.get_traced_memory()[1] / len(text)
    tracemalloc.stop()
    assert most < 45  # bytes a position
