"""The stages one after the other, each against a plain version of itself."""

import hashlib
import os

import public_tokenizers

import corpus_pipeline as P
from mailprep.llm import bpe_codec
from mailprep.session import saved, shared_dir
from tests.llm.test_jaccard_join import brute as groups_of
from tests.llm.test_suffix_dedup import brute as cut_of


def test_stages(spark, make):
    base = "Thstinnt thndhain onhalyti the in erthst orth it thon tiont edshti on the onheretionshon eronouen. "
    own = lambda i: " ".join(f"{w}{i}" for w in base.split())
    rows = [(i, own(i) + " " + own(i + 100), "en", "a") for i in range(30)]
    rows += [(i + 40, "el gato está en la casa con los niños y ñ " * 3 + own(i + 200), "es", "b") for i in range(30)]
    shared = own(777) + " " + own(778) + " " + own(779)
    rows += [(80, own(300) + shared, "en", None), (81, own(301) + shared, "en", "c"), (82, rows[3][1], "en", "c"),
             (83, rows[3][1] + " more", "en", "a"), (84, None, None, "a"), (85, "12345", "en", "a"), (None, own(400), "en", "b"),
             (None, own(400), "en", "b")]
    docs = make(rows)
    one = saved(P.STAGES[0][1](spark, docs, ""), "t")
    assert one.columns == docs.columns and {84, 85}.isdisjoint({r["doc_id"] for r in one.collect()})
    assert one.count() == len(rows) - 2
    two = saved(P.STAGES[1][1](spark, one, ""), "t")
    told = [(r["doc_id"], r["text"]) for r in one.collect()]
    firsts = {k for k, _, c in groups_of(told) if k == c and k is not None}
    assert sorted(r["doc_id"] for r in two.collect() if r["doc_id"] is not None) == sorted(firsts)
    assert sum(r["doc_id"] is None for r in two.collect()) == 1
    three = saved(P.STAGES[2][1](spark, two, ""), "t")
    want = {k: kept.decode(errors="ignore") for k, _, _, _, kept in cut_of([(r["doc_id"], r["text"]) for r in two.collect()])}
    assert {r["doc_id"]: r["text"] for r in three.collect()} == want and len(want[80]) < len(rows[60][1])
    four = saved(P.STAGES[3][1](spark, three, ""), "t")
    assert four.columns == docs.columns and four.count() > 0
    five = P.STAGES[4][1](spark, four, "").collect()
    enc = bpe_codec.encoding(public_tokenizers.path(P.RANKS), public_tokenizers.PATTERN)
    texts = sorted((r["doc_id"] or -1, hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in four.collect())
    assert sorted((r["doc_id"] or -1, r["decoded_sha256"]) for r in five) == texts
    assert sum(r["n_tokens"] for r in five) == sum(len(enc.encode_ordinary(r["text"] or "")) for r in four.collect())


def test_rows_are_documents(spark, make):
    """Repeated and missing ids: no row goes but for a near duplicate, and rows without words stay."""
    text = lambda i: " ".join(f"w{i}x{k}" for k in range(40))
    rows = [(1, text(1)), (1, text(2)), (1, text(1)), (2, text(1) + " more"), (None, text(3)), (3, text(3)), (None, text(4)), (None, text(4)),
            (None, None), (None, None), (None, ""), (None, "  "), (4, ""), (4, "")]
    got = sorted(((r["doc_id"], r["text"]) for r in P.STAGES[1][1](spark, make(rows), "").collect()), key=repr)
    want = [(1, text(1)), (1, text(2)), (3, text(3)), (None, text(4)), (None, None), (None, None), (None, ""), (None, "  "), (4, ""), (4, "")]
    assert got == sorted(want, key=repr)


def test_tables_of_the_join_go(spark, make):
    """What the join of near duplicates saves on its way takes no room from the stages that follow."""
    before = set(os.listdir(shared_dir(spark)))
    text = " ".join(f"w{k}" for k in range(40))
    out = P.STAGES[1][1](spark, make([(1, text), (2, text + " more"), (3, "a b c")]), "")
    new = {n.rsplit("-", 1)[0] for n in set(os.listdir(shared_dir(spark))) - before}
    assert new == {"numbered", "gone"} and sorted(r["doc_id"] for r in out.collect()) == [1, 3]


def test_empty(spark, make):
    docs = make([])
    for _, stage in P.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


def test_a_task_keeps_one_python_worker(spark, make):
    """Workers that take turns in one task all stay, and their memory counts with that of the executor."""
    plan = P.STAGES[4][1](spark, make([(1, "a b c", "en", "a")]), "")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") == 1


def test_characters_cut_in_part_go(spark, make):
    """A passage that ends within a character: the bytes that stay are those of whole characters."""
    from mailprep.llm import suffix_dedup

    passage = "x" + "abcdefghij" * 21
    rows = [(1, "eins " + passage + "é"), (2, "zwei " + passage + "è")]  # é and è share their first byte
    cut = {r["doc_id"]: r for r in suffix_dedup.dedup(make(rows), whole=True).collect()}
    plain = {r["doc_id"]: r for r in suffix_dedup.dedup(make(rows)).collect()}
    assert {k: bytes(r["kept"]).decode() for k, r in cut.items()} == {
        k: bytes(r["kept"]).decode(errors="ignore") for k, r in plain.items()}
    assert {k: r["n_removed"] for k, r in cut.items()} == {k: r["n_removed"] for k, r in plain.items()}
