"""Language identification, token counts, BPE, fingerprints and perplexity on small tables."""

import hashlib
import random
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer
from tokenizers.models import Unigram

from mailprep.llm import bpe_codec, imatch, language_id, quality_lm, queries, token_counts
from mailprep.llm.common import steps
from tests.conftest import SF_DIR

RANKS = public_tokenizers.path(queries.RANKS)


def all_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- language identification --------------------------------------------------------------------------------

def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in queries.QUERIES["op4_language_id"](spark, SF_DIR).collect()}
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    held = [d for d, r in got.items() if r["held_out"]]
    assert all(got[d]["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d in got)
    assert sum(got[d]["lang_pred"] == truth[d] for d in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_edges(spark, make):
    train = make([(i, "the cat and the dog " * 5, "en", None) for i in range(9)]
                 + [(i + 20, "der hund und die katze " * 5, "de", None) for i in range(9)] + [(50, None, "en", None), (51, "x", None, None)])
    m = language_id.fit(train)
    assert m["langs"] == ["de", "en"]
    docs = make([(1, None), (2, ""), (3, "123 !?"), (4, "the dog"), (4, "the dog"), (5, "und die katze" * 1000), (None, "die katze")])
    docs = docs.withColumnRenamed("lang", "lang_pred")
    got = all_rows(language_id.identify(docs, m).select("doc_id", "lang_pred", "ambiguous"))
    assert got == sorted([(1, "und", True), (2, "und", True), (3, "und", True), (4, "en", False), (4, "en", False),
                          (5, "de", False), (None, "de", False)], key=repr)
    nothing = language_id.fit(make([]))
    assert {r["lang_pred"] for r in language_id.identify(docs, nothing).collect()} == {"und"}
    assert language_id.identify(make([]), m).collect() == []


def plain_language(m, text):
    """The model's answer for one text, sign by sign: (language, score)."""
    codes = [48 if 48 <= ord(c) <= 57 else ord(c) for c in f"\n\n{text.lower()}\n\n"]
    sums, places = np.zeros(m["code"].shape[1]), len(text.lower()) + 2
    for at in range(places):
        mix = 0
        for order in (1, 2, 3):
            factor = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)[order - 1]
            mix = (mix * 31 + codes[at + order - 1] * factor) % 2 ** 32
            sums += m["weights"][(mix * 0x2C1B3C6D) % 2 ** 32 >> 16].astype("f8")
    margins = sums / (3 * places) / m["scale"]
    loss = [float(sum(t * np.log1p(np.exp(-b * x)) for t, b, x in zip(m["trust"], word, margins))) for word in m["code"].tolist()]
    order = sorted(range(len(loss)), key=loss.__getitem__)
    gap = loss[order[1]] - loss[order[0]]
    return m["langs"][order[0]], 1 - 0.5 ** (gap / max(m["gap"] * 0.5, 1e-9))


def test_language_against_plain_and_in_any_order(spark, make):
    """Bits, loss and gap by hand; the neighbours of a row and its repeats tell nothing."""
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()]
    m = language_id.fit(make(rows))
    docs = [*rows[:60], *[(1000 + i, t, None) for i, t in enumerate(["A", "été 12", "x" * 500, "ß", "a\nb", *[rows[3][1]] * 3])]]

    def told(order):
        frame = language_id.identify(spark.createDataFrame([(i, docs[i][1]) for i in order], "doc_id long, text string").coalesce(1), m)
        return {r["doc_id"]: (r["lang_pred"], r["lang_score"], r["ambiguous"]) for r in frame.collect()}

    got = told(range(len(docs)))
    assert got == told(reversed(range(len(docs))))
    assert len({got[i] for i in (3, *range(len(docs) - 3, len(docs)))}) == 1
    for i, (_, text, _) in enumerate(docs):
        if len(text) < 4000:
            lang, score = plain_language(m, text)
            assert got[i][0] == lang and abs(got[i][1] - score) < 1e-4


def test_mixed_and_foreign_texts_are_ambiguous(spark, make):
    docs = [r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").join(
        spark.read.parquet(f"{SF_DIR}/labels.parquet").filter("quality = 1"), "doc_id").orderBy("doc_id").collect() if len(r["text"]) > 1000]
    m = language_id.fit(make([(r["doc_id"], r["text"], r["lang"]) for r in docs]))
    rng, by = random.Random(3), {}
    for r in docs:
        by.setdefault(r["lang"], []).append(r["text"])
    rows = {}
    for n in (100, 1000):
        for i in range(50):
            a, b = rng.sample(sorted(by), 2)
            rows["mixed", n, i] = rng.choice(by[a])[:n // 2] + " " + rng.choice(by[b])[:n // 2]
    for name, letters in (("latin", "abcdefghijklmnopqrstuvwxyz "), ("cyrillic", "абвгдежзиклмнопрстуф ")):
        rows |= {(name, 0, i): "".join(rng.choice(letters) for _ in range(1000)) for i in range(20)}
    rows |= {("clean", 0, i): r["text"] for i, r in enumerate(docs)}
    keys = list(rows)
    told = language_id.identify(make([(i, rows[k]) for i, k in enumerate(keys)]), m).collect()
    flagged = {name: [r["ambiguous"] for r in told if keys[r["doc_id"]][0] == name] for name in ("mixed", "latin", "cyrillic", "clean")}
    share = {k: sum(v) / len(v) for k, v in flagged.items()}
    assert share["mixed"] > 0.9 and share["latin"] == share["cyrillic"] == 1 and share["clean"] < 0.03


def test_codewords_are_apart():
    for k in (2, 3, 4, 7, 8, 30):
        c = language_id.codewords(k).astype(int)
        assert len({tuple(r) for r in c}) == k and (k < 3 or (c @ c.T)[~np.eye(k, dtype=bool)].max() < c.shape[1])


# --- token counts -------------------------------------------------------------------------------------------

def test_counts_match_a_unigram_tokenizer():
    m = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECES))
    plain = [i for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
    pieces = [m.id_to_piece(i) for i in sorted(plain, key=lambda i: (-m.get_score(i), i))]
    cost = [1 + round(token_counts.SCALE * float(np.log(r + 2))) for r in range(len(pieces))]
    other = Tokenizer(Unigram([("<unk>", -1e6)] + [(p, -float(c)) for p, c in zip(pieces, cost)], 0, False))
    rng = random.Random(1)
    words = list({"▁" + "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 14))) for _ in range(800)})
    words += ["▁international", "▁Straße", "▁été"]
    got = token_counts.counts(words, token_counts.vocabulary(public_tokenizers.path(queries.PIECES)))
    best = {p: c for p, c in zip(pieces, cost)}
    for w, n in zip(words, got):
        theirs = other.encode(w).tokens
        # equal costs may be split in several ways; ours takes the fewest
        assert n <= len(theirs) and all(t in best for t in theirs)
        assert n == len(theirs) or _least(w, best) == sum(best[t] for t in theirs)


def _least(word, best):
    at = [0] + [1 << 60] * len(word)
    for i in range(1, len(word) + 1):
        for j in range(i):
            if word[j:i] in best:
                at[i] = min(at[i], at[j] + best[word[j:i]])
    return at[-1]


def test_counts_by_brute_force():
    pieces = ["▁a", "a", "b", "ab", "▁", "bc", "c", "abc", "▁ab"]
    vocab, rng = token_counts.Vocabulary(pieces), random.Random(2)
    price = {p: 1 + round(token_counts.SCALE * float(np.log(r + 2))) for r, p in enumerate(pieces)}
    words = list({"▁" + "".join(rng.choice("abcdé𝄞") for _ in range(rng.randint(1, 12))) for _ in range(400)})
    for w, n in zip(words, token_counts.counts(words, vocab)):
        best = [(0, 0)]
        for i in range(1, len(w) + 1):
            size = len(w[i - 1].encode())
            options = [(best[i - 1][0] + token_counts.UNKNOWN * size, best[i - 1][1] + size)]
            options += [(best[j][0] + price[w[j:i]], best[j][1] + 1) for j in range(i) if w[j:i] in price]
            best.append(min(options))
        assert n == best[-1][1]
    assert len(token_counts.counts([], vocab)) == 0


@pytest.mark.parametrize("part, parts", [(1, 2), (7, 3), (64, 256)])
def test_long_words_in_parts(part, parts):
    rng = random.Random(part)
    pieces = ["▁a", "a", "b", "ab", "▁", "bc", "c", "abc", "▁ab", "ddd", "dddd"]
    for vocab in (token_counts.Vocabulary(pieces), token_counts.Vocabulary([])):
        words = list({"▁" + "".join(rng.choice("abcdé𝄞") for _ in range(rng.randint(0, 200))) for _ in range(40)})
        want = token_counts.counts(words, vocab)
        assert [token_counts.count_long(w, vocab, part, parts) for w in words] == list(want)


def test_a_word_of_a_million_characters():
    vocab = token_counts.vocabulary(public_tokenizers.path(queries.PIECES))
    rng = random.Random(1)
    word = "▁" + "".join(rng.choice("etaoinshrdlu0123é") for _ in range(10 ** 6))
    begin = time.monotonic()
    n = token_counts.count_long(word, vocab)
    assert time.monotonic() - begin < 30 and 10 ** 5 < n < 10 ** 6
    head = word[:token_counts.LONG]
    assert token_counts.count_long(head, vocab) == token_counts.counts([head], vocab)[0]


def test_token_counts_of_documents(spark, make):
    docs = make([(1, "a b a"), (1, "a b a"), (2, None), (3, " \n"), (None, "a"), (4, "x" * 3000)])
    got = all_rows(token_counts.count_tokens(docs, public_tokenizers.path(queries.PIECES)))
    words = dict((r[0], r[1]) for r in got)
    assert words == {1: 3, 2: 0, 3: 0, None: 1, 4: 1} and len(got) == 6
    assert token_counts.count_tokens(make([]), public_tokenizers.path(queries.PIECES)).collect() == []


# --- byte BPE -----------------------------------------------------------------------------------------------

def hard_texts():
    rng = random.Random(3)
    bits = ["word", " ", "  ", "\n", "\n\n", "'ll", "'", "don't", "12", "é", "日本", "!?", "\t", "x" * 40, "<|endoftext|>", "   "]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 900))) for _ in range(40)] + [
        "a" * 3000, " " * 3000, "b " * 1500, "", None, "'" * 2000]


@pytest.mark.parametrize("chunk, overlap", [(1 << 15, 1 << 10), (97, 40), (50, 7)])
def test_round_trip_and_chunks(spark, make, chunk, overlap):
    texts = hard_texts()
    docs = make([(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, "x y")])
    ids = bpe_codec.encode(docs, RANKS, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap)
    got = all_rows(bpe_codec.decode(ids, RANKS, public_tokenizers.PATTERN))
    enc = bpe_codec.encoding(RANKS, public_tokenizers.PATTERN)
    want = [(k, np.asarray(enc.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode())
            for k, t in [*enumerate(texts), (3, texts[3]), (None, "x y")]]
    assert sorted(((k, bytes(a), bytes(b)) for k, a, b in got), key=repr) == sorted(want, key=repr)


def test_digests(spark, make):
    args = RANKS, public_tokenizers.PATTERN
    row = bpe_codec.digests(bpe_codec.decode(bpe_codec.encode(make([(1, None)]), *args), *args)).first()
    nothing = hashlib.sha256(b"").hexdigest()
    assert tuple(row) == (1, 0, nothing, nothing)
    assert bpe_codec.encode(make([]), *args).collect() == []


# --- fingerprints -------------------------------------------------------------------------------------------

def test_fingerprints(spark):
    got = {r["doc_id"]: r for r in queries.QUERIES["op10_imatch"](spark, SF_DIR).collect()}
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    by_text = {}
    for (k, t), (_, after) in zip(docs, docs[1:] + docs[:1]):
        t, after, r = t or "", after or "", got[k]
        changed = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert by_text.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
    assert len(got) == len(docs)
    mean = lambda c: sum(r[c] for r in got.values()) / len(got)
    assert mean("near_edited") > mean("near_next") + 0.1


def test_fingerprint_order_and_edges(spark, make):
    rows = [(5, "e " * 9), (None, "null key"), (1, None), (2, ""), (2, "b"), (9, "日本 x")]
    got = imatch.fingerprint(make(rows)).collect()
    order = [(None, "null key"), (1, ""), (2, ""), (2, "b"), (5, "e " * 9), (9, "日本 x")]
    want = []
    for (k, t), (_, n) in zip(order, order[1:] + order[:1]):
        want.append((k, len(t), hashlib.sha256((t[:len(t) - len(t) // 2] + n[:len(t) // 2]).encode()).hexdigest()))
    assert sorted((tuple(r)[:3] for r in got), key=repr) == sorted(want, key=repr)
    alone = imatch.fingerprint(make([(1, "one text")])).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0
    assert imatch.fingerprint(make([])).collect() == []


def test_fingerprints_of_any_key(spark):
    rows = [("b", "second text"), ("a", "first text"), (None, "no key"), ("ab", None), ("b", "a tie")]
    got = imatch.fingerprint(spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id string, text string, key int, part int"))
    order = [(None, "no key"), ("a", "first text"), ("ab", ""), ("b", "a tie"), ("b", "second text")]
    want = []
    for (k, t), (_, n) in zip(order, order[1:] + order[:1]):
        want.append((k, len(t), hashlib.sha256((t[:len(t) - len(t) // 2] + n[:len(t) // 2]).encode()).hexdigest()))
    assert sorted((tuple(r)[:3] for r in got.collect()), key=repr) == sorted(want, key=repr)


def plain_fingerprint(text, lexicon):
    """Word by word in whole numbers, one subset at a time."""
    top, out = 2 ** 64, []
    terms = sorted(xxhash.xxh64_intdigest(w) for w in set(text.lower().encode().split()))
    terms = [t for t in terms if t in lexicon] or terms
    subset = 0
    for share in imatch.SHARES:
        for _ in range(imatch.PER_SHARE):
            subset += 1
            total = before = 0
            for t in terms:
                drawn = (t ^ subset) * 0x9E3779B97F4A7C15 % top
                drawn = (drawn ^ drawn >> 32) * 0xD6E8FEB86659FD93 % top
                if drawn >> 64 - share:
                    continue
                before += 1
                turned = t * (2 * before + 1) % top
                total += turned ^ turned >> 29
            out.append(total % top)
    return out


def test_fingerprints_against_plain(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    seen = Counter(w for t in texts.values() for w in set(t.lower().encode().split()))
    low, high = max(2, imatch.MIN_SHARE * len(texts)), imatch.MAX_SHARE * len(texts)
    lexicon = {xxhash.xxh64_intdigest(w) for w, n in seen.items() if low <= n <= high}
    assert set(imatch.lexicon(docs).tolist()) == lexicon
    got = {r["doc_id"]: r for r in imatch.fingerprint(docs).collect()}
    order = sorted(texts)
    for i in range(0, len(order), max(1, len(order) // 60)):
        k, n = order[i], order[(i + 1) % len(order)]
        changed = texts[k][:len(texts[k]) - len(texts[k]) // 2] + texts[n][:len(texts[k]) // 2]
        own, other, after = (plain_fingerprint(t, lexicon) for t in (texts[k], changed, texts[n]))
        unpacked = lambda c: [int.from_bytes(b, "little") for b in (bytes.fromhex(got[k][c])[j:j + 8] for j in range(0, 704, 8))]
        assert unpacked("fingerprint") == own and unpacked("edited_fingerprint") == other
        for column, b in (("near_edited", other), ("near_next", after)):
            scores = []
            for share in [range(88), *(range(8 * s, 8 * s + 8) for s in range(11))]:
                said = [j for j in share if own[j] or b[j]]
                if said and (len(said) >= imatch.LEAST_SEEN or len(share) == 88):
                    scores.append(sum(own[j] == b[j] for j in said) / len(said))
            assert abs(got[k][column] - (max(scores) if scores else 1.0)) < 1e-12


# --- perplexity ---------------------------------------------------------------------------------------------

def brute_logs(trusted, texts, order):
    """Interpolated modified Kneser-Ney with dictionaries."""
    def grams(t):
        b = bytes(order - 1) + t.lower().encode()
        return [b[i:i + order] for i in range(len(b) - order + 1)]

    counts = {}
    for t in trusted:
        for g in grams(t):
            counts[g] = counts.get(g, 0) + 1
    by_order = {order: counts}
    for n in range(order - 1, 0, -1):
        below = {}
        for g in by_order[n + 1]:
            below[g[1:]] = below.get(g[1:], 0) + 1
        by_order[n] = below

    def p(g):
        if not g:
            return 1 / 256
        c = by_order[len(g)]
        k = [sum(1 for v in c.values() if v == i) for i in (1, 2, 3, 4)]
        y = k[0] / (k[0] + 2 * k[1]) if k[0] + 2 * k[1] else 0.5
        d = [min(max(i - (i + 1) * y * k[i] / k[i - 1] if k[i - 1] else i * 0.5, 0.1), i - 0.1) for i in (1, 2, 3)]
        off = lambda v: d[min(v, 3) - 1]
        same = {h: v for h, v in c.items() if h[:-1] == g[:-1]}
        if not same:
            return p(g[1:])
        total = sum(same.values())
        own = (c[g] - off(c[g])) / total if g in c else 0.0
        return own + sum(map(off, same.values())) / total * p(g[1:])

    return [-sum(np.log(p(g)) for g in grams(t)) / len(grams(t)) if t else None for t in texts]


@pytest.mark.parametrize("hot", [1 << 18, 5, 0])
def test_perplexity_by_brute_force(spark, make, monkeypatch, hot):
    monkeypatch.setattr(quality_lm, "HOT_GRAMS", hot)
    rng = random.Random(hot)
    texts = ["".join(rng.choice("ab cé") for _ in range(rng.randint(1, 60))) for _ in range(14)]
    trusted, rows = texts[:6], [(i, t) for i, t in enumerate(texts)] + [(90, None), (91, ""), (None, "zzz"), (3, texts[3])]
    got = quality_lm.score(make(rows), make([(i, t) for i, t in enumerate(trusted)]), order=3).select("doc_id", "text", "log_perplexity")
    want = brute_logs(trusted, [t or "" for _, t in rows], 3)
    got = {(r[0], r[1]): r[2] for r in got.collect()}
    for (k, t), w in zip(rows, want):
        assert got[k, t] == (None if w is None else pytest.approx(w, abs=1e-6))


def test_judged(spark, make):
    rng = random.Random(8)
    good = [" ".join(rng.choice(["the", "cat", "sat", "on", "a", "mat"]) for _ in range(60)) for _ in range(40)]
    bad = "".join(chr(rng.randrange(33, 127)) for _ in range(300))
    docs = make([(i, t, "en", None) for i, t in enumerate(good)] + [(100, bad, "en", None), (101, None, "en", None),
                                                                    (102, "the cat", None, None)])
    keep = {r["doc_id"]: r["keep"] for r in quality_lm.judge(docs, make(list(enumerate(good)))).collect()}
    assert keep == {**{i: True for i in range(40)}, 100: False, 101: False, 102: True}
    assert quality_lm.judge(make([]), make([])).collect() == []
    assert all(r["keep"] for r in quality_lm.judge(make([(1, "x")]), make([])).collect())


@pytest.mark.parametrize("junk", [0, 30, 200])
def test_junk_does_not_move_the_threshold(spark, make, junk):
    rng = random.Random(9)
    words = {"en": ["the", "cat", "sat", "on", "a", "mat"], "de": ["der", "hund", "und", "die", "katze"]}
    prose = lambda lang: " ".join(rng.choice(words[lang]) for _ in range(60))
    good = [(i, prose("en"), "en", None) for i in range(40)] + [(i + 50, prose("de"), "de", None) for i in range(40)]
    clean = [(i + 100, prose("en"), "en", None) for i in range(30)] + [(i + 150, prose("en"), "xx", None) for i in range(3)]
    bad = [(i + 1000, "".join(chr(rng.randrange(33, 127)) for _ in range(300)), "en", None) for i in range(junk)]
    got = quality_lm.judge(make(good + clean + bad), make(good)).collect()
    assert {r["doc_id"] for r in got if not r["keep"] and r["doc_id"] >= 100} == {k for k, *_ in bad}
    assert sum(r["keep"] for r in got if r["doc_id"] < 100) >= 78


def test_halves_are_judged_by_each_other(spark, make):
    """Each model of one pass against plain models, and the thresholds against plain quartiles."""
    rng = random.Random(12)
    good = ["".join(rng.choice("ab cd") for _ in range(rng.randint(4, 30))) for _ in range(12)]
    half = [r[0] for r in spark.createDataFrame([(t,) for t in good], "t string").selectExpr("pmod(xxhash64(t), 2)").collect()]
    assert 0 < sum(half) < len(half)
    parts = [good, [t for t, h in zip(good, half) if h == 0], [t for t, h in zip(good, half) if h == 1]]
    rows = spark.createDataFrame([(m, t, i) for m in range(3) for i, t in enumerate(good)], "_model int, _text string, _k0 int")
    halves = spark.createDataFrame(list(zip(good, half)), "t string, h int")
    counts = quality_lm.count_grams(halves, "t", 3, 2, quality_lm.F.col("h"))
    counts = counts.selectExpr("gram", "n0 + n1 as n0", "n0 as n1", "n1 as n2")
    got = {(r["_model"], r["_k0"]): r["log_perplexity"] for r in quality_lm._scored(rows, counts, 3).collect()}
    for m in range(3):
        assert [got[m, i] for i in range(len(good))] == pytest.approx(brute_logs(parts[m], good, 3), abs=1e-6)


def test_thresholds_against_plain(spark):
    rng = random.Random(13)
    held = [(lang, round(rng.uniform(lo, lo + 1), 9)) for lang, lo, n in (("en", 1, 300), ("de", 2, 9), ("fr", 3, 1), (None, 1, 5))
            for _ in range(n)] + [("en", None)]

    def quarters(values):
        values = sorted(-(-v * 1000 // 1) / 1000 for v in values)
        return [next(v for i, v in enumerate(values, 1) if i / len(values) >= q) for q in (0.25, 0.75)]

    low, high = quarters([v for _, v in held if v is not None])
    limits, overall = quality_lm.thresholds(spark.createDataFrame(held, "lang string, log_perplexity double"))
    assert overall == pytest.approx(high + 3 * (high - low))
    got = {r["_lang"]: r["_top"] for r in limits.collect()}
    assert set(got) == {"en", "de", "fr", None}
    for lang, top in got.items():
        own = [v for g, v in held if g == lang and v is not None]
        a, b = quarters(own)
        w = 8 / (len(own) + 8)
        assert top == pytest.approx(b + max(high - b, 0) * w + 3 * (b - a + max(high - low - (b - a), 0) * w))
    assert quality_lm.thresholds(spark.createDataFrame([], "lang string, log_perplexity double"))[1] is None


def test_columns_named_like_results_give_way(spark, make):
    docs = make([(1, "the cat", "en", None), (1, "the cat", "en", None), (2, None, "en", None)])
    docs = docs.withColumn("keep", docs.doc_id).withColumn("Perplexity", docs.doc_id).withColumn("_text", docs.doc_id)
    got = quality_lm.judge(docs, make([(1, "the cat sat", "en", None)]))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "_text", "n_bytes", "perplexity", "threshold", "keep"]
    assert [(r["doc_id"], r["_text"], r["n_bytes"]) for r in got.orderBy("doc_id").collect()] == [(1, 1, 7), (1, 1, 7), (2, 2, 0)]


def test_steps_cover_all():
    texts = ["a" * n for n in (0, 5, 3, 30, 0, 1)]
    assert [i for a, b in steps(texts, 8) for i in range(a, b)] == list(range(6)) and list(steps([])) == []
