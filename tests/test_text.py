"""Text functions on literal texts; the expected results are worked out by hand."""

import pytest
from pyspark.sql import functions as F

from mailprep import fixed as X
from mailprep.functions import text as tx
from mailprep.functions.dialect import any_of, hundredths, lines, percent_text, regex, strip, words

HEADER = "From: a\nSent: b\nSubject: c"
CASES = [
    # last header block: keep from the subject line on
    (tx.strip_flexible_reply_header, "Hi\nFrom: a\nSent: b\nTo: c\nSubject: d\nrest", "Subject: d\nrest"),
    # no subject: keep what follows the last header line
    (tx.strip_flexible_reply_header, "Hi\nVan: a\nVerzonden: b\nAan: c\n rest ", "rest"),
    (tx.strip_flexible_reply_header, "Hi\nVan: a\nVerzonden: b\nAan: c", ""),
    # two kinds are not enough, however often they occur
    (tx.strip_flexible_reply_header, "From: a\nTo: b\nTo: c\nrest", "From: a\nTo: b\nTo: c\nrest"),
    # a space before the colon is no header
    (tx.strip_flexible_reply_header, "De : a\nEnvoyé : b\nObjet : c", "De : a\nEnvoyé : b\nObjet : c"),
    # upper case, indented, other scripts
    (tx.strip_flexible_reply_header, "x\n  ENVOYÉ: a\n差出人: b\n件名: c\nend", "件名: c\nend"),
    # only the last thirty lines count
    (tx.strip_flexible_reply_header, HEADER + "\n" + "\n".join("abcdefghijklmnopqrstuvwxyzABCDE"[:28]),
     HEADER + "\n" + "\n".join("abcdefghijklmnopqrstuvwxyzABCDE"[:28])),
    (tx.strip_flexible_reply_header, HEADER + "\n" + "\n".join("abcdefghijklmnopqrstuvwxyzA"),
     "Subject: c\n" + "\n".join("abcdefghijklmnopqrstuvwxyzA")),
    (tx.strip_flexible_reply_header, "", ""),
    (tx.remove_empty_lines, "a\n \t\n\n\nb\n  \n", "a\nb"),
    (tx.remove_empty_lines, "a\n\u2003\nc", "a\nc"),
    (tx.remove_empty_lines, "\r\na\r\n\r\nb", "a\r\nb"),
    (tx.reduce_spaces, "a \t  b\n\tc  d", "a b\n c  d"),
    (tx.remove_non_printable, "a\x00b​c﻿d\x85e\tf\r\ng\x7f", "abcde\tf\r\ng"),
    (tx.remove_http_brackets, "x [HTTPS://a.b/c d] y [ftp://k]", "x  y [ftp://k]"),
    (tx.clean_thread_ids, "a [ thread::Ab1:: ] b\r\n  thread::x9::  \nthread::q]z end", "a  b\n\n]z\nend"),
    (tx.clean_thread_ids, "Subject: [ thrthread::x::ead::z ] t", "Subject:  t"),
    (tx.clean_thread_ids, "Other: [ thrthread::x::ead::z ] t", "Other: [ thread::z ] t"),
    (tx.clean_thread_ids, "a\n", "a"),
    (tx.remove_cid, "x [CID:im g] y [cid:[cid:a]b]", "x  y b]"),
    (tx.strip_known_reply_headers, "i\nFrom: x\nSent: y\nImportance: h\nTo: z\nSubject: w\n body ", "body"),
    (tx.strip_known_reply_headers, "i\nFrom: x\nSent: y\nTo: z\nSubject: w\nbody", "i\nFrom: x\nSent: y\nTo: z\nSubject: w\nbody"),
    (tx.strip_known_reply_headers, "Hi\n---- Original MESSAGE ----- rest -- original message --", "rest -- original message --"),
    (tx.strip_known_reply_headers, "Hi - original message - x", "Hi - original message - x"),
    (tx.strip_known_reply_headers, "On Monday Bob wrote: hello", "hello"),
    (tx.strip_known_reply_headers, "He wrote: on Monday", "He wrote: on Monday"),
    (tx.strip_known_reply_headers, "Le 3 mai, X a ÉCRIT: \nbonjour", "bonjour"),
    (tx.remove_html, "<p>a</p> 1 < 2 <b\nc>", " a  1  "),
    (tx.apply_discard_patterns, "a ATTENTION: this is an external email\n keep SAFE. b", "a  b"),
    (tx.apply_discard_patterns, "Please consider the environment\nbefore this email.", "Please consider the environment\nbefore this email."),
    (tx.apply_discard_patterns, "x This message and any attachments are intended only for the addressee. More", "x . More"),
    (tx.apply_discard_patterns, "see https://checkpoint.url-protection.com/v1/abc?x=1 now", "see  now"),
    (tx.remove_sensitive_lines,
     "keep me\n bob@example.com \n+32 123 456 789\nPhone: 0123 456 789\nMANAGER\nwww.example.com\nhttps://a-b.org/x?y\n"
     "12 street north\n2024-01-01\nword.word\n\nwww.example.co.uk\nMain street 12\nfoo bob@example.com",
     "keep me\n\nwww.example.co.uk\nMain street 12\nfoo bob@example.com"),
    (tx.remove_sensitive_lines, "12 streets\n12 street_x\n12 street, x", "12 streets\n12 street_x"),
    (tx.clean_crlf, " a\r\nb\n", "a  b"),
    (tx.last_valid_sentence, "One two three four five six seven eight. Short one.", "One two three four five six seven eight."),
    (tx.last_valid_sentence, "One two three four five six seven. Not long enough", "One two three four five six seven. Not long enough"),
    (tx.last_valid_sentence, " ".join(str(i) for i in range(30)), " ".join(str(i) for i in range(20))),
    (tx.last_valid_sentence, "a b c d e f g h! \n1 2 3 4 5 6 7 8? x", "1 2 3 4 5 6 7 8?"),
    (tx.last_valid_sentence, "  ", ""),
    (lambda c: tx.truncate_tokens(c, 3), " a b\nc d ", "a b c"),
    (tx.clean_text, "<p>Dear  all</p>\n\n[cid:i1]\nbob@example.com\nThanks​", "Dear all \n\nThanks"),
    (tx.body_as_text, "x", "x"),
]


def value(spark, fn, text):
    return spark.createDataFrame([(text,)], "t string").select(fn(F.col("t"))).first()[0]


@pytest.mark.parametrize("fn,text,expected", CASES)
def test_case(spark, fn, text, expected):
    assert value(spark, fn, text) == expected


def test_nulls(spark):
    assert value(spark, tx.clean_text, None) == ""
    assert value(spark, tx.clean_crlf, None) == ""
    assert value(spark, tx.last_valid_sentence, None) == ""
    assert value(spark, tx.body_as_text, None) == "nan"
    for fn in tx.CLEANING_STEPS:
        assert value(spark, fn, None) is None


def test_redact(spark):
    text = "ask a.b@c.de1@x.org, call: +32 123 456 78 - or see xhttps://www.a-b.com/p?q www.1a.com and the Manager"
    assert value(spark, tx.redact, text) == "ask , callor see x  and the "
    assert value(spark, lambda c: tx.redact(c, "token"), text) == (
        "ask [EMAIL][EMAIL], call[PHONE]or see x[DOMAIN] [DOMAIN] and the [TITLE]")
    with pytest.raises(ValueError):
        tx.redact("t", "other")


def test_strip_takes_every_unicode_space(spark):
    spaces = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0       　"
    assert value(spark, strip, spaces + "a​" + spaces) == "a​"


def test_lines_and_words(spark):
    for text in ["", "a", "a\n", "a\n\n", "\r\na\rb\r\n", "a\x0bb\x0cc\x1cd\x1de\x1ef\x85g h i", "\n"]:
        assert value(spark, lines, text) == text.splitlines()
    assert value(spark, words, " a b\x1fc ") == ["a", "b", "c"]
    assert value(spark, lambda c: words(c, 2), "a b c d") == ["a", "b"]


def test_long_unbroken_runs_stay_fast(spark):
    import time
    text = "a" * 60_000 + " " + "-" * 60_000 + " " + " " * 60_000 + "<" * 20_000
    start = time.time()
    assert value(spark, tx.clean_text, text) is not None
    assert value(spark, tx.redact, text) is not None
    assert time.time() - start < 20


def test_percent(spark):
    rows = [(1, 800, "0.12%"), (3, 800, "0.38%"), (1, 3, "33.33%"), (2, 3, "66.67%"), (5, 5, "100.00%"), (0, 7, "0.00%")]
    df = spark.createDataFrame(rows, "n long, t long, p string")
    for r in df.select("p", percent_text(F.col("n"), F.col("t")).alias("got"), hundredths(F.col("n"), F.col("t"))).collect():
        assert r["got"] == r["p"]


def test_results_do_not_grow(spark):
    from mailprep.plans.views import mails
    from tests.conftest import SF_DIR
    rows = mails(spark, SF_DIR).select("body", tx.clean_text("body").alias("c")).filter("body IS NOT NULL")
    assert rows.filter("length(c) > length(body)").count() == 0
    for fn in (tx.reduce_spaces, tx.remove_non_printable, tx.remove_html):
        once = rows.select(fn("body").alias("b"))
        assert once.filter(F.col("b") != fn("b")).count() == 0


def test_redaction_guards_spare_no_match(spark):
    """Texts that a guard spares hold nothing that the plain patterns find, whatever the signs beside it."""
    pieces = ["a.co", "x@y.de", "+32 (12) 34-56", "1234)  -/.", "1)12345", "12 34", "٣٤٥٦٧٨", "ſpecialist", "Keo", "CEO", "lead", ". a", ".ab", "phone: 12345 6"]
    texts = [a + sep + b for a in pieces for b in pieces for sep in ("", " ", "\n", ".")]
    rows = spark.createDataFrame([(t,) for t in [*texts, "", None]], "t string").repartition(1)
    plain = F.col("t")
    for kind, pattern in tx._IN_TEXT.items():
        free = pattern.removeprefix("(?![abcdeghjlmnoqrtuvwxyz])") if kind == "PHONE" else any_of(X.JOB_TITLES) if kind == "TITLE" else pattern
        plain = F.regexp_replace(plain, regex(free), f"[{kind}]")
    assert set(tx._HOLDS) == {"EMAIL", "PHONE", "DOMAIN"}
    assert rows.filter(~tx.redact("t", "token").eqNullSafe(plain)).collect() == []


def test_last_sentence_looks_back_past_short_ones(spark):
    long = "one two three four five six seven eight."
    texts = [f"{long} Short. ", f"{long} no end of this one at all or ever", f"Nine {long} {long}\r\n", "a. b. c.", "", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").repartition(1).select(tx.last_valid_sentence(tx.clean_crlf("t"))).collect()
    assert [r[0] for r in got] == [long, long, long, "a. b. c.", "", ""]
