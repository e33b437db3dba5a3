"""Cleaning functions for mail texts. All stay inside the JVM; none moves rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailprep import fixed as X
from mailprep.functions.dialect import (NO_LETTER, SPACE, after_first, any_of, let, lines, regex, remove, strip,
                                        unlines, words)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def header_field(line: Column) -> Column:
    """Which reply-header field a line opens ("from", "sent", ...), or null."""
    every = [w for ws in X.HEADER_WORDS.values() for w in ws]
    word = F.regexp_extract(F.lower(line), regex(rf"^\s*({'|'.join(every)}):", "u"), 1)

    def choose(w: Column) -> Column:
        chosen = F.lit(None).cast("string")
        for field, ws in reversed(X.HEADER_WORDS.items()):
            chosen = F.when(w.isin(ws), field).otherwise(chosen)
        return chosen

    return let(word, choose)


def strip_flexible_reply_header(c: Column | str, min_matches: int = X.MIN_HEADER_FIELDS,
                                max_scan_lines: int = X.HEADER_SCAN_LINES) -> Column:
    """Cut a reply header found in the last lines: keep from its subject line, else what follows it."""
    def cut(text: Column, all_lines: Column) -> Column:
        tail_from = F.greatest(F.size(all_lines) - (max_scan_lines - 1), F.lit(1))
        fields = F.transform(F.slice(all_lines, tail_from, F.lit(max_scan_lines)), header_field)

        def decide(found: Column) -> Column:
            subject = F.array_position(found, "subject").cast("int")
            last = F.array_max(F.transform(found, lambda f, i: F.when(f.isNotNull(), i + 1)))
            start = tail_from - 1 + F.when(subject > 0, subject).otherwise(last + 1)
            kinds = F.size(F.array_distinct(F.array_compact(found)))
            kept = strip(unlines(F.slice(all_lines, start, F.size(all_lines))))
            return F.when(kinds >= min_matches, kept).otherwise(text)

        return let(fields, decide)

    # every header line holds a colon, which is cheap to count
    colons = lambda text: F.char_length(text) - F.char_length(F.replace(text, F.lit(":"), F.lit("")))
    return let(col(c), lambda text: F.when(colons(text) < min_matches, text).otherwise(
        let(lines(text), lambda all_lines: cut(text, all_lines))))


def remove_empty_lines(c: Column | str) -> Column:
    blank = F.regexp_replace(col(c), r"(?m)(?d)^[ \t]++$\n?", "")
    return strip(F.regexp_replace(blank, regex(r"\n\s*\n", "u"), "\n"))


def reduce_spaces(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"[ \t]+", " ")


def remove_non_printable(c: Column | str) -> Column:
    return F.regexp_replace(col(c), NO_LETTER + X.INVISIBLE, "")


def remove_http_brackets(c: Column | str) -> Column:
    return remove(col(c), X.LINK_IN_BRACKETS)


def clean_thread_ids(c: Column | str) -> Column:
    """Drop thread marks line by line and strip every line."""
    subject = regex(rf"^\s*{any_of(X.HEADER_WORDS['subject'])}:", "u")

    def clean_line(line: Column) -> Column:
        bare = remove(remove(line, X.THREAD_IN_BRACKETS), X.THREAD_MARK)
        # dropping a mark can join two halves of another one; on subject lines that one goes as well
        again = let(bare, lambda b: F.when(F.lower(b).rlike(subject), remove(b, X.THREAD_IN_BRACKETS)).otherwise(b))
        return strip(F.when(F.instr(F.lower(line), "thread::") > 0, again).otherwise(line))

    return unlines(F.transform(lines(col(c)), lambda line: clean_line(line)))


def remove_cid(c: Column | str) -> Column:
    return remove(col(c), X.CID_IN_BRACKETS)


# Java looks for a fixed first character much faster than for one of many words, so the patterns below lead
# with the line feed, dash or colon, and rare parts are looked for first: most mails have no such header.

def block_header_rest(text: Column) -> Column:
    """What follows a from/sent/urgency/to/subject block; null without one.

    Each link takes the first place it fits and never goes back. That finds the same end as trying
    every combination, because an earlier place only leaves more text to the links after it.
    """
    rest = after_first(text, any_of(X.BLOCK_FROM))
    for link in ("\n" + any_of(X.BLOCK_SENT), "\n" + any_of(X.BLOCK_URGENCY), any_of(X.BLOCK_TO),
                 "\n" + any_of(X.BLOCK_SUBJECT), "\n"):
        rest = after_first(rest, link)
    return F.when(text.rlike(regex("\n" + any_of(X.BLOCK_URGENCY))), rest)


def banner_rest(text: Column) -> Column:
    """What follows a dashed "original message" banner; null without one."""
    return after_first(text, rf"-(?<!--)-++\s*+{any_of(X.BANNER_PHRASES)}\s*+-++")


def wrote_rest(text: Column) -> Column:
    """What follows an "On ... wrote:" line; null without one."""
    verb = rf":(?<={any_of(X.WROTE_VERBS)}:)"
    rest = after_first(after_first(text, any_of(X.WROTE_OPENERS) + r"\s"), verb)
    return F.when(text.rlike(regex(verb)), rest)


def strip_known_reply_headers(c: Column | str) -> Column:
    return let(col(c), lambda t: F.coalesce(strip(block_header_rest(t)), strip(banner_rest(t)),
                                            strip(wrote_rest(t)), t))


def remove_html(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"<[^>]++>", " ")


def discard_patterns(organisation: str = r"\S+") -> list[tuple[str, bool]]:
    return X.DISCARDS + [(X.CONFIDENTIALITY_NOTICE.replace("{organisation}", organisation), True)]


def apply_discard_patterns(c: Column | str, patterns: list[tuple[str, bool]] | None = None) -> Column:
    """Delete banners and disclaimers; ``patterns`` are (regex, dot crosses lines) pairs."""
    return reduce(lambda t, p: remove(t, p[0], "ius" if p[1] else "iu"),
                  discard_patterns() if patterns is None else patterns, col(c))


# a whole line that is only an address, a number, a site, a job title or a street
CONTACT_LINE = regex(
    "^(?:" + "|".join([X.EMAIL, X.PHONE, X.DOMAIN, any_of(X.JOB_TITLES),
                       rf"\d{{1,5}}[ ,\-]?\s*{any_of(X.STREET_WORDS)}(?:[^\p{{L}}\p{{N}}_\n].*)?"]) + r")\z")


def remove_sensitive_lines(c: Column | str) -> Column:
    return unlines(F.filter(lines(col(c)), lambda line: ~strip(line).rlike(CONTACT_LINE)))


# The same contact patterns for use inside a text. A long unbroken run of letters or dashes must not be
# tried again from each of its characters, so a match may start only where the run starts, where the
# previous match ended (\G), or at one of the fixed prefixes. Where no match can begin is told by one look at a character.
_PHONE_GAP = rf"[{SPACE}:=\-]"
_IN_TEXT = {
    "EMAIL": r"(?:\G|(?<![A-Z0-9._%+-]))[A-Z0-9._%+-]++@[A-Z0-9.-]+\.[A-Z]{2,}",
    "PHONE": rf"(?![abcdeghjlmnoqrtuvwxyz])(?=[pf+(\d{SPACE}:=\-])(?:(?:phone|fax){_PHONE_GAP}*+|(?:\G|(?<!{_PHONE_GAP})){_PHONE_GAP}*+)"
             r"\+?\(?\d{1,4}\)?[\d\s\-/.]{5,}",
    "DOMAIN": r"(?:https?://(?:www\.)?[a-z0-9\-]+|www\.[a-z0-9\-]+|(?:\G|(?<![a-z0-9\-]))[a-z0-9\-]++)"
              r"\.(?:com|net|org|edu|gov|[a-z]{2,})(?:/\S*)?",
    "TITLE": "(?=" + "".join(f"[{''.join(sorted({w[i] for w in X.JOB_TITLES}))}]" for i in range(min(map(len, X.JOB_TITLES)))) + ")"
             + any_of(X.JOB_TITLES),
}
# what every match holds and is found faster: texts without it are spared the search
_HOLDS = {"EMAIL": "@", "PHONE": r"\d\)?[\d\s\-/.]{5}", "DOMAIN": r"\.[a-z]{2}"}


def redact(c: Column | str, mode: str = "drop") -> Column:
    """Remove contact details inside a text (``drop``) or put a mark such as [EMAIL] there (``token``)."""
    if mode not in ("drop", "token"):
        raise ValueError(f"mode must be 'drop' or 'token', not {mode!r}")
    def drop(t: Column, kind: str) -> Column:
        done = F.regexp_replace(t, regex(_IN_TEXT[kind]), f"[{kind}]" if mode == "token" else "")
        return F.when(t.rlike(regex(_HOLDS[kind])), done).otherwise(t) if kind in _HOLDS else done

    return reduce(lambda t, kind: let(t, lambda x: drop(x, kind)), _IN_TEXT, col(c))


def clean_crlf(c: Column | str) -> Column:
    blank = reduce(lambda t, sign: F.replace(t, F.lit(sign), F.lit(" ")), "\n\r", col(c))
    return F.coalesce(strip(blank), F.lit(""))


def last_valid_sentence(c: Column | str) -> Column:
    """The last sentence of eight or more words that ends in . ! or ?; else the first twenty words."""
    def full(sentence: Column) -> Column:
        ends = F.right(sentence, F.lit(1)).isin(".", "!", "?")
        return ends & (F.size(words(sentence, X.MIN_SENTENCE_WORDS)) >= X.MIN_SENTENCE_WORDS)

    def choose(text: Column) -> Column:
        def last(sentences: Column) -> Column:  # mostly the very last one is full, and no other is looked at
            ending = let(F.element_at(sentences, -1), lambda s: F.when(full(s), s))
            return F.coalesce(ending, F.try_element_at(F.filter(sentences, full), F.lit(-1)))

        return F.coalesce(let(F.split(text, regex(NO_LETTER + r"(?<=[.!?])\s+", "u")), last),
                          F.array_join(words(text, X.FALLBACK_WORDS), " "), F.lit(""))

    return let(strip(col(c)), choose)


def truncate_tokens(c: Column | str, n: int = X.MAX_MODEL_TOKENS) -> Column:
    """The first ``n`` words: the input size of the classifier."""
    return F.array_join(words(col(c), n), " ")


def body_as_text(c: Column | str) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit("nan"))


CLEANING_STEPS = [strip_flexible_reply_header, remove_empty_lines, reduce_spaces, remove_non_printable,
                  remove_http_brackets, clean_thread_ids, remove_cid, strip_known_reply_headers, remove_html,
                  apply_discard_patterns, remove_sensitive_lines, strip]


def clean_text(c: Column | str) -> Column:
    """The whole cleaning chain; null becomes ''."""
    return F.coalesce(reduce(lambda text, step: step(text), CLEANING_STEPS, col(c)), F.lit(""))
