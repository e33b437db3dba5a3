r"""Text rules shared by all column functions.

Mail texts follow Unicode rules: every Unicode space counts as white space, only a line feed ends a
line for a dot, and letters are compared without case in all scripts. Java's defaults differ, so no
function writes ``\s`` or ``trim`` directly; they use the helpers below.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# white space as a regex class body, and as the list of its characters
SPACE = (r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
SPACE_CHARS = "".join(chr(c) for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
                                        *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
# Java asks the parts of a class with ranges one after the other, but looks single ASCII characters up in a table. Led by
# this, a class without letters and digits is asked at few places only. (i, k and s are no such characters in any case.)
NO_LETTER = "(?![ABCDEFGHJLMNOPQRTUVWXYZabcdefghjlmnopqrtuvwxyz0123456789])"
LINE_BREAK = NO_LETTER + r"[\n-\r\x1c-\x1e\x85\x{2028}\x{2029}](?:(?<=\r)\n)?"  # \r\n is one break


def regex(pattern: str, flags: str = "iu") -> str:
    """A pattern for Java: our white space and digits, and a dot that stops at line feeds only.

    Give ``s`` in ``flags`` for a dot that crosses lines and drop ``i`` for exact case.
    """
    out, inside, at = [], False, 0
    while at < len(pattern):
        two = pattern[at:at + 2]
        if two == r"\s":
            out.append(SPACE if inside else f"[{SPACE}]")
        elif two == r"\S":
            out.append(f"[^{SPACE}]")
        elif two == r"\d":
            out.append(r"\p{Nd}")
        elif two[0] == "\\":
            out.append(two)
        else:
            if two[0] in "[]":
                inside = two[0] == "["
            out.append(two[0])
            at -= 1
        at += 2
    return f"(?{flags}d)" + "".join(out)


def any_of(words: Iterable[str]) -> str:
    """An alternation of literal words (none of ours holds a regex sign)."""
    return "(?:" + "|".join(words) + ")"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    Catalyst would paste the whole expression at every use; a one-element array binds it instead.
    """
    return F.get(F.transform(F.array(value), lambda bound: body(bound)), F.lit(0))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACE_CHARS))


def lines(c: Column) -> Column:
    """The lines of a text; a break at the very end opens no further line."""
    return let(F.split(c, LINE_BREAK),
               lambda parts: F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1))
               .otherwise(parts))


def unlines(c: Column) -> Column:
    return F.array_join(c, "\n")


def words(c: Column, at_most: int | None = None) -> Column:
    """The white-space separated words. The text '' yields ['']: count with ``word_count``."""
    cut = F.split(strip(c), regex(NO_LETTER + r"\s+", "u"), -1 if at_most is None else at_most + 1)
    return cut if at_most is None else F.slice(cut, 1, at_most)


def remove(c: Column, pattern: str, flags: str = "iu") -> Column:
    return F.regexp_replace(c, regex(pattern, flags), "")


def after_first(c: Column, pattern: str, flags: str = "iu") -> Column:
    """What follows the first match, or null when there is none."""
    return F.get(F.split(c, regex(pattern, flags), 2), F.lit(1))


def hundredths(n: Column, total: Column) -> Column:
    """100 * n / total in hundredths of a percent, rounded half to even, by whole numbers only."""
    part = n.cast("long") * F.lit(10000).cast("long")
    whole = F.call_function("div", part, total)
    twice = (part % total) * 2
    up = (twice > total) | ((twice == total) & (whole % 2 == 1))
    return whole + F.when(up, 1).otherwise(0)


def percent_text(n: Column, total: Column) -> Column:
    h = hundredths(n, total)
    return F.concat(F.call_function("div", h, F.lit(100)).cast("string"), F.lit("."),
                    F.lpad((h % 100).cast("string"), 2, "0"), F.lit("%"))
