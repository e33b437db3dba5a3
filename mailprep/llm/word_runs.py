"""Periodic runs of words, caught while a text grows.

A run's first period holds an aligned block of 2^l words that comes again one period later, for the level l with
2^(l+1) - 1 <= period <= 2^(l+2) - 2. So every completed block has a catcher for those periods: words that are appended
advance the comparison of the text's newest 2^l words with the two blocks that lie that far back. What agrees is a
square in the making: it is followed to the left at once and to the right as words come, and squares of one start and
period are one run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailprep.llm.common import filled, steps

LEAST = 24             # words of a run at least
TIMES = 3              # and periods
APPEND = 1 << 16       # words that are appended at a time
SPLIT_BYTES = 1 << 20  # bytes of a text whose words are held as objects at a time
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _value(ids: np.ndarray) -> np.ndarray:
    h = (ids.astype("u8") + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


class Catchers:
    """The squares of a sequence that grows by ``append``. ``runs`` gives its runs so far.

    Words are numbers. Stretches of words are compared by sums of one running hash; what is reported is compared word
    by word. ``longest`` bounds the length of a run, ``size`` the length of the sequence.
    """

    def __init__(self, size: int, longest: int | None = None):
        self.n, self.longest = 0, size if longest is None else longest
        self.ids = np.zeros(size, "i8")
        self.powers, self.back = (np.full(size + 1, x, "u8") for x in (_BASE, _INVERSE))
        self.powers[0] = self.back[0] = 1
        self.powers, self.back = np.cumprod(self.powers), np.cumprod(self.back)
        self.sums = np.zeros(size + 1, "u8")
        self.done = [np.zeros(0, "i8")] * 3   # start, end, period of stretches that ended
        self.open = [np.zeros(0, "i8")] * 3   # and of those that reach the end of the sequence

    def _same(self, i: np.ndarray, j: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Whether k words from i on equal those from j on, j > i."""
        s = self.sums
        return (s[i + k] - s[i]) * self.powers[j - i] == s[j + k] - s[j]

    def _ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on, to the end of the sequence."""
        low, high = np.zeros(len(i), "i8"), self.n - j
        while (low < high).any():
            mid = (low + high + 1) >> 1
            ok = self._same(i, j, mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return low

    def _behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i equal those before j."""
        low, high = np.zeros(len(i), "i8"), i.copy()
        while (low < high).any():
            mid = (low + high + 1) >> 1
            ok = self._same(i - mid, j - mid, mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return low

    def append(self, ids: np.ndarray) -> None:
        old, self.n = self.n, self.n + len(ids)
        n = self.n
        self.ids[old:n] = ids
        self.sums[old + 1:n + 1] = self.sums[old] + np.cumsum(_value(ids) * self.powers[old:n])
        start, end, period = self.open  # suffixes that the new words may carry on
        self._keep(start, end + self._ahead(end - period, end), period, [np.zeros(0, "i8")] * 3)
        block = 1
        while TIMES * (2 * block - 1) <= self.longest:
            self._catch(old, block)
            block *= 2

    def _catch(self, old: int, block: int) -> None:
        """Meet the windows of ``block`` words that the last append completed with the blocks a period before them."""
        n, least = self.n, 2 * block - 1
        first = max(old - block + 1, least)
        if first > n - block:
            return
        base = max(0, first - 4 * block)
        at = np.arange(base, n - block + 1)
        window = (self.sums[at + block] - self.sums[at]) * self.back[at]
        j = at[first - base:]
        newest = ((j - least) // block) * block
        for b in (newest, newest - block):
            hit = np.flatnonzero((window[np.maximum(b - base, 0)] == window[j - base]) & (b >= 0))
            if len(hit):
                self._follow(b[hit], j[hit], block)

    def _follow(self, b: np.ndarray, j: np.ndarray, block: int) -> None:
        period = j - b
        # within a stretch of a period that divides this one nothing has this one as its smallest
        starts, reach, of = self._reach()
        if len(starts):
            k = np.searchsorted(starts, b, "right") - 1
            d = of[k]
            free = (k < 0) | (reach[k] < j + block) | (period % d != 0) | (d == period)
            b, j, period = b[free], j[free], period[free]
        # a block in a run's first period agrees at least this far; it may still be open at the sequence's end
        need = np.maximum(LEAST, TIMES * period) - 2 * period + block
        far = self._same(b, j, np.minimum(need, self.n - j))
        b, j, period = b[far], j[far], period[far]
        if len(b):
            start = b - self._behind(b, j)
            key = np.unique(np.stack([start, period, j], 1), axis=0)
            fresh = np.concatenate([[True], (key[1:, :2] != key[:-1, :2]).any(1)])
            start, period, j = key[fresh].T
            self._keep(start, j + self._ahead(j - period, j), period, self.open)

    def _reach(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the known stretches by start: how far any up to there reaches, and the period of that one."""
        start, end, period = (np.concatenate(x) for x in zip(self.done, self.open))
        order = np.lexsort((-period, end, start))
        start, end, period = start[order], end[order], period[order]
        if not len(start):
            return start, end, period
        top = np.maximum.accumulate(end)
        best = np.maximum.accumulate(np.where(end == top, np.arange(len(end)), 0))
        return start, end[best], period[best]

    def _keep(self, start: np.ndarray, end: np.ndarray, period: np.ndarray, others: list[np.ndarray]) -> None:
        """Sort stretches: those that end with the sequence stay open, the others are done if long enough."""
        last = end == self.n
        found = np.concatenate([np.stack(others, 1), np.stack([start, end, period], 1)[last]])
        self.open = list(np.unique(found, axis=0).T)
        ended = ~last & (end - start >= np.maximum(LEAST, TIMES * period))
        if ended.any():
            found = np.concatenate([np.stack(self.done, 1), np.stack([start, end, period], 1)[ended]])
            self.done = list(np.unique(found, axis=0).T)

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, end, period) of the runs, by start and period."""
        least: dict[tuple[int, int], int] = {}
        for start, end, period in zip(*(np.concatenate(x).tolist() for x in zip(self.done, self.open))):
            for s, e in self._exact(start, end, period):
                if e - s >= max(LEAST, TIMES * period):
                    least[s, e] = min(period, least.get((s, e), period))
        return sorted((s, e, p) for (s, e), p in least.items())

    def _exact(self, start: int, end: int, period: int) -> list[tuple[int, int]]:
        """The stretches of this period within one, word by word: the same one but where a hash was wrong."""
        same = self.ids[start:end - period] == self.ids[start + period:end]
        if same.all():
            return [(start, end)]
        edge = np.flatnonzero(np.diff(np.concatenate([[0], same.astype("i1"), [0]])))
        return [(start + a, start + z + period) for a, z in zip(edge[::2].tolist(), edge[1::2].tolist())]


def words(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lists of bounded size. Words stand between ASCII white space."""
    start = 0
    while start < len(raw):
        stop = start + SPLIT_BYTES
        while stop < len(raw) and raw[stop] not in b" \t\n\v\f\r":
            stop += 1
        yield raw[start:stop].split()
        start = stop


def runs_of(texts: list[str]) -> list[tuple[list[tuple[int, int, int]], bytes]]:
    """Of each text: its runs (start, length, period) by start and period, and what is left without their repeats."""
    names: dict[bytes, int] = {}
    raw = [t.encode() for t in texts]
    parts, lengths = [], []
    for i, r in enumerate(raw):
        own = [np.fromiter((names.setdefault(w, len(names)) for w in ws), "i8") for ws in words(r)]
        parts += [*own, np.array([-1 - i])]  # a word of its own after each text: nothing runs across
        lengths.append(sum(map(len, own)))
    ids = np.concatenate(parts)
    all_words = Catchers(len(ids), max(lengths))
    for at in range(0, len(ids), APPEND):
        all_words.append(ids[at:at + APPEND])
    ends = np.cumsum(np.array(lengths) + 1)
    found: dict[int, list[tuple[int, int, int]]] = {}
    for s, e, p in all_words.runs():
        i = int(np.searchsorted(ends, s, "right"))
        found.setdefault(i, []).append((s - int(ends[i]) + lengths[i] + 1, e - s, p))
    return [(found.get(i, []), _without(r, lengths[i], found.get(i, []))) for i, r in enumerate(raw)]


def _without(raw: bytes, n: int, runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(b" ".join(ws) for ws in words(raw) if ws)
    edge = np.zeros(n + 1, "i8")
    for s, length, p in runs:
        edge[s + p] += 1
        edge[s + length] -= 1
    kept, at, out = np.cumsum(edge) == 0, 0, []
    for ws in words(raw):
        out += [w for w, k in zip(ws, kept[at:at + len(ws)].tolist()) if k]
        at += len(ws)
    return b" ".join(out)


def word_runs(docs: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """``docs`` with the runs of words of each text and the text without their repeats instead of the text.

    A run is a longest stretch of words with a smallest period, of ``LEAST`` words and ``TIMES`` periods at least:
    ``runs`` is an array of (start, length, period) in words, from 0, by start and period. ``collapsed`` holds the words
    that no run repeats, joined by one space. Null, empty and white-space texts have no runs and an empty rest. Every
    row is judged by itself, so repeated rows have equal results; columns other than ``text`` come through, but a
    column that bears one of the two new names goes. An empty table gives an empty result.
    """
    rest = [c for c in docs.columns if c not in (text, runs, collapsed)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            texts = filled(f["text"])
            for a, b in steps(texts):
                found = runs_of(texts[a:b])
                out = f.iloc[a:b][["row"]].copy()
                out["runs"] = [[{"start": s, "length": n, "period": p} for s, n, p in r] for r, _ in found]
                out["collapsed"] = [c.decode() for _, c in found]
                yield out

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest] or [F.lit(0).alias("_")]).alias("row"),
                       F.col(f"`{text}`").cast("string").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    done = rows.mapInPandas(run, f"row {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    return done.select(*[F.col(f"row.`{c}`").alias(c) for c in rest], F.col("runs").alias(runs), F.col("collapsed").alias(collapsed))
