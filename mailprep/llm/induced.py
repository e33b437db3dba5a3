"""Induced suffix sorting of one shard, in bulk steps, with queues that go to disk when they outgrow their memory."""

from __future__ import annotations

import tempfile

import numpy as np

END, GAP = 0, 1           # the text's end and the sign between pieces; bytes are moved up by two
QUEUE_BYTES = 64 << 20    # what the queues of a pass keep in memory

Array = np.ndarray


def as_text(pieces: list[bytes]) -> tuple[Array, Array]:
    """One text of all pieces, a gap after each and an end after the last, and where each piece starts.

    The pieces are parts of UTF-8 texts, in which no byte lies above 244.
    """
    lengths = np.array([len(p) + 1 for p in pieces], "i8")
    raw = np.frombuffer(b"\xfe".join([*pieces, b""]) + b"\xff", "u1")
    return np.where(raw == 254, GAP, np.where(raw == 255, END, raw + 2)).astype("u1"), np.cumsum(lengths) - lengths


class Queues:
    """One first-in-first-out queue of positions per sign. A priority queue whose order is (sign, arrival).

    Both passes of the induction push in the order in which their output comes, so arrival is the order of the
    suffixes within a sign. Full queues are written out behind each other to a file without a name that ends with the
    task; every queue remembers its stretches of it.
    """

    def __init__(self, memory: int = QUEUE_BYTES):
        self.memory, self.held = memory, 0
        self.here: list[list[Array]] = [[] for _ in range(256)]
        self.away: list[list[tuple[int, int]]] = [[] for _ in range(256)]
        self.file = None

    def push(self, signs: Array, positions: Array) -> None:
        order = np.argsort(signs, kind="stable")
        signs, positions = signs[order], positions[order]
        edges = np.flatnonzero(np.concatenate([[True], signs[1:] != signs[:-1], [True]])) if len(signs) else [0]
        for a, b in zip(edges[:-1], edges[1:]):
            self.here[signs[a]].append(positions[a:b])
        self.held += positions.nbytes
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for sign, parts in enumerate(self.here):
            if parts:
                block = np.concatenate(parts)
                self.away[sign].append((self.file.tell(), len(block)))
                self.file.write(block.tobytes())
        self.here, self.held = [[] for _ in range(256)], 0

    def pop(self, sign: int) -> Array:
        """All positions of a sign by arrival; the queue is empty then."""
        parts = []
        for at, n in self.away[sign]:
            self.file.seek(at)
            parts.append(np.frombuffer(self.file.read(8 * n), "i8"))
        parts += self.here[sign]
        self.held -= sum(p.nbytes for p in self.here[sign])
        self.here[sign], self.away[sign] = [], []
        return np.concatenate(parts) if parts else np.zeros(0, "i8")


def _types(text: Array) -> Array:
    """Whether each suffix is smaller than its successor (S); the end counts as S."""
    change = text[1:] != text[:-1]
    run = np.concatenate([[0], np.cumsum(change)])
    first = text[np.concatenate([[True], change])]
    return np.concatenate([first[:-1] < first[1:], [True]])[run]


def _refined(rank: Array, among: Array, word: Array) -> Array:
    """Order the members ``among`` of equal-rank groups by ``word``, in place; returns those that are still equal."""
    order = np.lexsort((word, rank[among]))
    who, word = among[order], word[order]
    old = rank[who]
    group = np.concatenate([[True], old[1:] != old[:-1]])
    at = np.arange(len(who))
    place = old + at - at[group][np.cumsum(group) - 1]
    fresh = group | np.concatenate([[True], word[1:] != word[:-1]])
    rank[who] = place[fresh][np.cumsum(fresh) - 1]
    alone = fresh & np.concatenate([fresh[1:], [True]])
    return who[~alone]


def _named(text: Array, stars: Array, depth: int) -> Array:
    """Ranks of the S*-substrings (each up to and with the next S* position), equal ones alike, up to ``depth`` signs."""
    lengths = np.minimum(np.append(stars[1:] - stars[:-1] + 1, 1), depth)
    padded = np.concatenate([text, np.full(depth + 8, 255, "u1")])
    rank, among = np.zeros(len(stars), "i8"), np.arange(len(stars))
    for at in range(0, int(lengths.max()), 8):
        word = np.zeros(len(among), "u8")
        for i in range(at, at + 8):
            # a substring that ends comes after its longer fellows: there, the sign is of the larger type
            word = (word << np.uint64(8)) | np.where(lengths[among] > i, padded[stars[among] + i], 255).astype("u8")
        among = _refined(rank, among, word)
        if not len(among):
            break
    return rank


def _sorted_stars(text: Array, stars: Array, depth: int) -> Array:
    """The S* positions by their suffixes' first ``depth`` signs.

    Their substrings are named, and the reduced text of names is sorted: names of 1, 2, 4, ... substrings are paired
    until they differ or cover ``depth`` signs; beyond that the order does not matter.
    """
    rank = _named(text, stars, depth)
    n, span = len(stars), 1
    counts = np.bincount(rank, minlength=n)
    among = np.flatnonzero(counts[rank] > 1)
    while True:
        later = np.minimum(among + span, n - 1)
        among = among[(stars[later] - stars[among] < depth) & (among + span < n)]
        if not len(among):
            break
        among = np.sort(_refined(rank, among, rank[among + span]))
        span *= 2
    return stars[np.argsort(rank, kind="stable")]


def suffix_order(text: Array, depth: int, memory: int = QUEUE_BYTES) -> Array:
    """Start positions of all suffixes of ``text`` in the order of their first ``depth`` signs.

    Sorted S* suffixes give the L suffixes in a pass over the signs from the smallest, and these give the S suffixes in
    a pass from the largest. All suffixes that wait under a sign are taken in one step, then those that they put
    under the same sign, and so on, so a run of n equal signs takes n steps.
    """
    small = _types(text)
    stars = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    by_sign: list[list[Array]] = [[] for _ in range(256)]

    def spread(queues: Queues, found: Array, sign: int, to_small: bool, down: bool) -> Array:
        """Push what precedes some suffixes; returns what goes under the same sign, to be taken at once."""
        before = found[found > 0] - 1
        before = before[small[before] == to_small]
        signs = text[before]
        before, signs = (before[signs <= sign], signs[signs <= sign]) if down else (before[signs >= sign], signs[signs >= sign])
        same = signs == sign
        queues.push(signs[~same], before[~same])
        return before[same]

    ordered = _sorted_stars(text, stars, depth)
    of_star = text[ordered]
    edges = np.searchsorted(of_star, np.arange(257))
    queues = Queues(memory)
    for sign in range(256):
        found = queues.pop(sign)
        while len(found):
            by_sign[sign].append(found)
            found = spread(queues, found, sign, False, False)
        spread(queues, ordered[edges[sign]:edges[sign + 1]], sign, False, False)
    queues = Queues(memory)
    out: list[Array] = []
    for sign in range(255, -1, -1):
        larger = np.concatenate(by_sign[sign]) if by_sign[sign] else np.zeros(0, "i8")
        by_sign[sign] = []
        own, found = [], queues.pop(sign)
        if sign == END:
            found = np.array([len(text) - 1])
        while len(found):
            own.append(found)
            found = spread(queues, found, sign, True, True)
        spread(queues, larger[::-1], sign, True, True)
        out.extend([*own, larger[::-1]])
    return np.concatenate(out)[::-1]


def repeated(text: Array, asked: Array, width: int, memory: int = QUEUE_BYTES) -> Array:
    """Which of the positions ``asked`` (a mask) start a string of ``width`` signs that another one of them starts.

    Such positions are neighbours in suffix order. Neighbours are compared by hashes, equal ones sign by sign.
    """
    out = np.zeros(len(text), bool)
    order = suffix_order(text, width, memory)
    order = order[asked[order]]
    if len(order) < 2:
        return out
    h = window_hashes(text, width)[order]
    at = np.flatnonzero(h[1:] == h[:-1])
    del h
    for i in range(0, len(at), 1 << 14):
        a, b = order[at[i:i + (1 << 14)]], order[at[i:i + (1 << 14)] + 1]
        same = np.ones(len(a), bool)
        for k in range(0, width, 40):
            step = np.arange(k, min(k + 40, width))
            same &= (text[a[:, None] + step] == text[b[:, None] + step]).all(axis=1)
        out[a[same]] = out[b[same]] = True
    return out


_BASE = 0x9E3779B97F4A7C15 | 1
_VALUE = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype="u8")
_HASHED = 1 << 17         # positions whose hashes are made at once


def window_hashes(data: Array, width: int) -> Array:
    """A 64-bit hash of the ``width`` bytes from each position on, by a running sum. Zero where fewer are left.

    A hash does not depend on where the sum began, so it begins anew every ``_HASHED`` positions.
    """
    n = len(data)
    out = np.zeros(n, "u8")
    most = max(0, min(n, _HASHED + width - 1))
    powers = np.cumprod(np.full(most, _BASE, "u8"))
    inverse = np.cumprod(np.full(most, pow(_BASE, -1, 1 << 64), "u8"))
    for at in range(0, n - width + 1, _HASHED):
        part = data[at:at + _HASHED + width - 1]
        windows = len(part) - width + 1
        total = np.concatenate([np.zeros(1, "u8"), np.cumsum(_VALUE[part] * powers[:len(part)])])
        h = (total[width:] - total[:windows]) * inverse[:windows]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        out[at:at + windows] = h ^ (h >> np.uint64(32))
    return out
