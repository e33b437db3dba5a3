"""Token counts under a unigram vocabulary, with forward scores shared along a trie of the distinct pre-tokens."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailprep.llm.common import filled

MARK = "▁"       # stands before every word, as in the vocabulary
SCALE = 1 << 10       # scores are whole numbers, so equal paths compare equal
UNKNOWN = 64 * SCALE  # what a byte of a character that is no piece costs
LONG = 1 << 12        # words of more characters are walked in parts
PART = 1 << 10        # characters of such a part
PARTS = 1 << 8        # parts that are walked side by side
NEVER = 1 << 60       # the cost of what can't be


class Vocabulary:
    """A trie of pieces as sorted transitions. A piece of rank r (by its score) costs log(r + 2), scaled and rounded."""

    def __init__(self, pieces: list[str]):
        step: dict[tuple[int, str], int] = {}
        cost = [0]
        for rank, piece in enumerate(pieces):
            state = 0
            for c in piece:
                if (state, c) not in step:
                    step[state, c] = len(cost)
                    cost.append(0)
                state = step[state, c]
            cost[state] = cost[state] or 1 + int(round(SCALE * np.log(rank + 2)))
        keys = np.array([(s << 21) | ord(c) for s, c in step], "i8")
        order = np.argsort(keys)
        self.keys, self.next = keys[order], np.array(list(step.values()), "i8")[order]
        self.cost = np.array(cost, "i8")  # 0: no piece ends here
        self.longest = max(map(len, pieces), default=0)

    def move(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The next states, 0 where there is none."""
        if not len(self.keys):
            return np.zeros(len(state), "i8")
        key = (state << 21) | code
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.next[at], 0)


@lru_cache(maxsize=2)
def vocabulary(model_file: str) -> Vocabulary:
    """The normal pieces of a piece model, best first; once per worker."""
    m = sentencepiece.SentencePieceProcessor(model_file=model_file)
    kinds = (m.is_control, m.is_unknown, m.is_byte, m.is_unused)
    plain = [i for i in range(m.get_piece_size()) if not any(k(i) for k in kinds)]
    return Vocabulary([m.id_to_piece(i) for i in sorted(plain, key=lambda i: (-m.get_score(i), i))])


def counts(words: list[str], vocab: Vocabulary) -> np.ndarray:
    """Tokens of the cheapest path through each of some distinct, non-empty words; of equal paths the shorter one.

    The words form a trie that is walked level by level. A node's forward score (cost, tokens) comes from the nodes up
    to the longest piece above it, once, however many words pass through it. Matches in progress are kept per node, one
    for each start that still can become a piece. The last node of a word holds its count.
    """
    out = np.zeros(len(words), "i8")
    order = np.array(sorted(range(len(words)), key=words.__getitem__), "i8")
    lengths = np.array([len(words[i]) for i in order], "i8")
    codes = np.frombuffer("".join(words[i] for i in order).encode("utf-32-le"), "<u4").astype("i8")
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(words) else np.zeros(0, "i8")
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(1, "i8"), np.zeros(1, "i8"))]  # per level: cost, tokens
    up: list[np.ndarray] = []                          # per level: each node's parent
    alive = np.arange(len(words))                      # words that reach this level, sorted
    node = np.zeros(len(words), "i8")                  # their node one level above
    open_from: list[tuple[np.ndarray, np.ndarray]] = []  # per start level, newest first: (node, state) of live matches
    depth = 0
    while len(alive):
        c = codes[starts[alive] + depth]
        fresh = np.ones(len(alive), bool)
        fresh[1:] = (node[1:] != node[:-1]) | (c[1:] != c[:-1])  # sorted words put the words of a node together
        here = np.cumsum(fresh) - 1
        parent, code = node[fresh], c[fresh]
        up.append(parent)
        # unless a piece of one character follows, a character costs its bytes
        n_bytes = 1 + (code > 0x7F).astype("i8") + (code > 0x7FF) + (code > 0xFFFF)
        cost = best[-1][0][parent] + UNKNOWN * n_bytes
        tokens = best[-1][1][parent] + n_bytes
        # children of each node one level above are a range
        first = np.searchsorted(parent, np.arange(len(best[-1][0]) + 1))
        going = []
        for back, (at, state) in enumerate([(np.arange(len(best[-1][0])), np.zeros(len(best[-1][0]), "i8")), *open_from]):
            n = first[at + 1] - first[at]
            child = np.repeat(first[at] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(at) else at
            moved = vocab.move(np.repeat(state, n), code[child])
            live = moved > 0
            child, moved = child[live], moved[live]
            ends = vocab.cost[moved] > 0
            to, price = child[ends], vocab.cost[moved[ends]]
            above = parent[to]
            for level in range(back):
                above = up[-2 - level][above]
            origin = best[-1 - back]
            new_cost, new_tokens = origin[0][above] + price, origin[1][above] + 1
            better = (new_cost < cost[to]) | ((new_cost == cost[to]) & (new_tokens < tokens[to]))
            cost[to[better]], tokens[to[better]] = new_cost[better], new_tokens[better]
            going.append((child, moved))
        open_from = going[:vocab.longest]
        best.append((cost, tokens))
        if len(best) > vocab.longest + 1:  # nothing reaches further back
            best.pop(0)
            up.pop(0)
        depth += 1
        done = lengths[alive] == depth
        out[order[alive[done]]] = tokens[here[done]]
        alive, node = alive[~done], here[~done]
    return out


def _ending(codes: np.ndarray, vocab: Vocabulary, longest: int, shift: int) -> np.ndarray:
    """Per place after a character, what the pieces of length 1, 2, ... that end there cost, with their tokens below."""
    n = len(codes)
    out = np.full((n + 1, longest), NEVER, "i8")
    n_bytes = 1 + (codes > 0x7F).astype("i8") + (codes > 0x7FF) + (codes > 0xFFFF)
    out[1:, 0] = (UNKNOWN * n_bytes << shift) + n_bytes
    start, state = np.arange(n), np.zeros(n, "i8")
    for size in range(1, longest + 1):
        inside = start + size <= n
        start, state = start[inside], state[inside]
        state = vocab.move(state, codes[start + size - 1])
        start, state = start[state > 0], state[state > 0]
        ends = vocab.cost[state] > 0
        at = start[ends] + size
        out[at, size - 1] = np.minimum(out[at, size - 1], (vocab.cost[state[ends]] << shift) + 1)
    return out


def count_long(word: str, vocab: Vocabulary, part: int = PART, parts: int = PARTS) -> int:
    """Tokens of the cheapest path through one word of any length; the same as ``counts`` gives.

    The word is cut into parts of equal length. A path enters a part less than a piece's length after its start, so
    forward scores are computed from each such entry to each entry of the next part, for many parts side by side.
    These few numbers per part are then added up along the word.
    """
    codes = np.frombuffer(word.encode("utf-32-le"), "<u4")
    longest = max(1, vocab.longest)
    part = max(part, longest)
    shift = int(4 * (part + longest)).bit_length()  # a character has up to four tokens
    cost, tokens = np.full(longest, NEVER, "i8"), np.zeros(longest, "i8")
    cost[0] = 0
    steps_of_part = part + longest  # places of a part and the entries of the next one
    for begin in range(0, len(codes), part * parts):
        inside = codes[begin:begin + part * parts + longest].astype("i8")
        ending = _ending(inside, vocab, longest, shift)
        n = -(-(min(len(codes) - begin, part * parts)) // part)
        filler = np.full((max(0, n * part + longest - len(ending)), longest), NEVER, "i8")
        ending = np.concatenate([ending, filler])
        starts = part * np.arange(n)
        score = np.full((n, longest, longest + steps_of_part), NEVER, "i8")  # part, entry, place after so many before
        score[:, np.arange(longest), longest + np.arange(longest)] = 0
        for place in range(1, steps_of_part):
            reach = longest - max(0, place - part)  # from the next part's start on, only what begins before it
            low = longest + place - longest
            before = score[:, :, low:low + reach]
            price = ending[starts + place][:, ::-1][:, :reach]
            best = (before + price[:, None, :]).min(axis=2)
            score[:, :, longest + place] = np.minimum(score[:, :, longest + place], best)
        for i in range(n):
            left = len(codes) - begin - i * part
            exits = score[i][:, longest + part:] if left > part else score[i][:, longest + left:longest + left + 1]
            through = np.where(exits < NEVER, exits >> shift, NEVER)
            total = np.minimum(cost[:, None] + through, NEVER)
            cost = total.min(axis=0)
            all_tokens = tokens[:, None] + (exits & ((1 << shift) - 1))
            tokens = np.where(total == cost, all_tokens, NEVER).min(axis=0)
    return int(tokens[0])


def word_counts(words: list[str], vocab: Vocabulary) -> np.ndarray:
    """Tokens of distinct, non-empty words: long ones in parts, all others along their trie."""
    sizes = np.array([len(w) for w in words], "i8")
    out = np.zeros(len(words), "i8")
    usual = np.flatnonzero(sizes <= LONG)
    out[usual] = counts([words[i] for i in usual], vocab)
    for i in np.flatnonzero(sizes > LONG):
        out[i] = count_long(words[i], vocab)
    return out


def count_tokens(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_tokens) of every row: pieces of the cheapest segmentation of each word, with its mark.

    Words are `[^\\x20\\x09-\\x0D]+` of the whole text. Each batch of rows counts its distinct words once; nothing is
    shuffled. Null and empty texts have no words. Repeated rows each give a row. A word may have any length.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab = vocabulary(model_file)
        for f in frames:
            texts = [t.encode().split() for t in filled(f["_text"])]
            place: dict[bytes, int] = {}
            used = np.fromiter((place.setdefault(w, len(place)) for t in texts for w in t), "i8")
            each = word_counts([MARK + w.decode() for w in place], vocab)
            n = np.array([len(t) for t in texts], "i8")
            total = np.concatenate([[0], np.cumsum(each[used])]) if len(used) else np.zeros(1, "i8")
            ends = np.cumsum(n)
            yield f.drop(columns=["_text"]).assign(n_words=n, n_tokens=total[ends] - total[ends - n])

    return (docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
            .mapInPandas(run, f"_key {kind}, n_words long, n_tokens long").withColumnRenamed("_key", key))
