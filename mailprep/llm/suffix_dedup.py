"""Removal of every byte string of a given length that occurs more than once in a corpus, by sharded suffix sorting."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailprep.llm.bloom import Bloom, bloom_of
from mailprep.llm.common import filled, give_back, steps
from mailprep.llm.induced import as_text, repeated, window_hashes
from mailprep.session import saved

WIDTH = 200              # bytes of a string
GRAM = 32                # bytes of an anchor
SEGMENT = 1 << 22        # bytes of a long text that are looked at together
HOT = 500                # anchors with more places are split by what stands around them
HOT_STEP = 8             # offsets of a window to such an anchor that stay together
PIECE_BYTES = 1 << 24    # pieces that a task holds before it sends them
SHARDS_PER_TASK = 4
_LOW = (1 << 28) - 1


def anchors(texts: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, ...]:
    """Where the windows of ``width`` bytes of some texts belong: (text, first, last, anchor, hash) per run of windows.

    A window's anchor is its 32-byte gram with the smallest hash, the last one of equals. It depends on the window's
    bytes alone, so equal windows have equal anchors at the same offset, and all windows of an anchor's place are one
    run. Positions count within each text. Texts shorter than a window have no runs.
    """
    lengths = np.array([len(t) for t in texts], "i8")
    starts = np.cumsum(lengths) - lengths
    data = np.frombuffer(b"".join(texts), "u1")
    n_windows = np.maximum(lengths - width + 1, 0)
    if not n_windows.sum():
        return (np.zeros(0, "i8"),) * 4 + (np.zeros(0, "u8"),)
    h = window_hashes(data, GRAM)
    key = (h & ~np.uint64(_LOW)) | (np.uint64(_LOW) - np.arange(len(h), dtype="u8"))
    w = width - GRAM + 1
    full = -(-len(key) // w) * w
    rows = np.concatenate([key, np.full(full - len(key), np.iinfo("u8").max, "u8")]).reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    owner = np.repeat(np.arange(len(texts)), n_windows)
    p = np.arange(len(owner)) + np.repeat(starts - (np.cumsum(n_windows) - n_windows), n_windows)
    least = np.minimum(behind[p], ahead[p + w - 1])
    anchor = _LOW - (least & np.uint64(_LOW)).astype("i8")
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])]))
    last = np.append(first[1:], len(p)) - 1
    who, a = owner[first], anchor[first]
    return who, p[first] - starts[who], p[last] - starts[who], a - starts[who], h[a]


def _segments(texts: list[str], width: int = WIDTH) -> tuple[list[bytes], list[int], list[int]]:
    """Texts as bytes, long ones in segments that share all but one byte of a window: (bytes, text, offset)."""
    parts, who, offset = [], [], []
    for i, t in enumerate(texts):
        raw = t.encode()
        for at in range(0, max(1, len(raw) - width + 1), SEGMENT):
            parts.append(raw[at:at + SEGMENT + width - 1])
            who.append(i)
            offset.append(at)
    return parts, who, offset


def text_id(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def _short_id(name: Column) -> Column:
    return F.conv(F.substring(name, 1, 16), 16, -10).cast("long")


def _anchor_counts(docs: DataFrame, text: str, shards: int) -> DataFrame:
    """(hash, hot) of the anchors with more than one place. Tasks count their own first and send sorted arrays."""
    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            found = []
            texts = filled(f["_text"])
            for a, b in steps(texts):
                found.append(anchors(_segments(texts[a:b])[0])[4])
            h, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, "u8"), np.zeros(0, "i8"))
            shard = (h >> np.uint64(48)).astype("i8") * shards >> 16
            edges = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(h) else [0]
            yield pd.DataFrame([(int(shard[a]), h[a:b].tobytes(), n[a:b].astype("<u4").tobytes())
                                for a, b in zip(edges[:-1], edges[1:])], columns=["shard", "hash", "n"])
        give_back()

    def count(f: pd.DataFrame) -> pd.DataFrame:
        h = np.concatenate([np.frombuffer(x, "<u8") for x in f["hash"]])
        n = np.concatenate([np.frombuffer(x, "<u4") for x in f["n"]])
        h, at = np.unique(h, return_inverse=True)
        n = np.bincount(at, n)
        return pd.DataFrame({"hash": h[n > 1].view("i8"), "hot": n[n > 1] > HOT})

    sent = docs.select(F.col(text).alias("_text")).mapInPandas(send, "shard int, hash binary, n binary")
    return sent.groupBy("shard").applyInPandas(count, "hash long, hot boolean")


class _Pieces:
    """Pieces of text on their way to shards, equal ones once, with the places they stand at."""

    def __init__(self) -> None:
        self.held = 0
        self.by_shard: dict[int, tuple[dict, list, list, list]] = {}

    def add(self, shard: int, piece: bytes, name: str, start: int) -> None:
        pieces, at, names, starts = self.by_shard.setdefault(shard, ({}, [], [], []))
        if piece not in pieces:
            pieces[piece] = len(pieces)
            self.held += len(piece)
        self.held += 24
        at.append(pieces[piece])
        names.append(name)
        starts.append(start)

    def packed(self) -> pd.DataFrame:
        rows = []
        for shard, (pieces, at, names, starts) in self.by_shard.items():
            place: dict[str, int] = {}
            who = [place.setdefault(x, len(place)) for x in names]
            rows.append((shard, b"".join(pieces), np.array([len(p) for p in pieces], "<u4").tobytes(),
                         np.array(at, "<u4").tobytes(), "".join(place), np.array(who, "<u4").tobytes(),
                         np.array(starts, "<i8").tobytes()))
        self.__init__()
        return pd.DataFrame(rows, columns=["shard", "pieces", "lengths", "at", "names", "who", "starts"])


def _spans(docs: DataFrame, text: str, known: Bloom, hot: Bloom, shards: int) -> DataFrame:
    """(name, spans): per text (by its hash), one row per shard that found repeated windows: pairs (from, to) of bytes."""
    shared = docs.sparkSession.sparkContext.broadcast((known, hot))

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, hot = shared.value
        out, seen = _Pieces(), set()
        for f in frames:
            texts, names = filled(f["_text"]), f["_name"].tolist()
            for a, b in steps(texts):
                fresh = [i for i in range(a, b) if not (names[i] in seen or seen.add(names[i]))]
                raw, who, offset = _segments([texts[i] for i in fresh])
                seg, first, last, anchor, h = anchors(raw)
                at = np.flatnonzero(known.has(h))
                burning = hot.has(h[at])
                for s, p, q, x, g, warm in zip(seg[at].tolist(), first[at].tolist(), last[at].tolist(), anchor[at].tolist(),
                                               h[at].tolist(), burning.tolist()):
                    name, body, base = names[fresh[who[s]]], raw[s], offset[s]
                    if not warm:
                        out.add(g % shards, body[p:q + WIDTH], name, base + p)
                        continue
                    # windows by their offset to the anchor, HOT_STEP together; what they all hold decides the shard
                    for k in range((x - q) // HOT_STEP, (x - p) // HOT_STEP + 1):
                        low, high = max(p, x - k * HOT_STEP - HOT_STEP + 1), min(q, x - k * HOT_STEP)
                        core = body[x - k * HOT_STEP:x - k * HOT_STEP - HOT_STEP + 1 + WIDTH]
                        out.add(xxhash.xxh64_intdigest(core, seed=k) % shards, body[low:high + WIDTH], name, base + low)
                if out.held > PIECE_BYTES:
                    yield out.packed()
        if out.by_shard:
            yield out.packed()
        give_back()

    def sort(f: pd.DataFrame) -> pd.DataFrame:
        pieces: dict[bytes, int] = {}
        texts: dict[str, int] = {}
        at, who, starts = [], [], []
        for body, lengths, a, names, w, s in zip(f["pieces"], f["lengths"], f["at"], f["names"], f["who"], f["starts"]):
            ends = np.cumsum(np.frombuffer(lengths, "<u4").astype("i8"))
            own = np.array([pieces.setdefault(body[i:j], len(pieces)) for i, j in zip([0, *ends[:-1]], ends)], "i8")
            named = np.array([texts.setdefault(names[i:i + 32], len(texts)) for i in range(0, len(names), 32)], "i8")
            at.append(own[np.frombuffer(a, "<u4")])
            who.append(named[np.frombuffer(w, "<u4")])
            starts.append(np.frombuffer(s, "<i8"))
        at, who, starts = np.concatenate(at), np.concatenate(who), np.concatenate(starts)
        order = np.lexsort((starts, who))
        at, who, starts = at[order], who[order], starts[order]
        # copies of a text arrive from several tasks; each place counts once
        fresh = np.concatenate([[True], (who[1:] != who[:-1]) | (starts[1:] != starts[:-1])])
        at, who, starts = at[fresh], who[fresh], starts[fresh]
        bodies = list(pieces)
        n_windows = np.array([len(p) - WIDTH + 1 for p in bodies], "i8")
        body, begin = as_text(bodies)
        windows = np.repeat(begin - (np.cumsum(n_windows) - n_windows), n_windows) + np.arange(n_windows.sum())
        asked = np.zeros(len(body), bool)
        asked[windows] = True
        again = repeated(body, asked, WIDTH)[windows]
        of = np.repeat(np.arange(len(bodies)), n_windows)
        again |= (np.bincount(at, minlength=len(bodies)) > 1)[of]
        # runs of repeated windows of each piece
        offset = np.arange(len(of)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        linked = np.concatenate([[False], again[1:] & again[:-1] & (of[1:] == of[:-1])]) if len(of) else again
        first = np.flatnonzero(again & ~linked)
        last = np.flatnonzero(again & ~np.append(linked[1:], False))
        piece = of[first]
        bounds = np.searchsorted(piece, np.arange(len(bodies) + 1))
        n = bounds[at + 1] - bounds[at]
        run = np.repeat(bounds[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        spans = np.stack([np.repeat(starts, n) + offset[first][run], np.repeat(starts, n) + offset[last][run] + WIDTH], axis=1)
        del pieces, bodies, body, windows, asked, again, of, offset, linked
        give_back()
        names, owner = list(texts), np.repeat(who, n)
        edges = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1], [True]])) if len(owner) else [0]
        return pd.DataFrame([(names[owner[a]], merged(spans[a:b]).astype("<i8").tobytes())
                             for a, b in zip(edges[:-1], edges[1:])], columns=["name", "spans"])

    sent = docs.select(F.col(text).alias("_text"), text_id(F.col(text)).alias("_name")).mapInPandas(
        send, "shard int, pieces binary, lengths binary, at binary, names string, who binary, starts binary")
    return sent.groupBy("shard").applyInPandas(sort, "name string, spans binary")


def merged(spans: np.ndarray) -> np.ndarray:
    """Spans (from, to) joined where they overlap or touch, sorted."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    return np.stack([spans[first, 0], reach[np.append(np.flatnonzero(first)[1:], len(spans)) - 1]], axis=1)


def dedup(docs: DataFrame, text: str = "text", whole: bool = False) -> DataFrame:
    """All columns of ``docs`` with (n_bytes, n_removed, n_spans, kept): ``kept`` holds the bytes that stay, with ``whole``
    only those of characters that stay whole, so that they are a text.

    A byte goes if a string of ``WIDTH`` bytes covers it that starts anywhere else too, in another text or the same.
    Anchors chosen by content sort all windows into groups that hold every copy of a window; anchors of one place drop
    out, and the text around the others goes to shards, equal pieces of a task once. Each shard sorts its suffixes by
    induction and finds the windows that repeat. Texts that are equal as a whole count as their number and are looked
    at once. Only texts with something to remove are shuffled.
    Null text is empty. Empty and short texts stay as they are. Repeated rows are copies. An empty table gives an empty
    result. Columns of these four names are replaced.
    """
    spark = docs.sparkSession
    shards = min(1 << 15, SHARDS_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.drop("n_bytes", "n_removed", "n_spans", "kept")
    counts = saved(_anchor_counts(rows, text, shards), "anchors")
    known, hot = bloom_of(counts, "hash"), bloom_of(counts.filter("hot"), "hash")
    spans = saved(_spans(rows, text, known, hot, shards), "spans")
    copies = rows.groupBy(text_id(F.col(text)).alias("name")).agg(F.count("*").alias("n"),
                                                                  F.first(F.octet_length(F.col(text))).alias("size"))
    copies = copies.filter((F.col("n") > 1) & (F.col("size") >= WIDTH)).select("name", F.lit(True).alias("copied"))
    cuts = (spans.groupBy("name").agg(F.collect_list("spans").alias("spans"))
            .join(copies, "name", "full").withColumn("copied", F.coalesce("copied", F.lit(False))))
    cuts = saved(cuts, "cuts")
    wanted = spark.sparkContext.broadcast(bloom_of(cuts.select(_short_id(F.col("name")).alias("id")), "id"))

    @F.pandas_udf("boolean")
    def has(ids: pd.Series) -> pd.Series:
        return pd.Series(wanted.value.has(ids.to_numpy("i8")))

    @F.pandas_udf("kept binary, n_removed long, n_spans long")
    def cut(texts: pd.Series, spans: pd.Series, copied: pd.Series) -> pd.DataFrame:
        out = []
        for t, s, c in zip(filled(texts), spans, copied):
            raw = t.encode()
            if c is True or c == True:  # noqa: E712  a nullable column comes as objects
                out.append((b"", len(raw), 1))
                continue
            parts = [np.frombuffer(x, "<i8").reshape(-1, 2) for x in s] if s is not None else []
            gone = merged(np.concatenate(parts)) if parts else np.zeros((0, 2), "i8")
            edges = [0, *gone.ravel().tolist(), len(raw)]
            kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
            out.append((kept.decode(errors="ignore").encode() if whole else kept, len(raw) - len(kept), len(gone)))
        return pd.DataFrame(out, columns=["kept", "n_removed", "n_spans"])

    named = rows.withColumn("_name", text_id(F.col(text))).withColumn("_touched", has(_short_id(F.col("_name"))))
    columns = [F.col(c) for c in rows.columns]
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes")
    nothing = F.lit(0).cast("long")
    clean = named.filter(~F.col("_touched")).select(
        *columns, size, nothing.alias("n_removed"), nothing.alias("n_spans"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("kept"))
    cuts = cuts.select(F.col("name").alias("_name"), F.col("spans").alias("_spans"), F.col("copied").alias("_copied"))
    touched = named.filter("_touched").join(cuts, "_name", "left")
    touched = touched.withColumn("_cut", cut(F.col(text), F.col("_spans"), F.col("_copied")))
    return clean.unionByName(touched.select(*columns, size, "_cut.n_removed", "_cut.n_spans", "_cut.kept"))
