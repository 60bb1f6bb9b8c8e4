"""Substring dedup (operator 2) by difference-cover anchors.

Two equal runs of ``length`` words start at places i and j.  For every offset between i and j some shift
d < PERIOD puts both i + d and j + d on places that are in COVER modulo PERIOD, so both runs hold an equal
anchor of ``length - PERIOD + 1`` words at such places.  Therefore:

1. anchors are hashed at cover places only (5 of 21) and those that occur twice anywhere are found;
2. each repeated anchor is extended: every whole window around it is hashed (128 bits), and windows that
   occur twice anywhere are found;
3. all words of those windows are removed.

Only keys are shuffled for 1 and 2, once per task and key when a task already sees a key twice, so a
passage shared by a third of all documents is one row per task.  Texts travel compressed, keyed by document.

Defined results: null and empty texts have no words and hash as the empty string; texts of fewer than
``length`` words lose nothing; a repeated row is another place, so both copies lose their windows; rows
that share an id but not the text are documents of their own; a null id is replaced by a hash of the
text; empty tables give empty tables; further columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions.lineage import settle
from rollcall.llm.tasks import by_arrow, merged, pack, rows_apart
from rollcall.llm.words import Rolling, U64, covered, hashed, mixed

# fixed values: a difference cover modulo 21 (every remainder is a difference of two members)
PERIOD = 21
COVER = (3, 6, 7, 12, 14)


def anchor_places(n_words: int, length: int) -> np.ndarray:
    """Starts of anchors in a text of n words: cover places whose anchor fits."""
    last = n_words - (length - PERIOD + 1)
    if n_words < length:
        return np.empty(0, np.int64)
    places = (np.arange(last // PERIOD + 1)[:, None] * PERIOD + np.array(COVER)).ravel()
    return places[places <= last]


BATCH = 1_000_000  # keys a task compares among themselves before it ships them
COUNT_ONLY = -1 << 31


def _groups(keys: np.ndarray, high: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """For each row whether the batch holds its key again, and whether it is the first with its key."""
    order = np.argsort(keys, kind="stable") if high is None else np.lexsort((high, keys))
    same = keys[order][1:] == keys[order][:-1]
    if high is not None:
        same &= high[order][1:] == high[order][:-1]
    later, known = np.empty((2, len(keys)), bool)
    later[order] = np.concatenate([[False], same])
    known[order] = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    return known, ~later


def _own(docs: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Keys that spread rows evenly which need no counting."""
    return mixed(docs.view(U64) + mixed(places.astype(U64)))


def _ship_anchors(keys: np.ndarray, places: np.ndarray, docs: np.ndarray) -> dict:
    """Rows to be counted: ``place`` is negative (~place) where the batch itself holds the key again.

    Of such a key one row keeps the key; the others go under keys of their own.
    """
    known, first = _groups(keys, None)
    return {"key": np.where(first, keys, _own(docs, places)).view(np.int64), "doc": docs,
            "place": np.where(known, ~places, places).astype(np.int32)}


def _ship_windows(keys: np.ndarray, places: np.ndarray, docs: np.ndarray, high: np.ndarray) -> dict:
    """Rows to be counted: the low half of ``rest`` is a place, the high half belongs to the key.

    Where the batch holds keys again, the places that follow each other in a document become one row
    (~place, and in the high half how many more follow) under a key of its own, and one row per key
    (place COUNT_ONLY) lets other batches see it.
    """
    known, first = _groups(keys, high)
    at = np.flatnonzero(known)
    starts = np.ones(len(at), bool)
    starts[1:] = (docs[at][1:] != docs[at][:-1]) | (places[at][1:] != places[at][:-1] + 1)
    begin = at[starts]
    more = np.diff(np.append(np.flatnonzero(starts), len(at))) - 1
    lone, shown = ~known, known & first
    low = (1 << 32) - 1
    return {"key": np.concatenate([keys[lone], keys[shown], _own(docs[begin], places[begin])]).view(np.int64),
            "doc": np.concatenate([docs[lone], docs[shown], docs[begin]]),
            "rest": np.concatenate([(high[lone].astype(np.int64) << 32) | places[lone],
                                    (high[shown].astype(np.int64) << 32) | (COUNT_ONLY & low),
                                    (more << 32) | (~places[begin] & low)])}


def _buffered(parts, ship):
    """Ship pieces together once they hold BATCH keys."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= BATCH:
            yield ship(*map(np.concatenate, zip(*held)))
            held, size = [], 0
    if size:
        yield ship(*map(np.concatenate, zip(*held)))


def _anchors(docs: DataFrame, length: int) -> DataFrame:
    width = length - PERIOD + 1

    def work(slices):
        rolling = Rolling()

        def parts():
            for rows in slices:
                for doc, text in rows:
                    words = text.split()
                    places = anchor_places(len(words), length)
                    if len(places):
                        yield (rolling.hashes(hashed(words)[:, 0].copy(), width, places), places,
                               np.full(len(places), doc, np.int64))

        return _buffered(parts(), _ship_anchors)

    return by_arrow(docs.select("doc", "text"), work, "key bigint, doc bigint, place int")


def _windows(found: DataFrame, length: int) -> DataFrame:
    """Every window around a repeated anchor, under 96 bits of hash."""

    def work(slices):
        rolling, unpack = Rolling(), zstandard.ZstdDecompressor()

        def parts():
            for rows in slices:
                for doc, packed, anchors in rows:
                    words = unpack.decompress(packed).split()
                    places = np.frombuffer(anchors, np.int32).astype(np.int64)
                    places = places[places < len(words)]
                    # a window starts at most PERIOD - 1 words before its anchor
                    near = covered(len(words) + PERIOD, places, PERIOD)[PERIOD - 1:]
                    starts = np.flatnonzero(near[:max(0, len(words) - length + 1)])
                    if len(starts):
                        hashes = hashed(words)
                        yield (rolling.hashes(hashes[:, 0].copy(), length, starts), starts,
                               np.full(len(starts), doc, np.int64),
                               rolling.hashes(hashes[:, 1].copy(), length, starts) >> np.uint64(32))

        return _buffered(parts(), _ship_windows)

    return by_arrow(found, work, "key bigint, doc bigint, rest bigint")


def _twice(rows: DataFrame, keys: list[str], more) -> DataFrame:
    """(doc, place) of rows whose key occurs in another row, or did within its batch; the high half of
    ``place`` says how many places after it belong to it too."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    place = F.when(F.col("place") >= 0, F.col("place").cast("bigint")).otherwise(
        F.bitwise_not("place").cast("bigint") + F.shiftleft(more.cast("bigint"), 32))
    return (rows.withColumn("n", n).where(f"(n > 1 OR place < 0) AND place != {COUNT_ONLY}")
            .select("doc", place.alias("place")))


def repeats(docs: DataFrame, length: int = 35) -> DataFrame:
    """(doc, packed text, starts): documents with the starts of windows that occur elsewhere too.

    ``docs`` has (doc, text as bytes).
    """
    if length < PERIOD + 1:
        raise ValueError(f"length must exceed {PERIOD}")

    def anchored(groups):
        for doc, packed, places in groups:
            yield {"doc": [doc], "packed": [packed], "anchors": [places.astype(np.int32).tobytes()]}

    found = settle(merged(pack(docs), _twice(_anchors(docs, length), ["key"], F.lit(0)), anchored,
                          "doc bigint, packed binary, anchors binary"))
    windows = _windows(found, length).withColumn("high", F.shiftright("rest", 32)).withColumn(
        "place", F.shiftright(F.shiftleft("rest", 32), 32).cast("int"))
    return found, _twice(windows, ["key", "high"], F.col("high"))


def removed(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = 35) -> DataFrame:
    """(doc, n_removed, kept, kept_sha256) of the documents that lose words; ``kept`` joined by one space."""
    return _removed(rows_apart(docs, doc_id, text).select("doc", "text"), length)


def _removed(keyed: DataFrame, length: int) -> DataFrame:
    found, places = repeats(keyed, length)

    def cut(groups):
        unpack = zstandard.ZstdDecompressor()
        for doc, packed, starts in groups:
            words = unpack.decompress(packed).split()
            starts, more = starts & 0xFFFFFFFF, starts >> 32
            fits = starts <= len(words) - length
            gone = covered(len(words), starts[fits], more[fits] + length)
            kept = b" ".join([w for w, out in zip(words, gone.tolist()) if not out])
            yield {"doc": [doc], "n_removed": [int(gone.sum())], "kept": [kept],
                   "kept_sha256": [hashlib.sha256(kept).hexdigest()]}

    return merged(found, places, cut, "doc bigint, n_removed bigint, kept binary, kept_sha256 string")


def report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = 35) -> DataFrame:
    """Per document: words, removed words and the hash of what is kept."""
    def plain(slices):
        for rows in slices:
            words = [t.split() for _, _, t in rows]
            yield {"doc": [d for d, _, _ in rows], "doc_id": [i for _, i, _ in rows],
                   "n_words": [len(w) for w in words],
                   "whole": [hashlib.sha256(b" ".join(w)).hexdigest() for w in words]}

    rows = rows_apart(docs, doc_id, text)
    base = by_arrow(rows.select("doc", "id", "text"),
                    plain, "doc bigint, doc_id bigint, n_words bigint, whole string")
    gone = _removed(rows.select("doc", "text"), length).groupBy("doc").agg(
        F.max("n_removed").alias("n_removed"), F.max("kept_sha256").alias("kept_sha256"))
    return base.join(gone, "doc", "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"))
