"""Line dedup (operator 1) over content-defined chunks of lines.

Lines are hashed, and rolling hashes run over the hashes of lines that are not blank, two at a time.  A chunk ends
between the two lines of a rolling hash that is below the one before and not above the one after.  Boundaries
depend on four lines only, so an insertion moves no later boundary and equal passages are cut alike wherever they
stand.  Two boundaries are never next to each other and none stands next to an end of the text, so every chunk has
two or more lines that are not blank, unless the whole text has fewer.

A passage that is shorter than the chunks around it holds no whole chunk.  So the rolling hashes themselves are
looked up as well: every window of two lines that are not blank, with the blank ones between them.  Of the places
of an equal chunk or window the first (smallest id, then position) stays and the lines of the others are removed,
after their bytes have been compared with those of the first.  A window inside a repeated chunk is not compared
again.  The earliest of equal lines always stays: a window before its own would hold an earlier one.

Keys alone (128 bits) are shuffled to find repeats; bytes travel only for repeated chunks and windows.  Joins on
keys have written tables on both sides, so adaptive execution can split a key that many documents share.

Defined results: null and empty texts have no lines; texts without line breaks are one line and lose
nothing; where no line stays that is not blank, none stays; equal rows of one id count as one place, so neither
loses its lines to the other; a null id is replaced by a hash of the text, and an id that stands beside unlike texts by
a hash of id and text, so each of these rows is a document of its own; empty tables give empty tables; further columns
are passed on untouched.
"""

from __future__ import annotations

import hashlib

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.lineage import settle
from rollcall.llm.tasks import by_arrow, merged, pack, rows_apart
from rollcall.llm.words import Rolling, covered, hashed

WINDOW = 2  # lines under a rolling hash
_COUNT = 1 << 30  # a run of lines is sent as first line * _COUNT + lines


def split(text: bytes) -> list[bytes]:
    """Lines; a break at the end of the text begins no further line."""
    lines = text.split(b"\n")
    if lines[-1] == b"":
        lines.pop()
    return lines


class Lines:
    """The lines of a text, their hashes, and where its chunks end (one past the last line)."""

    def __init__(self, text: bytes, rolling: Rolling):
        self.lines = split(text)
        self.rolling = rolling
        self.hashes = hashed(self.lines)
        self.filled = np.array([bool(x.strip()) for x in self.lines], bool)
        self.rows = np.flatnonzero(self.filled)
        r = rolling.hashes(self.hashes[self.rows, 0], WINDOW)
        low = np.flatnonzero((r[1:-1] < r[:-2]) & (r[1:-1] <= r[2:])) + 1
        self.ends = np.append(self.rows[low] + 1, len(self.lines)) if self.lines else np.empty(0, np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)[:len(self.ends)]

    def units(self) -> np.ndarray:
        """Runs of lines looked up, chunks and windows, as first line * _COUNT + lines."""
        if len(self.rows) < WINDOW:
            return np.empty(0, np.int64)
        first = np.concatenate([self.starts, self.rows[:-1]])
        return np.unique(first * _COUNT + np.concatenate([self.ends, self.rows[1:] + 1]) - first)

    def keys(self, units: np.ndarray) -> list[np.ndarray]:
        """128 bits for each unit, in two halves: rolling hashes over all its lines."""
        return [self.rolling.hashes(self.hashes[:, k], units % _COUNT, units // _COUNT).view(np.int64) for k in (0, 1)]

    def bytes_of(self, units: np.ndarray) -> list[bytes]:
        return [b"\n".join(self.lines[a:a + n]) for a, n in zip((units // _COUNT).tolist(), (units % _COUNT).tolist())]

    def inside(self, units: np.ndarray, later: np.ndarray) -> np.ndarray:
        """Which later units lie in a chunk that is a later unit itself."""
        first, past = units // _COUNT, units // _COUNT + units % _COUNT
        at = np.searchsorted(self.ends, first, side="right")
        whole = (self.starts[at] == first) & (self.ends[at] == past)
        repeated = np.zeros(len(self.ends), bool)
        repeated[at[whole & later]] = True
        return later & ~whole & repeated[at] & (past <= self.ends[at])


def chunks(text: bytes) -> list[tuple[int, int, int, int]]:
    """(first byte, one past the last byte, lines, lines that are not blank) of each chunk, in order.

    The break after a chunk's last line belongs to the chunk.
    """
    of = Lines(text, Rolling())
    at = np.concatenate([[0], np.cumsum([len(x) + 1 for x in of.lines])]).astype(np.int64)
    full = np.concatenate([[0], np.cumsum(of.filled)])
    return [(int(at[a]), min(int(at[b]), len(text)), int(b - a), int(full[b] - full[a]))
            for a, b in zip(of.starts, of.ends)]


def _keys(docs: DataFrame) -> DataFrame:
    def work(slices):
        rolling = Rolling()
        for rows in slices:
            found = [(doc, of, of.units()) for doc, text in rows for of in [Lines(text, rolling)]]
            found = [(doc, u, *of.keys(u)) for doc, of, u in found if len(u)]
            if found:
                _, units, low, high = map(list, zip(*found))
                yield {"low": np.concatenate(low), "high": np.concatenate(high), "place": np.concatenate(units),
                       "doc": np.repeat(np.array([x[0] for x in found], np.int64), [len(u) for u in units])}

    return by_arrow(docs, work, "low bigint, high bigint, doc bigint, place bigint")


def repeats(docs: DataFrame) -> DataFrame:
    """(doc, place) of runs of lines that are byte-equal to an earlier one; ``docs`` has (doc, text as bytes)."""
    keys = settle(_keys(docs))
    here = F.struct("doc", "place")
    first = settle(keys.groupBy("low", "high").agg(F.min(here).alias("first"), F.max(here).alias("last"))
                   .where("first != last").drop("last"))
    # a place is sent with a bit that says whether it is a later one
    again = keys.join(first, ["low", "high"]).select(
        "doc", (F.col("place") * 2 + (here != F.col("first")).cast("int")).alias("place"))

    def cut(groups):
        unpack, rolling = zstandard.ZstdDecompressor(), Rolling()
        for doc, packed, places in groups:
            of = Lines(unpack.decompress(packed), rolling)
            units, later = places // 2, places % 2 == 1
            fits = units // _COUNT + units % _COUNT <= len(of.lines)
            units, later = units[fits], later[fits]
            units = units[~of.inside(units, later)]
            low, high = of.keys(units)
            yield {"low": low, "high": high, "doc": np.full(len(units), doc), "place": units,
                   "bytes": of.bytes_of(units)}

    pieces = settle(merged(pack(docs), again, cut, "low bigint, high bigint, doc bigint, place bigint, bytes binary"))
    # the first places: one row per key
    kept = settle(pieces.join(first.select("low", "high", "first.doc", "first.place"), ["low", "high", "doc", "place"])
                  .groupBy("low", "high").agg(F.min(F.struct("bytes", "doc", "place")).alias("kept")))
    same = (F.col("bytes") == F.col("kept.bytes")) & (here != F.struct("kept.doc", "kept.place"))
    return pieces.join(kept, ["low", "high"]).where(same).select("doc", "place")


def removed(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, n_removed_chunks, n_removed_lines, kept) of the documents that lose lines; a removed chunk is one
    of which no line stays."""
    return _removed(rows_apart(docs, doc_id, text).select("doc", "text"))


def _removed(keyed: DataFrame) -> DataFrame:

    def cut(groups):
        unpack, rolling = zstandard.ZstdDecompressor(), Rolling()
        for doc, packed, places in groups:
            whole = unpack.decompress(packed)
            of = Lines(whole, rolling)
            runs = places[places // _COUNT < len(of.lines)]
            gone = covered(len(of.lines), runs // _COUNT, runs % _COUNT)
            if gone[of.filled].all():
                gone[:] = True
            kept = b"\n".join([x for x, away in zip(of.lines, gone) if not away])
            if whole.endswith(b"\n") and not gone.all():
                kept += b"\n"
            left = np.add.reduceat(~gone, of.starts, dtype=np.int64) if len(of.lines) else np.ones(0)
            yield {"doc": [doc], "n_removed_chunks": [int((left == 0).sum())], "kept": [kept.decode()],
                   "n_removed_lines": [int(gone.sum())], "kept_sha256": [hashlib.sha256(kept).hexdigest()]}

    return merged(pack(keyed), repeats(keyed), cut,
                  "doc bigint, n_removed_chunks bigint, n_removed_lines bigint, kept string, kept_sha256 string")


def dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with repeated chunks cut out of the text; documents of which nothing is left go."""
    rows = rows_apart(docs, doc_id, text)
    cut = _removed(rows.select("doc", "text")).groupBy("doc").agg(F.max("kept").alias("kept"))
    out = (rows.select("user", "doc").join(cut, "doc", "left")
           .where("kept IS NULL OR trim(kept) != ''"))
    columns = {text: F.coalesce("kept", F.col(f"user.`{text}`"))}
    if n_chars in docs.columns:
        columns[n_chars] = F.coalesce(F.length("kept").cast(docs.schema[n_chars].dataType), F.col(f"user.`{n_chars}`"))
    return out.select(*[columns.get(c, F.col(f"user.`{c}`")).alias(c) for c in docs.columns])


def report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: lines, chunks, removed lines and chunks, and the hash of what is kept."""
    def plain(slices):
        rolling = Rolling()
        for rows in slices:
            found = [Lines(t, rolling) for _, _, t in rows]
            yield {"doc": [d for d, _, _ in rows], "doc_id": [i for _, i, _ in rows],
                   "n_lines": [len(x.lines) for x in found], "n_chunks": [len(x.ends) for x in found],
                   "whole": [hashlib.sha256(t).hexdigest() for _, _, t in rows]}

    rows = rows_apart(docs, doc_id, text)
    base = by_arrow(rows.select("doc", "id", "text"),
                    plain, "doc bigint, doc_id bigint, n_lines bigint, n_chunks bigint, whole string")
    cut = _removed(rows.select("doc", "text")).groupBy("doc").agg(
        *[F.max(c).alias(c) for c in ("n_removed_lines", "n_removed_chunks", "kept_sha256")])
    return base.join(cut, "doc", "left").select(
        "doc_id", "n_lines", "n_chunks", F.coalesce("n_removed_lines", F.lit(0)).alias("n_removed_lines"),
        F.coalesce("n_removed_chunks", F.lit(0)).alias("n_removed_chunks"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"))
