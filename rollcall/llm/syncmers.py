"""Document fingerprints (operator 10) from closed syncmers.

A run of K characters is a closed syncmer when the least hash among its runs of S characters is that of
its first or its last one.  Whether a run is chosen depends on its own characters only, so equal passages
give equal anchors wherever they stand, and of K - S neighbouring runs at least one is chosen.

The fingerprint holds every anchor of the text in order, eight hex digits each: seven of its hash and one of its
distance (less than K - S + 1) from the anchor before it, or from the beginning.  It grows with the text, so long
texts are compared as closely as short ones.

Two texts are matched by position.  Equal anchors are paired in order of occurrence, the first with the first.  A
pair counts if it stands at the same offset (place in one text less place in the other) as a pair next to it, in
the order of either text.  The longest sequence of such pairs that rises in both texts is what the texts have in
common: insertions shift offsets and lose the anchors at the seams only, passages in another order are not
common, but for the longest.  Likeness is the share of all anchors of both that are common, ``held`` the share of
the shorter list, which is near 1 where one text holds the other.  Where a text has a single anchor, a pair needs
no neighbour.

Defined results: null is read as empty; a text without K characters has one anchor, itself; the empty text
has none and an empty fingerprint; two empty fingerprints are alike (1.0), an empty and another are not (0.0).
Rows without an id come last, by text; rows that share an id stand next to each other, by text; a single
document is followed by itself; further columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.tasks import by_arrow, over_batches
from rollcall.llm.words import U64, Rolling, mixed

K, S = 16, 5
DIGITS = 8


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values."""
    out, span = values, 1
    while 2 * span <= width:
        out, span = np.minimum(out[:-span], out[span:]), 2 * span
    rest = width - span
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def anchors(text: str, rolling: Rolling) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the closed syncmers of a text, in order."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(U64)
    if not len(points):
        return np.empty(0, np.int64), np.empty(0, U64)
    values = mixed(points + np.uint64(1))
    if len(points) < K:
        return np.zeros(1, np.int64), rolling.hashes(values, len(points))
    inner = rolling.hashes(values, S)
    width = K - S + 1
    least = _least(inner, width)
    places = np.flatnonzero((inner[:len(least)] == least) | (inner[width - 1:] == least))
    return places, rolling.hashes(values, K, places)


def listed(text: str, rolling: Rolling) -> np.ndarray:
    """The anchors in order, each a number of 28 bits of hash and 4 bits of distance from the one before."""
    places, hashes = anchors(text, rolling)
    return (hashes >> np.uint64(36) << np.uint64(4) | np.diff(places, prepend=0).astype(U64)).astype(np.uint32)


def fingerprint(text: str, rolling: Rolling) -> str:
    return _digits(listed(text, rolling))


def _digits(found: np.ndarray) -> str:
    return found.astype(">u4").tobytes().hex()


class Anchors:
    """Hashes, numbered by occurrence and sorted, and places of the anchors of a fingerprint."""

    def __init__(self, found: np.ndarray):
        self.found = found
        places = np.cumsum(found & np.uint32(15), dtype=np.int64)
        hashes = (found >> np.uint32(4)).astype(np.int64)
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        self.keys = ranked << 32 | (np.arange(len(ranked)) - np.searchsorted(ranked, ranked))
        self.places = places[order]

    @classmethod
    def of(cls, digits: str) -> Anchors:
        return cls(np.frombuffer(bytes.fromhex(digits), ">u4").astype(np.uint32))

    def __len__(self) -> int:
        return len(self.found)


def _beside(offsets: np.ndarray) -> np.ndarray:
    """Which of the values equal the one before or after them."""
    same = np.concatenate([[False], offsets[1:] == offsets[:-1], [False]])
    return same[1:] | same[:-1]


def common(one: Anchors, two: Anchors) -> int:
    """How many anchors two texts have in common by hash and position."""
    if np.array_equal(one.found, two.found):
        return len(one)
    _, i, j = np.intersect1d(one.keys, two.keys, assume_unique=True, return_indices=True)
    if not len(i):
        return 0
    a, b = one.places[i], two.places[j]
    first, second = np.argsort(a), np.argsort(b)
    if min(len(one), len(two)) > 1:
        counts = _beside((b - a)[first])
        also = np.zeros(len(a), bool)
        also[second] = _beside((b - a)[second])
        first = first[counts | also[first]]
    rising = b[first]
    if (rising[1:] > rising[:-1]).all():
        return len(rising)
    tops: list[int] = []  # least end of a rising sequence of each length
    for x in rising.tolist():
        at = bisect_left(tops, x)
        tops[at:at + 1] = [x]
    return len(tops)


def _shares(one: Anchors, two: Anchors) -> tuple[float, float]:
    if not len(one) or not len(two):
        alike = float(len(one) == len(two))
        return alike, alike
    n = common(one, two)
    return 2 * n / (len(one) + len(two)), n / min(len(one), len(two))


def likeness(one: str, two: str) -> float:
    """Share of the anchors of two fingerprints that are in common by position."""
    return _shares(Anchors.of(one), Anchors.of(two))[0]


def held(one: str, two: str) -> float:
    """Share of the anchors of the shorter fingerprint that the other has in the same order."""
    return _shares(Anchors.of(one), Anchors.of(two))[1]


def followed(docs: DataFrame, work, ddl: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Stream (id, text, text of the next document by id) through ``work``, a generator of columns.

    Ids are cut into ranges at approximate quantiles, one per shuffle partition.  The first document of
    each range is also sent, as a closing row, to the range before it, and that of the first range to the
    last.  Texts are shuffled once, compressed; a task holds two of them.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    last = (1 << 63) - 1
    keyed = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
                        F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(last)).alias("id"),
                        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary").alias("text"))
    cuts = keyed.agg(F.percentile_approx("id", [k / parts for k in range(1, parts)], 10_000).alias("c")).first()["c"] \
        if parts > 1 else []
    cuts = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def part_of(ids):
        import pandas as pd
        return pd.Series(np.searchsorted(cuts, ids.to_numpy(), side="right")).astype("int32")

    # one row per range
    heads = sorted((r["part"], r["id"]) for r in keyed.groupBy(part_of("id").alias("part")).agg(
        F.min("id").alias("id")).collect())
    closes = {first: heads[k - 1][0] for k, (_, first) in enumerate(heads)}

    def deal(slices):
        squeeze = zstandard.ZstdCompressor(level=3)
        for rows in slices:
            out = []
            for doc, key, raw in rows:
                part = int(np.searchsorted(cuts, key, side="right"))
                row = (doc, key, hashlib.md5(raw).digest(), squeeze.compress(raw))
                out.append((part, False, *row))
                if key in closes:
                    out.append((closes[key], True, *row))
            yield dict(zip(("part", "closing", "doc_id", "id", "tie", "packed"), map(list, zip(*out))))

    dealt = by_arrow(keyed, deal, "part int, closing boolean, doc_id bigint, id bigint, tie binary, packed binary")
    dealt = dealt.repartition("part").sortWithinPartitions("part", "closing", "id", "tie")

    def pairs(batches):
        unpack = zstandard.ZstdDecompressor()
        held = None
        for batch in batches:
            for part, closing, doc, packed in zip(*[batch.column(k).to_pylist() for k in (0, 1, 2, 5)]):
                whole = unpack.decompress(packed).decode()
                if held is not None and held[0] == part:
                    yield held[1], held[2], whole
                    held = None
                if not closing:
                    held = part, doc, whole

    return over_batches(dealt, lambda batches: work(pairs(batches)), ddl)


def report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness; one row per document."""
    def work(rows):
        rolling = Rolling()
        known, known_list = None, None
        for doc, whole, after in rows:
            own = known_list if whole == known else Anchors(listed(whole, rolling))
            known, known_list = after, Anchors(listed(after, rolling))
            half = len(whole) // 2
            edited = whole[:len(whole) - half] + after[:half]
            changed = Anchors(listed(edited, rolling))
            (near_edited, held_edited), (near_next, held_next) = _shares(own, changed), _shares(own, known_list)
            yield {"doc_id": [doc], "n_chars": [len(whole)], "fingerprint": [_digits(own.found)],
                   "edited_fingerprint": [_digits(changed.found)],
                   "edited_sha256": [hashlib.sha256(edited.encode()).hexdigest()],
                   "near_edited": [near_edited], "near_next": [near_next],
                   "held_edited": [held_edited], "held_next": [held_next]}

    return followed(docs, work, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
                    "edited_fingerprint string, near_edited double, near_next double, held_edited double, "
                    "held_next double", doc_id=doc_id, text=text)
