"""Near-duplicate groups (operator 4) by SetSketch registers.

A document's set holds its distinct shingles of ``width`` words, two by default (64-bit hashes).  Register i of its sketch is
``floor(1 - log_B(x_i))`` clipped to [0, TOP], where x_i is the least of the exponential variables that
hash i gives the shingles; registers of a union are the maxima of the registers, and two documents agree
in a register about as often as their sets do.

1. Equal sets are one class, named by its smallest id; only classes go on.
2. Registers are banded, ``ROWS`` to a band.  The centre of a bucket is its member that meets most others
   over all its buckets, which in a group of copies is the text they were made from.  Every member is
   compared with the centre on full sets: comparisons grow with the members, not with their square.
3. Links to centres give components.  Where members of a bucket end up in different components, pairs of
   them could still be links.  Each member is known by what it lacks and adds relative to the centre: both
   counts and a 256-bit map of each.  They bound the overlap of two members from above exactly, and only
   pairs whose bound allows a link leave the join.
4. Those pairs are estimated jointly from their registers (larger, smaller, equal) by maximum likelihood
   given both set sizes; where 0.8 is far less likely than the estimate they are dropped.  The rest is
   confirmed on full sets, and all links together give the components by label propagation.

With BANDS = 32 and ROWS = 4 a pair at exactly 0.8 shares no band with probability below 1e-7.

Defined results: null, empty and blank texts have the empty set and are linked with nothing; a text of
fewer words than a shingle is one shingle; equal rows of one id fall in one class; rows without an id are not linked: their
component_id is null and ``kept`` is true; empty tables give empty tables; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.lineage import settle
from rollcall.llm.tasks import as_bytes, by_arrow, over_batches, pack, rows_apart
from rollcall.llm.words import U64, hashed, mixed

BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
BASE, RATE, TOP = 1.02, 20.0, 65_534
LOG_GAP = 25.0  # a pair is dropped when 0.8 is e^25 times less likely than the best estimate
_SEEDS = mixed(np.arange(1, REGISTERS + 1, dtype=U64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingles(text: bytes, width: int = 2) -> np.ndarray:
    """Sorted hashes of the distinct shingles of ``width`` words; a text of fewer words counts as one."""
    words = text.lower().split()
    if not words:
        return np.empty(0, U64)
    h = hashed(words)[:, 0]
    if len(h) == 1:
        return mixed(h * np.uint64(3))
    runs = h
    for k in range(1, min(width, len(h))):
        runs = mixed(runs[:-1] * np.uint64(0x9E3779B97F4A7C15) + mixed(h[k:] + np.uint64(1)))
    return np.unique(runs)


def registers(items: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of 64-bit hashes."""
    least = np.full(REGISTERS, np.iinfo(U64).max, U64)
    for at in range(0, len(items), 256):  # blocks that stay in the processor's cache
        part = items[at:at + 256]
        scrambled = part[None, :] * _SEEDS[:, None]
        scrambled ^= scrambled >> np.uint64(32)
        scrambled *= np.uint64(0xBF58476D1CE4E5B9)
        np.minimum(least, scrambled.min(axis=1), out=least)
    uniform = (least.astype(np.float64) + 1.0) / 2.0 ** 64
    exponential = -np.log1p(-np.minimum(uniform, 1 - 1e-16)) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP).astype(np.uint16)


def likely(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, least: float) -> np.ndarray:
    """Whether similarity ``least`` is plausible for pairs with registers a and b and set sizes n_a, n_b.

    Joint likelihood of the counts of larger, smaller and equal registers over a grid of similarities.
    """
    larger = (a > b).sum(axis=1)[:, None]
    smaller = (a < b).sum(axis=1)[:, None]
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    grid = np.linspace(0.0, 1.0, 101)[None, :] * np.minimum(u / v, v / u)
    grid = np.concatenate([grid, np.broadcast_to(np.minimum(least, np.minimum(u / v, v / u)), (len(u), 1))], axis=1)

    def ahead(x):
        return -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)

    up, down = ahead(u - v * grid), ahead(v - u * grid)
    same = np.maximum(1 - up - down, 1e-12)
    score = larger * np.log(up) + smaller * np.log(down) + (REGISTERS - larger - smaller) * np.log(same)
    possible = np.minimum(n_a, n_b) >= least * np.maximum(n_a, n_b) * (1 - 1e-9)
    return possible & ((score[:, -1] >= score.max(axis=1) - LOG_GAP) | (grid[:, -2] <= least))


def sketches(docs: DataFrame, width: int = 2) -> DataFrame:
    """(id, n, low, high, registers) per row; low and high hash the whole set."""
    def work(slices):
        for rows in slices:
            sets = [shingles(text, width) for _, text in rows]
            ids = np.frombuffer(b"".join([xxhash.xxh3_128_digest(s) for s in sets]), np.int64).reshape(-1, 2)
            yield {"id": [i for i, _ in rows], "n": [len(s) for s in sets], "low": ids[:, 0], "high": ids[:, 1],
                   "registers": [registers(s).tobytes() if len(s) else None for s in sets]}

    return by_arrow(docs, work, "id bigint, n bigint, low bigint, high bigint, registers binary")


def _bands(classes: DataFrame) -> DataFrame:
    """(bucket, id): each class under the hash of each of its bands."""
    def work(slices):
        for rows in slices:
            bands = np.frombuffer(b"".join([r for _, r in rows]), np.uint16).reshape(len(rows), BANDS, ROWS)
            keys = np.zeros((len(rows), BANDS), U64) + np.arange(1, BANDS + 1, dtype=U64)[None, :]
            for k in range(ROWS):
                keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, k])
            yield {"bucket": keys.ravel().view(np.int64), "id": np.repeat([i for i, _ in rows], BANDS)}

    return by_arrow(classes.select("id", "registers"), work, "bucket bigint, id bigint")


def _plausible(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) that the joint estimate leaves."""
    one = classes.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("registers").alias("r_a"))
    two = classes.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("registers").alias("r_b"))

    def work(slices):
        for rows in slices:
            a, b, r_a, r_b = ([r[k] for r in rows] for k in (0, 1, 3, 5))
            n_a, n_b = (np.array([r[k] for r in rows], float) for k in (2, 4))
            r_a, r_b = (np.frombuffer(b"".join(r), np.uint16).reshape(len(rows), -1) for r in (r_a, r_b))
            keep = likely(r_a, r_b, n_a, n_b, least)
            yield {"a": np.array(a)[keep], "b": np.array(b)[keep]}

    joined = pairs.join(two, "b").join(one, "a")
    return by_arrow(joined.select("a", "b", "n_a", "r_a", "n_b", "r_b"), work, "a bigint, b bigint")


_MAPS = [f"{kind}{k}" for kind in ("lack", "plus") for k in range(4)]


def _bits(items: np.ndarray) -> np.ndarray:
    """256-bit map of a set of hashes as four integers."""
    flags = np.zeros(256, np.uint8)
    flags[(items & np.uint64(255)).astype(np.int64)] = 1
    return np.packbits(flags).view(np.int64)


def _measured(pairs: DataFrame, texts: DataFrame, least: int, width: int) -> DataFrame:
    """(a, b) with ``near`` (100 * shared >= least * all, on full sets) and b described relative to a:
    sizes, what b lacks of a and adds to it, as counts and as maps."""
    one = texts.select(F.col("id").alias("a"), F.col("packed").alias("t_a"))
    two = texts.select(F.col("id").alias("b"), F.col("packed").alias("t_b"))

    def work(batches):
        unpack = zstandard.ZstdDecompressor()
        last, first = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                rows = []
                for a, t_a, t_b in zip(*[part.column(k).to_pylist() for k in (0, 2, 3)]):
                    if a != last:
                        last, first = a, shingles(unpack.decompress(t_a), width)
                    other = shingles(unpack.decompress(t_b), width)
                    place = np.minimum(np.searchsorted(first, other), len(first) - 1)
                    shared = first[place] == other
                    n = int(shared.sum())
                    kept = np.zeros(len(first), bool)
                    kept[place[shared]] = True
                    rows.append([100 * n >= least * (len(first) + len(other) - n), len(first), len(other),
                                 len(first) - n, len(other) - n, *_bits(first[~kept]), *_bits(other[~shared])])
                names = ["near", "n_a", "n_b", "lacks", "adds", *_MAPS]
                yield {"a": part.column(0), "b": part.column(1)} | dict(zip(names, map(list, zip(*rows))))

    joined = pairs.join(two, "b").join(one, "a").select("a", "b", "t_a", "t_b")
    return over_batches(joined, work, "a bigint, b bigint, near boolean, n_a bigint, n_b bigint, lacks bigint, "
                        "adds bigint, " + ", ".join(f"{m} bigint" for m in _MAPS))


def components(links: DataFrame) -> DataFrame:
    """(id, component) of linked ids: the smallest id reachable.

    Each round every id takes the smallest label among its neighbours and then that label's own label, so
    chains halve; the table of labels is written each round.
    """
    both = settle(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = settle(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")))
    while True:
        seen = both.join(labels.select(F.col("a").alias("b"), F.col("label").alias("theirs")), "b")
        least = seen.groupBy("a").agg(F.min("theirs").alias("theirs"))
        lower = labels.join(least, "a").select(
            "a", F.col("label").alias("was"), F.least("label", "theirs").alias("label"))
        jump = labels.select(F.col("a").alias("label"), F.col("label").alias("further"))
        new = settle(lower.join(jump, "label", "left").select("a", "was", F.least("label", "further").alias("label")))
        labels = new.select("a", "label")
        if new.where("label < was").isEmpty():
            return labels.select(F.col("a").alias("id"), F.col("label").alias("component"))


def groups(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least: int = 80, width: int = 2) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document."""
    keyed = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("id"), as_bytes(text).alias("text"))
    sketched = settle(sketches(keyed, width))
    members = sketched.where("n > 0 AND id IS NOT NULL")
    classes = settle(members.groupBy("low", "high").agg(
        F.min("id").alias("id"), F.max("n").alias("n"), F.max("registers").alias("registers")))
    bands = settle(_bands(classes))
    sizes = settle(bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    buckets = settle(bands.join(sizes, "bucket"))
    crowd = settle(buckets.groupBy("id").agg(F.sum("size").alias("crowd")))
    centres = settle(buckets.join(crowd, "id").groupBy("bucket").agg(
        F.max_by("id", F.struct("crowd", -F.col("id"))).alias("a")))
    pairs = settle(buckets.join(centres, "bucket").where("id != a").select("a", F.col("id").alias("b")).distinct())
    packed = pack(keyed.select(F.col("id").alias("doc"), "text"))
    texts = settle(packed.join(crowd.select(F.col("id").alias("doc")), "doc").groupBy(F.col("doc").alias("id"))
                   .agg(F.max("packed").alias("packed")))
    known = settle(_measured(pairs, texts, least, width))
    links = known.where("near").select("a", "b")
    labels = components(links)
    further = settle(_plausible(settle(_unmet(known, labels, least)), classes, least / 100))
    if not further.isEmpty():
        more = settle(_measured(further, texts, least, width)).where("near").select("a", "b")
        labels = components(links.unionByName(more))
    classed = settle(classes.select("low", "high", "id").join(labels, "id", "left").select(
        "low", "high", F.coalesce("component", "id").alias("component")))
    out = sketched.select("id", "n", "low", "high").join(classed, ["low", "high"], "left")
    component = F.when(F.col("id").isNull(), F.lit(None).cast("bigint")).otherwise(
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def _unmet(known: DataFrame, labels: DataFrame, least: int) -> DataFrame:
    """Pairs of members of one centre that lie in different components and may be links.

    With C the centre, |x & y| = |C| - lacks_x - lacks_y + |both lack| + |both add|, and the maps bound
    the last two: shared places, plus the members that had to share a place.
    """
    named = labels.select("id", "component")
    mine = known.join(named.withColumnRenamed("id", "b"), "b", "left").withColumn(
        "component", F.coalesce("component", "b"))
    lead = named.select(F.col("id").alias("a"), F.col("component").alias("main"))
    mine = mine.join(lead, "a", "left").withColumn("main", F.coalesce("main", "a"))
    for kind, count in (("lack", "lacks"), ("plus", "adds")):
        crowded = sum((F.bit_count(f"{kind}{k}") for k in range(4)), F.lit(0))
        mine = mine.withColumn(f"{kind}_over", F.col(count) - crowded)
    mine = settle(mine)
    outside = mine.where("component != main")
    inside = mine.join(settle(outside.select("a").distinct()), "a", "left_semi")

    def both(kind: str, count: str):
        places = sum((F.bit_count(F.col(f"o.{kind}{k}").bitwiseAND(F.col(f"i.{kind}{k}"))) for k in range(4)), F.lit(0))
        return F.least(f"o.{count}", f"i.{count}", places + F.least(f"o.{kind}_over", f"i.{kind}_over"))

    most = (F.col("o.n_a") - F.col("o.lacks") - F.col("i.lacks") + both("lack", "lacks") + both("plus", "adds"))
    met = outside.alias("o").join(settle(inside).alias("i"), (F.col("o.a") == F.col("i.a"))
                                  & (F.col("o.component") != F.col("i.component"))
                                  & ((100 + least) * most >= least * (F.col("o.n_b") + F.col("i.n_b"))))
    return met.select(F.least("o.b", "i.b").alias("a"), F.greatest("o.b", "i.b").alias("b")).distinct()


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least: int = 80, width: int = 2) -> DataFrame:
    """``docs`` with one document of each group (its smallest id), same columns.

    Rows that share an id and have unlike texts are documents of their own, ordered by a hash; rows without an
    id stay.
    """
    rows = rows_apart(docs, doc_id, text).withColumn("doc", F.when(F.col("id").isNotNull(), F.col("doc")))
    gone = groups(rows.select("doc", "text"), doc_id="doc", least=least, width=width).where("NOT kept")
    return (rows.select("user", "doc").join(gone.select(F.col("doc_id").alias("doc")).distinct(), "doc", "left_anti")
            .select("user.*"))
