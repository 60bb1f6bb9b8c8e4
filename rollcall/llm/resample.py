"""Target-distribution importance resampling (operator 12) over hashed n-grams of words.

A 256-byte table lower-cases A-Z and blanks everything below 0x80 that is no letter or digit, ``bytes.split``
gives the words, and n-grams are hashed by chained CRC seeds: the CRC of an n-gram is the seed from which the
next word extends it, so it equals the CRC of the words joined by one space.  Counters reduce a task's
features to at most ``buckets`` rows.  A bucket's gain is the log ratio, in thousandths, of its smoothed share
in the target to that in the corpus; a document's weight sums the gains of its features.  Adding Gumbel noise,
hashed from the id, and taking the highest scores draws without replacement in proportion to exp(weight / 1000).

The table of gains has ``buckets`` rows whatever the corpus holds.  The draw ranks all documents by a range
sort and the row counts of its partitions; nothing is gathered in one task.

Defined results: null and empty texts have no features, weight 0 and rank null; documents under ``min_words``
words are scored but not drawn; an empty target or corpus is smoothed like any other; a null id reads as no
characters in the hash and comes last among ties; rows alike in score and id are ranked in the order of one
written table; repeated rows count and are ranked as often as they occur; an empty table gives an empty
table; further columns are not read by ``report`` and passed on by ``draw``, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions.lineage import settle
from rollcall.llm.tasks import as_bytes, by_arrow

# letters and digits stay, A-Z as a-z, bytes of characters beyond ASCII too; all others separate words
TABLE = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def features(text: bytes, size: int) -> tuple[int, list[int]]:
    """Number of words, and the hashes of all runs of 1 to ``size`` words."""
    words = text.translate(TABLE).split()
    longest = list(map(crc32, words))
    found = longest
    if size > 1:
        more = [b" " + w for w in words]
        for n in range(1, size):
            longest = list(map(crc32, more[n:], longest))
            found = found + longest
    return len(words), found


def spread(texts: DataFrame, buckets: int, size: int) -> np.ndarray:
    """How many features of all texts fall in each bucket."""
    def work(slices):
        total = Counter()
        for rows in slices:
            for (text,) in rows:
                for h, n in Counter(features(text, size)[1]).items():
                    total[h % buckets] += n
        yield {"bucket": list(total), "n": list(total.values())}

    out = np.zeros(buckets, np.int64)
    for r in by_arrow(texts, work, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> list[int]:
    n, size_s, size_t = len(corpus), float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    return [math.floor(1000 * math.log((float(target[k]) + 1) * size_s / ((float(corpus[k]) + 1) * size_t)))
            for k in range(n)]


def numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """Add ``nth`` (from 1) in ``order``, which should not leave ties: places within range partitions plus
    the rows of the partitions before."""
    placed = settle(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # one row for each partition
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(before, F.lit(0)).alias("before"))
    return (placed.withColumn("part", part).join(F.broadcast(counts), "part")
            .withColumn("nth", F.col("at").bitwiseAND((1 << 33) - 1) + F.col("before") + 1).drop("at", "part", "before"))


def gumbel(doc_id: Column, seed: int) -> Column:
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")


def scored(texts: DataFrame, target: DataFrame, buckets: int, size: int, seed: int) -> DataFrame:
    """row, doc_id, n_words, n_features, weight and score of rows (row, doc_id, text as bytes)."""
    gain = gains(spread(texts.select("text"), buckets, size), spread(target, buckets, size))
    shipped = texts.sparkSession.sparkContext.broadcast(gain)

    def work(slices):
        gain = shipped.value
        for rows in slices:
            out = {"row": [r[0] for r in rows], "doc_id": [r[1] for r in rows], "n_words": [], "n_features": [], "weight": []}
            for _, _, text in rows:
                n, found = features(text, size)
                out["n_words"].append(n)
                out["n_features"].append(len(found))
                out["weight"].append(sum(gain[h % buckets] for h in found))
            yield out

    weighed = by_arrow(texts, work, "row bigint, doc_id bigint, n_words bigint, n_features bigint, weight bigint")
    return weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))


def ranked(texts: DataFrame, target: DataFrame, *, buckets: int, size: int, share: int, min_words: int, seed: int) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3 ... for the ``share`` per cent drawn of the documents long enough."""
    table = settle(scored(texts, target, buckets, size, seed))
    enough = F.col("n_words") >= min_words
    most = share * table.where(enough).count() // 100
    order = numbered(table.where(enough), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row"))
    nth = F.when(F.col("nth") <= most, F.col("nth")).cast("bigint")
    return order.withColumn("rank", nth).drop("nth").unionByName(
        table.where(~enough).withColumn("rank", F.lit(None).cast("bigint")))


def report(docs: DataFrame, target: DataFrame, *, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
           buckets: int = 10_000, size: int = 1, share: int = 10, min_words: int = 20, seed: int = 2024) -> DataFrame:
    """One row per document, drawn or not."""
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
                        as_bytes(text).alias("text"))
    return ranked(texts, target.select(as_bytes(target_text)), buckets=buckets, size=size, share=share,
                  min_words=min_words, seed=seed).select("doc_id", "n_features", "weight", "score", "rank")


def draw(docs: DataFrame, target: DataFrame, *, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
         buckets: int = 10_000, size: int = 1, share: int = 10, min_words: int = 20, seed: int = 2024) -> DataFrame:
    """The documents drawn, with all their columns."""
    user = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("user")
    table = settle(docs.select(F.monotonically_increasing_id().alias("row"), user))
    texts = table.select("row", F.col(f"user.`{doc_id}`").cast("bigint").alias("doc_id"), as_bytes(f"user`.`{text}").alias("text"))
    ranks = ranked(texts, target.select(as_bytes(target_text)), buckets=buckets, size=size, share=share,
                   min_words=min_words, seed=seed)
    return table.join(ranks.where("rank IS NOT NULL").select("row"), "row", "left_semi").select("user.*")
