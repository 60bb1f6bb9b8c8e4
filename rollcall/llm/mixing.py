"""Mixing sources to target weights (operator 8).

Sizes are summed per source, a repetition rate ``target / size`` is derived for each source, and every
document is emitted floor(rate) times plus once more with probability ``rate - floor(rate)``, decided by
a hash of its id.  Reruns and lost tasks therefore decide alike.

Defined results: null or empty text has size 0 and is emitted like any other document of its source;
a null source is a source of its own, last in order; rows that share an id share the decision; a null id
draws by its text; an empty table gives an empty table.  Further columns are left alone by ``emit``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions.lineage import settle
from rollcall.llm.tasks import whole_row

WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("bigint")


def ranked(sources: DataFrame, by: str) -> DataFrame:
    """Add ``nth`` (from 0, null last) without bringing the rows into one task: places inside range
    partitions plus the number of rows in earlier partitions."""
    order = F.col(by).asc_nulls_last()
    placed = settle(sources.repartitionByRange(order).sortWithinPartitions(order)
                    .withColumn("_at", F.monotonically_increasing_id()))
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    # one row per partition
    before = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(
            Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return (placed.withColumn("_part", part).join(F.broadcast(before), "_part")
            .withColumn("nth", place + F.col("_before")).drop("_at", "_part", "_before"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5,
            cap: float = 2.0) -> DataFrame:
    """Target per source from rows of (source, size).

    A target is the source's weight times a common level, at most ``cap`` times its size; each round
    raises the level by what capped sources leave over, until no further source is capped.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod("nth", F.lit(len(weights))) + 1).cast("int"))
    table = settle(ranked(per_source, "source").select(
        "source", "source_size", weight.alias("weight"), (F.col("source_size") * F.lit(cap)).alias("most")))
    whole = table.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first()["n"]
    level, capped = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > F.col("most")
        now = table.agg(F.count(F.when(above, 1)).alias("n"),
                        F.coalesce(F.sum(F.when(above, F.col("most"))), F.lit(0.0)).alias("given"),
                        F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)).alias("open")).first()
        if now["n"] == capped or now["open"] == 0:
            break
        capped, level = now["n"], (share * whole - now["given"]) / now["open"]
    return table.select("source", "source_size",
                        F.least(F.col("weight") * F.lit(level), F.col("most")).alias("target"))


def draw(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the seed and the id only."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), text.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def copies(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
           weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0,
           seed: str = "mix") -> DataFrame:
    """doc_id, source, size, source_size, target and ``copies`` (how often the mix takes the document)."""
    sized = settle(docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
        size_of(text).alias("size"), draw(F.col(f"`{doc_id}`"), F.col(f"`{text}`"), seed).alias("_draw")))
    goals = settle(targets(sized, weights, share, cap).select(
        F.struct("source").alias("_source"), "source_size", "target"))
    # a struct is never null, so the source without a name joins like any other
    rate = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    return (sized.withColumn("_source", F.struct("source")).join(goals, "_source", "left")
            .withColumn("copies", (F.floor(rate) + F.when(F.col("_draw") < rate - F.floor(rate), 1)
                                   .otherwise(0)).cast("bigint"))
            .drop("_source", "_draw"))


def emit(docs: DataFrame, *, doc_id: str = "doc_id", **options) -> DataFrame:
    """The mixed corpus: each document as often as the mix takes it, ``mix_copy`` counting from 1."""
    taken = copies(docs, doc_id=doc_id, **options).where("copies > 0").groupBy("doc_id").agg(
        F.max("copies").alias("copies")).select(F.struct("doc_id").alias("key"), "copies")
    plain = docs.drop("mix_copy")
    return (plain.select(whole_row(plain), F.struct(F.col(f"`{doc_id}`").alias("doc_id")).alias("key")).join(taken, "key")
            .select("user.*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("mix_copy")))
