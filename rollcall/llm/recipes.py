"""Exact dedup (operator 13) by recipes of content-defined chunks, with DataFrame functions only.

Texts count as equal when they are identical once every run of blanks has become one space.  A normalised
text is cut after each pair of neighbouring words whose hash is divisible by ``CHUNK_WORDS``, so equal texts
are cut alike and a chunk depends on its own words.  A chunk's identifier is two 64-bit hashes; all distinct
chunks of the corpus are compared by their bytes, and should two unlike chunks share an identifier, everything
is done again with other hashes.  So an identifier stands for one chunk, and texts are equal exactly when
their ordered lists of identifiers (recipes) are.  Only the lists, about a fiftieth of the text, are grouped
and joined; bytes of chunks travel once, each distinct chunk once per task that meets it.

Groups are summed where rows lie before they are shuffled, and rows get their group by a join that adaptive
execution can split, so a group may hold any share of the rows.

Defined results: null text is read as empty, and empty texts are equal; a text of blanks alone is one space;
a text without two words is one chunk; of equal texts the row with the smallest id stays, rows without an id
coming last, and of rows that share the smallest id one; with no id in a group ``keep_id`` is null; repeated
rows are members of their group like any other; an empty table gives an empty table; further columns are
neither read nor changed, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.lineage import settle

BLANKS = r"[\x20\x09-\x0D]+"
CHUNK_WORDS = 64  # words of a chunk, on average


def identifier(chunk: Column, salt: int) -> Column:
    return F.struct(F.xxhash64(F.lit(2 * salt), chunk).alias("a"), F.xxhash64(F.lit(2 * salt + 1), chunk).alias("b"))


def chunked(texts: DataFrame) -> DataFrame:
    """Add the ``words`` and ``chunks`` of the column ``text``; joined by spaces either gives the normalised text."""
    def cuts(at):
        pair = F.xxhash64(F.element_at("words", at), F.get("words", at))
        return (at == F.size("words")) | (F.pmod(pair, F.lit(CHUNK_WORDS)) == 0)

    def piece(end, k):
        start = F.coalesce(F.get("ends", k - 1), F.lit(0))
        return F.array_join(F.slice("words", start + 1, end - start), " ")

    return (texts.withColumn("words", F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), BLANKS, -1))
            .withColumn("ends", F.filter(F.sequence(F.lit(1), F.size("words")), cuts))
            .withColumn("chunks", F.transform("ends", piece)).drop("ends"))


def recipes(texts: DataFrame, salt: int) -> DataFrame:
    """(row, doc_id, recipe, text_sha256) of rows (row, doc_id, text)."""
    return chunked(texts).select(
        "row", "doc_id", F.transform("chunks", lambda c: identifier(c, salt)).alias("recipe"),
        F.sha2(F.array_join("words", " ").cast("binary"), 256).alias("text_sha256"))


def ambiguous(texts: DataFrame, salt: int) -> DataFrame:
    """Identifiers that stand for two or more unlike chunks."""
    # no text is without chunks; a plain explode would add a filter on that, which the optimizer moves below the
    # split, so that it splits anew for each word
    chunks = chunked(texts.select("text")).select(F.explode_outer("chunks").alias("chunk"))
    distinct = chunks.select(identifier(F.col("chunk"), salt).alias("id"), "chunk").distinct()
    return distinct.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def marked(texts: DataFrame) -> DataFrame:
    """row, doc_id, keep_id, group_size, kept and text_sha256 of rows (row, doc_id, text)."""
    salt = 0
    while not ambiguous(texts, salt).isEmpty():
        salt += 1
    rows = settle(recipes(texts, salt))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    groups = rows.groupBy("recipe").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1")
    single = F.col("n").isNull()
    return rows.join(groups, "recipe", "left").select(
        "row", "doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        (single | (F.col("row") == F.col("first.row"))).alias("kept"), "text_sha256")


def report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document, dropped ones too."""
    # rows are numbered in the table of recipes, which is written before it is used
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").alias("doc_id"),
                        F.col(f"`{text}`").alias("text"))
    return marked(texts).drop("row")


def dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of equal texts, with all its columns."""
    user = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("user")
    numbered = settle(docs.select(F.monotonically_increasing_id().alias("row"), user))
    marks = marked(numbered.select("row", F.col(f"user.`{doc_id}`").alias("doc_id"), F.col(f"user.`{text}`").alias("text")))
    return numbered.join(marks.where("kept").select("row"), "row", "left_semi").select("user.*")
