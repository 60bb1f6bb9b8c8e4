"""Cell-level expressions: text cleanup, tolerant numbers, row fingerprints."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Blanks as a text split sees them: Unicode white space plus the four ASCII separators.
BLANK_RUN = r"(?U)[\s\x1c-\x1f]+"
# Text of these characters, without double spaces, has nothing to re-space.  One short test: one for each blank, on
# every column, makes methods that are too long for the JVM to compile.
ODD = r"[^\x20-\x7E]"


def tidy_text(c: Column) -> Column:
    """Upper-case, trim, turn every run of blanks into one space; null becomes ''."""
    text = F.upper(F.coalesce(c, F.lit("")))
    # the pattern is slow; ASCII text with single spaces, which is most, does without
    odd = F.rlike(c, F.lit(ODD)) | F.contains(c, F.lit("  "))
    return F.trim(F.when(odd, F.regexp_replace(text, BLANK_RUN, " ")).otherwise(text))


def strip_odd_characters(c: Column) -> Column:
    """New line -> space, U+0372 and U+2010 -> '-', section sign dropped."""
    for odd, plain in (("\n", " "), ("§", ""), ("Ͳ", "-"), ("‐", "-")):
        c = F.replace(c, F.lit(odd), F.lit(plain))
    return c


def text_to_double(c: Column) -> Column:
    """Text as a double or null.  A Java type suffix ('3d', '3f') is not a number."""
    suffixed = F.lower(F.substring(F.rtrim(c), -1, 1)).isin("d", "f")
    return F.when(~suffixed, c.try_cast("double"))


def to_long(df: DataFrame, name: str) -> Column:
    """The cell truncated to BIGINT, or null when it is no finite number."""
    kind = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(kind, T.IntegralType):
        return c.cast("bigint")
    if isinstance(kind, T.StringType):
        # plain digits need no detour over double, which would round beyond 2^53
        return F.coalesce(c.try_cast("bigint"),
                          text_to_double(c).try_cast("bigint"))
    return c.try_cast("bigint")


def is_dirty(df: DataFrame, name: str) -> Column:
    """True when the cell holds something that is not a number; null cells are clean."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.lit(False)
    return F.col(f"`{name}`").isNotNull() & to_long(df, name).isNull()


def like_column(df: DataFrame, name: str, value: Column) -> Column:
    """Cast a computed number back to the declared type of the column it replaces."""
    return value.cast(df.schema[name].dataType)


def null_safe_add(a: Column, b: Column) -> Column:
    """Sum in which a null counts as absent; null only when both are."""
    return F.coalesce(a + b, a, b)


def sum_skipping_nulls(columns: list[str]) -> Column:
    """Row-wise sum with nulls as zero, so an all-null row sums to 0."""
    return reduce(add, [F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in columns])


def any_of(conditions) -> Column:
    """True when one of the conditions holds."""
    return reduce(or_, list(conditions))


def fingerprint(columns: list[str], seed: str) -> Column:
    """64-bit hash of a row that tells null from any value; the seed gives independent hashes."""
    parts: list[Column] = [F.lit(seed)]
    for c in columns:
        col = F.col(f"`{c}`")
        parts += [col, col.isNull()]
    return F.xxhash64(*parts)


def replace_columns(df: DataFrame, changed: dict[str, Column]) -> DataFrame:
    """Replace the named columns in place, keeping column order, in one projection."""
    return df.select(*[changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in df.columns])
