"""Missing labels filled from other rows of the same facility."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.cells import replace_columns
from rollcall.functions.spread import attach, row_salt
from rollcall.spec import SHEET, PanelSpec


def _most_common(df: DataFrame, keys: list[str], value: str, name: str, *more) -> DataFrame:
    """The most frequent value per key, the smallest of several; counted before it is ranked."""
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v"))).getField("v")
    return counted.groupBy(*keys).agg(best.alias(name), *more)


def fill_types_from_peers(df: DataFrame, spec: PanelSpec = SHEET, *, home: str = "NH",
                          other=("ALF", "ICF")) -> DataFrame:
    """Fill an empty state type with the facility's most common one.

    Facilities known both as ``home`` and as one of ``other`` are left alone.  When the filled
    type is ``home``, the facility's most common federal id replaces the row's.
    """
    keys, kind, fed = [spec.state, spec.facility], spec.state_type, spec.federal_id
    empty = F.coalesce(F.col(kind) == "", F.lit(False))
    peers = df.where(F.col(kind).isNotNull() & ~empty)
    types = _most_common(
        peers, keys, kind, "_type",
        (F.max(F.col(kind) == home) & F.max(F.col(kind).isin(*other))).alias("_mixed"))
    ids = _most_common(peers.where(F.col(fed).isNotNull()), keys, fed, "_fed")
    needed = df.where(empty).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    facts = (needed.join(types.where(~F.col("_mixed")), keys).join(ids, keys, "left")
             .select(*keys, "_rows", "_type", "_fed"))
    filled = attach(df.where(empty), facts, keys, count="_rows", salt=row_salt(df, spec))
    filled = replace_columns(filled, {
        kind: F.coalesce("_type", kind),
        fed: F.when(F.col("_type") == home, F.coalesce("_fed", fed)).otherwise(F.col(fed))})
    return df.where(~empty).unionByName(filled.select(*[F.col(f"`{c}`") for c in df.columns]))


def fill_counties_from_peers(df: DataFrame, spec: PanelSpec = SHEET) -> DataFrame:
    """Fill an empty county when the facility's other rows name exactly one.

    A row with a state type only looks at rows of that type.
    """
    keys, kind, county = [spec.state, spec.facility], spec.state_type, spec.county
    empty = F.coalesce(F.col(county) == "", F.lit(False))
    named = (df.where(F.col(county).isNotNull() & ~empty)
             .select(*keys, kind, county).distinct())
    only = F.when(F.min(county) == F.max(county), F.min(county))
    by_type = named.groupBy(*keys, kind).agg(only.alias("_same_type"))
    by_name = named.groupBy(*keys).agg(only.alias("_any_type"))
    needed = df.where(empty).groupBy(*keys, kind).agg(F.count(F.lit(1)).alias("_rows"))
    facts = (needed.join(by_type, [*keys, kind], "left").join(by_name, keys, "left")
             .select(*keys, kind, "_rows",
                     F.when(F.col(kind) == "", F.col("_any_type"))
                     .otherwise(F.col("_same_type")).alias("_county")))
    filled = attach(df.where(empty), facts, [*keys, kind], count="_rows", salt=row_salt(df, spec))
    filled = replace_columns(filled, {county: F.coalesce("_county", county)})
    return df.where(~empty).unionByName(filled.select(*[F.col(f"`{c}`") for c in df.columns]))
