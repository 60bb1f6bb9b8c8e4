"""Entity ids from the registry of known facilities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.cells import replace_columns
from rollcall.functions.spread import attach, busy, row_salt
from rollcall.spec import SHEET, PanelSpec

# Column names of the registry sheet.
REGISTRY_COLUMNS = ("Facility", "City", "County", "ctp_state", "CTP_Facility_Type", "state", "ctp_id")

UNKNOWN = "unknown facility"


def registry_ids(registry: DataFrame, spec: PanelSpec = SHEET) -> DataFrame:
    """One id per upper-cased registry key; of several rows with one key the last one counts.

    Only rows whose own sheet (``state``) is the state they describe can be looked up.
    """
    upper = {c: F.upper(F.coalesce(F.col(c), F.lit(""))) for c in REGISTRY_COLUMNS[:5]}
    keyed = registry.select(
        upper["Facility"].alias(spec.facility), upper["City"].alias(spec.city),
        upper["County"].alias(spec.county), upper["ctp_state"].alias(spec.state),
        upper["CTP_Facility_Type"].alias(spec.facility_type),
        F.col("state").alias("_sheet"), F.col("ctp_id").alias("_id"),
        F.col(spec.order).alias("_row"))
    keys = _lookup_key(spec)
    return (keyed.where(F.col("_sheet") == F.col(spec.state))
            .groupBy(*keys).agg(F.max_by("_id", "_row").alias("_id"))
            .where(F.col("_id").cast("string") != ""))


def _lookup_key(spec: PanelSpec) -> list[str]:
    return [spec.facility, spec.city, spec.county, spec.state, spec.facility_type]


def match_entities(df: DataFrame, registry: DataFrame, spec: PanelSpec = SHEET) -> DataFrame:
    """Left lookup: adds ``_id``, null where the registry knows no such facility.

    Busy facilities are spread.
    """
    ids, keys = registry_ids(registry, spec), _lookup_key(spec)
    return attach(df, ids, keys, count="_rows", salt=row_salt(df, spec),
                  hot_facts=busy(df, ids, keys, count="_rows"))


def add_entity_id(df: DataFrame, registry: DataFrame, spec: PanelSpec = SHEET) -> DataFrame:
    """Strict lookup: the query fails when a row has no id in the registry."""
    matched = match_entities(df, registry, spec)
    key_text = F.concat_ws(" | ", *[F.col(f"`{c}`") for c in _lookup_key(spec)])
    refuse = F.raise_error(F.concat(F.lit("no entity id for: "), key_text))
    found = F.when(F.col("_id").isNull(), refuse).otherwise(F.col("_id"))
    known = matched.withColumn("_id", found)
    if spec.entity not in df.columns:
        return known.withColumnRenamed("_id", spec.entity)
    return replace_columns(known, {spec.entity: F.col("_id")}).drop("_id")


def set_aside_unknown(df: DataFrame, registry: DataFrame, spec: PanelSpec = SHEET) -> DataFrame:
    """As ``add_entity_id``, but rows without an id stay, without entity, and ``_issue`` and ``_detail`` say so.

    Rows that have an issue already keep it.
    """
    matched = match_entities(df, registry, spec)
    unknown = F.col("_issue").isNull() & F.col("_id").isNull()
    changed = {"_issue": F.when(unknown, UNKNOWN).otherwise(F.col("_issue")),
               "_detail": F.when(unknown, F.concat_ws(" | ", *[F.col(f"`{c}`") for c in _lookup_key(spec)]))
               .otherwise(F.col("_detail"))}
    if spec.entity not in df.columns:
        return replace_columns(matched, changed).withColumnRenamed("_id", spec.entity)
    return replace_columns(matched, changed | {spec.entity: F.col("_id")}).drop("_id")


def unmatched_entities(df: DataFrame, registry: DataFrame, spec: PanelSpec = SHEET) -> DataFrame:
    """Quarantine: distinct lookup keys that the registry does not know, with their row counts."""
    keys = _lookup_key(spec)
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(registry_ids(registry, spec), keys, "left_anti")
