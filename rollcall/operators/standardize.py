"""Row standardization: required keys, integer dates, tidy text, entity ids, exact duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.cells import replace_columns, strip_odd_characters, tidy_text, to_long
from rollcall.operators.entity import add_entity_id, set_aside_unknown
from rollcall.spec import SHEET, PanelSpec

BAD_DATE = "bad date"


def drop_unkeyed_rows(df: DataFrame, spec: PanelSpec = SHEET) -> DataFrame:
    """Drop rows without a facility name or a date."""
    return df.na.drop(subset=[spec.facility, spec.date])


def unreadable_dates(df: DataFrame, spec: PanelSpec = SHEET) -> DataFrame:
    """Quarantine: rows whose date is present but is no number."""
    return df.where(F.col(spec.date).isNotNull() & to_long(df, spec.date).isNull())


def integer_dates(df: DataFrame, spec: PanelSpec = SHEET) -> DataFrame:
    """Dates as yyyymmdd integers; fails on a date that is no number."""
    number = to_long(df, spec.date)
    refuse = F.raise_error(F.concat(F.lit("not a date number: "), F.col(spec.date).cast("string")))
    date = F.when(number.isNull() & F.col(spec.date).isNotNull(), refuse).otherwise(number)
    return replace_columns(df, {spec.date: date.cast("int")})


def tidy_text_columns(df: DataFrame, spec: PanelSpec = SHEET) -> DataFrame:
    """Upper-case and re-space the seven key and label columns; null becomes ''."""
    names = (spec.county, spec.city, spec.state, spec.facility, spec.status,
             spec.state_type, spec.facility_type)
    return replace_columns(df, {c: tidy_text(F.col(f"`{c}`")) for c in names if c in df.columns})


def clean_names(df: DataFrame, spec: PanelSpec = SHEET) -> DataFrame:
    """Replace odd characters in facility, county and city names."""
    names = (spec.facility, spec.county, spec.city)
    return replace_columns(
        df, {c: strip_odd_characters(F.col(f"`{c}`")) for c in names if c in df.columns})


def drop_exact_duplicates(df: DataFrame, spec: PanelSpec = SHEET) -> DataFrame:
    """Keep the first of rows that agree in every column but the ordinal.

    The grouping combines copies before the shuffle, so many copies of one row are no hot group.
    """
    if spec.order not in df.columns:
        return df.dropDuplicates()
    content = [c for c in df.columns if c != spec.order]
    first = df.groupBy(*[F.col(f"`{c}`") for c in content]).agg(
        F.min(spec.order).alias(spec.order))
    return first.select(*[F.col(f"`{c}`") for c in df.columns])


def standardize(df: DataFrame, spec: PanelSpec = SHEET, *, registry: DataFrame | None = None
                ) -> DataFrame:
    """The first step of every state chain.

    Without a ``registry`` the entity ids of the frame are kept as they are.
    """
    out = tidy_text_columns(integer_dates(drop_unkeyed_rows(df, spec), spec), spec)
    if registry is not None:
        out = add_entity_id(out, registry, spec)
    return drop_exact_duplicates(clean_names(out, spec), spec)


def sort_out(df: DataFrame, spec: PanelSpec = SHEET, *, registry: DataFrame | None = None) -> DataFrame:
    """``standardize`` that does not fail: rows it would fail on are tagged, in the same pass.

    ``_issue`` is null for good rows, else BAD_DATE (``_detail`` has the date's text) or UNKNOWN (``_detail``
    has the lookup key).  Tagged rows are standardized like the others; the date or id that cannot be had
    is null.
    """
    keyed = drop_unkeyed_rows(df, spec)
    bad = to_long(keyed, spec.date).isNull()
    tagged = keyed.withColumns({"_issue": F.when(bad, BAD_DATE),
                                "_detail": F.when(bad, F.col(spec.date).cast("string"))})
    out = tidy_text_columns(replace_columns(tagged, {spec.date: to_long(keyed, spec.date).cast("int")}), spec)
    if registry is not None:
        out = set_aside_unknown(out, registry, spec)
    return drop_exact_duplicates(clean_names(out, spec), spec)
