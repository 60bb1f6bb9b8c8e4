"""Running totals hidden behind no-data markers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions.cells import any_of, replace_columns
from rollcall.functions.spread import attach
from rollcall.spec import SHEET, PanelSpec

# Cells that mean "no data", after lower-casing.
NO_DATA = ("no data", "nd", "not reported", "data pending", "closed")


def replace_no_data(df: DataFrame, spec: PanelSpec = SHEET, *, markers=NO_DATA) -> DataFrame:
    """Put the entity's previous value in place of a no-data marker.

    The previous value is that of the first row on the entity's previous report date, itself
    repaired; a known-empty previous cell stays empty, and so does a marker on the first date.
    All running totals become lower-case text.
    """
    cells = {c: F.lower(F.col(f"`{c}`").cast("string")) for c in spec.running}
    rows = replace_columns(df, cells)
    hidden = {c: F.coalesce(F.col(f"`{c}`").isin(*markers), F.lit(False)) for c in spec.running}
    any_hidden = any_of(hidden.values())

    values = F.struct(*[F.col(f"`{c}`") for c in spec.running])
    per_date = rows.where(F.col(spec.entity).isNotNull()).groupBy(*spec.slot_key).agg(
        F.min_by(values, spec.order).alias("_first"),
        F.count_if(any_hidden).alias("_rows"))
    # an entity has at most one row per report date from here on
    before = (Window.partitionBy(*spec.entity_key).orderBy(spec.date)
              .rowsBetween(Window.unboundedPreceding, -1))
    known = []
    for i, c in enumerate(spec.running):
        cell = F.col("_first").getField(c)
        # wrapped, so that a known null is not skipped as missing
        visible = F.when(~F.coalesce(cell.isin(*markers), F.lit(False)), F.struct(cell.alias("v")))
        known.append(F.last(visible, ignorenulls=True).over(before).getField("v").alias(f"_p{i}"))
    facts = per_date.select(*spec.slot_key, "_rows", *known).where("_rows > 0")

    repaired = attach(rows.where(any_hidden), facts, spec.slot_key, count="_rows",
                      salt=F.col(spec.order))
    repaired = replace_columns(repaired, {
        c: F.when(hidden[c], F.col(f"_p{i}")).otherwise(F.col(f"`{c}`"))
        for i, c in enumerate(spec.running)}).select(*[F.col(f"`{c}`") for c in rows.columns])
    return rows.where(~any_hidden).unionByName(repaired)
