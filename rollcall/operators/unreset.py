"""Running totals that were reset to zero at a new year."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.cells import is_dirty, like_column, replace_columns, to_long
from rollcall.functions.spread import attach
from rollcall.spec import SHEET, PanelSpec

# Running totals that were reset.
RESET_COLUMNS = ("Cume_Res_Pos", "Cume_Staff_Pos", "Cume_Res_Death", "Cume_Staff_Death")


@dataclass(frozen=True)
class Reset:
    """When the totals were reset.  The defaults are fixed values of the facility sheet."""

    base_date: int = 20201231      # last date with the old totals
    listed_after: int = 20210101   # later state dates must all be present once an entity began
    correct_from: int = 20210000   # rows from here on get the base added
    columns: tuple[str, ...] = RESET_COLUMNS


def _entity_facts(df: DataFrame, spec: PanelSpec, reset: Reset) -> DataFrame:
    """Per entity: its new-year dates, its base totals and what the state's dates require of it."""
    date = F.col(spec.date)
    listed = F.when(date > reset.listed_after, date)
    # the base totals, and whether they are text that is no number
    base = F.struct(*[to_long(df, c).alias(f"b{i}") for i, c in enumerate(reset.columns)],
                    *[is_dirty(df, c).alias(f"t{i}") for i, c in enumerate(reset.columns)])
    # at most one array entry per calendar date
    entities = (df.where(F.col(spec.entity).isNotNull()).groupBy(*spec.entity_key).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(spec.order).alias("_first"),
        F.min_by(base, F.when(date == reset.base_date, F.col(spec.order))).alias("_base"),
        F.collect_set(listed).alias("_own")))
    state_dates = (df.where(date > reset.listed_after).groupBy(spec.state)
                   .agg(F.collect_set(date).alias("_listed")).select("_listed", spec.state))
    joined = entities.join(state_dates, spec.state, "left")
    kind = df.schema[spec.date].dataType.simpleString()
    required = F.filter("_listed", lambda d: d >= F.array_min("_own"))
    return joined.select(
        *spec.entity_key, "_rows", "_first", "_base",
        F.coalesce(F.array_except("_listed", "_own"), F.array().cast(f"array<{kind}>"))
        .alias("_missing"),
        ((F.size("_own") == 0) | (F.size("_own") == F.size(required))).alias("_gapless"))


def undo_reset(df: DataFrame, spec: PanelSpec = SHEET, reset: Reset = Reset()) -> DataFrame:
    """Add the totals of the base date to an entity's totals after the reset.

    Entities that, once they have reported after the reset, skip a date on which their state
    has rows are left alone, and so are entities without a row on the base date.  Others first
    get rows for the state dates they lack: copies of their first row without metrics.  A
    missing value counts as zero, a missing base makes the result missing, and text in the base
    or in the cell leaves the cell alone.  State dates are those of all rows, also of rows
    without entity, which are dropped.  ``order`` must be unique within an entity.
    """
    rows = df.where(F.col(spec.entity).isNotNull())
    facts = _entity_facts(df, spec, reset).where("_gapless and _base is not null")
    marked = attach(rows, facts.drop("_gapless"), spec.entity_key, count="_rows",
                    salt=F.col(spec.order))
    own = F.array(spec.date)
    every = F.when(F.col(spec.order) == F.col("_first"),
                   F.concat(own, F.col("_missing"))).otherwise(own)
    spread = marked.select("*", F.explode(every).alias("_at"))
    is_own = F.col("_at").eqNullSafe(F.col(spec.date))
    corrects = F.col("_base").isNotNull() & (F.col("_at") >= reset.correct_from)
    changed = {c: F.when(is_own, F.col(f"`{c}`")) for c in spec.metrics}
    for i, c in enumerate(reset.columns):
        value = F.when(is_own, to_long(rows, c))
        total = F.col("_base").getField(f"b{i}") + F.coalesce(value, F.lit(0))
        text = F.coalesce(F.col("_base").getField(f"t{i}"), F.lit(False)) | (is_own & is_dirty(rows, c))
        changed[c] = (F.when(corrects & ~text, like_column(rows, c, total))
                      .otherwise(changed.get(c, F.col(f"`{c}`"))))
    changed[spec.date] = F.col("_at")
    return replace_columns(spread, changed).select(*[F.col(f"`{c}`") for c in df.columns])


def early_leavers(df: DataFrame, spec: PanelSpec = SHEET, reset: Reset = Reset()) -> DataFrame:
    """Facilities whose entity has gapless new-year dates but no row on the base date."""
    facts = _entity_facts(df, spec, reset).where("_gapless and _base is null")
    # names per entity are combined before the join, so busy entities are not hot here
    names = df.select(*spec.entity_key, spec.facility).distinct()
    return names.join(facts, spec.entity_key, "left_semi").select(spec.state, spec.facility).distinct()
