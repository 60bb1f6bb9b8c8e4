"""Running totals corrected for events that closed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.cells import (is_dirty, like_column, null_safe_add, replace_columns,
                                      to_long)
from rollcall.functions.spread import by_entity
from rollcall.operators.densify import fill_missing_dates
from rollcall.spec import SHEET, PanelSpec

# Fixed value: first date on which a closing counts.
CARRY_FROM = 20210211


def carry_closed_event(df: DataFrame, spec: PanelSpec = SHEET, *, since: int = CARRY_FROM,
                       one_row_per_date: bool = False) -> DataFrame:
    """Add the last closed event to the running totals from its closing on.

    The closing is the entity's last row on or after ``since`` with status CLOSED whose
    previous row is OPEN (exact case).  The previous row's current-event values are added to
    the running totals of that row and of all later ones.  Rows without entity are dropped.
    ``one_row_per_date`` promises one row per slot, so that no entity can be hot.
    """
    rows = df.where(F.col(spec.entity).isNotNull())
    numbers = {f"_c{i}": to_long(rows, c) for i, c in enumerate(spec.current)}
    place = F.struct(F.col(spec.date).alias("at"), F.col(spec.order).alias("nth"))
    closing = F.when((F.col(spec.date) >= since) & (F.col(spec.status) == "CLOSED")
                     & (F.col("_prev").getField(spec.status) == "OPEN"), place)

    scanned = (by_entity(rows.withColumns(numbers), spec, fits=one_row_per_date)
               .with_previous([spec.status, *numbers])
               .with_facts({"_from": F.max(closing), "_event": F.max_by("_prev", closing)}))
    marked = scanned.done("_from", "_event")
    corrected = {}
    for i, running in enumerate(spec.running):
        total = null_safe_add(to_long(rows, running), F.col("_event").getField(f"_c{i}"))
        corrected[running] = (F.when((place >= F.col("_from")) & ~is_dirty(rows, running),
                                     like_column(rows, running, total))
                              .otherwise(F.col(f"`{running}`")))
    return replace_columns(marked, corrected).select(*[F.col(f"`{c}`") for c in df.columns])


def add_past_events(df: DataFrame, spec: PanelSpec = SHEET, *, skip_first_transition: bool = True,
                    one_row_per_date: bool = False) -> DataFrame:
    """Add the totals of an entity's earlier events to its running totals.

    Whenever an OPEN row follows a CLOSED one (any case), the closed row's running totals join
    a sum that is added to every row from there on; a result that is not positive becomes null.
    Where a closed row's total is text that is no number, that total's column is left alone from there on
    (``unreadable_closings`` lists such entities).
    ``skip_first_transition`` ignores an opening on the entity's second row.
    """
    rows, summed = _with_past_events(df, spec, skip_first_transition, one_row_per_date)
    corrected = {}
    for i, running in enumerate(spec.running):
        total = F.col(f"_sum_n{i}") + F.coalesce(F.col(f"_n{i}"), F.lit(0))
        corrects = (F.col("_events") > 0) & (F.col(f"_sum_t{i}") == 0) & ~is_dirty(rows, running)
        corrected[running] = (F.when(corrects, F.when(total > 0, like_column(rows, running, total)))
                              .otherwise(F.col(f"`{running}`")))
    return replace_columns(summed, corrected).select(*[F.col(f"`{c}`") for c in df.columns])


def unreadable_closings(df: DataFrame, spec: PanelSpec = SHEET, *, skip_first_transition: bool = True,
                        one_row_per_date: bool = False) -> DataFrame:
    """(state, entity, column): running totals that ``add_past_events`` can't carry on, as a closed one is text."""
    _, summed = _with_past_events(df, spec, skip_first_transition, one_row_per_date)
    told = F.array(*[F.when(F.col(f"_sum_t{i}") > 0, F.lit(c)) for i, c in enumerate(spec.running)])
    return (summed.select(*spec.entity_key, F.explode(told).alias("column"))
            .where("column IS NOT NULL").distinct())


def _with_past_events(df: DataFrame, spec: PanelSpec, skip_first_transition: bool, one_row_per_date: bool
                      ) -> tuple[DataFrame, DataFrame]:
    """The rows that have an entity, and the same with numbers (``_n0`` ...), events and closed totals so far."""
    rows = df.where(F.col(spec.entity).isNotNull())
    numbers = {f"_n{i}": to_long(rows, c) for i, c in enumerate(spec.running)}
    texts = {f"_t{i}": is_dirty(rows, c).cast("bigint") for i, c in enumerate(spec.running)}
    known = numbers | texts
    reopened = ((F.upper(F.col(spec.status)) == "OPEN")
                & (F.upper(F.col("_prev").getField(spec.status)) == "CLOSED"))
    if skip_first_transition:
        reopened = reopened & (F.col("_nth") > 2)
    reopened = F.coalesce(reopened, F.lit(False))

    added = {f"_add{n}": F.when(reopened, F.coalesce(F.col("_prev").getField(n), F.lit(0))).otherwise(0) for n in known}
    sums = {f"_sum{n}": F.col(f"_add{n}") for n in known} | {"_events": F.col("_reopened")}
    scanned = (by_entity(rows.withColumns(known), spec, fits=one_row_per_date)
               .with_previous([spec.status, *known])
               .with_columns(added | {"_reopened": reopened.cast("bigint")}).with_sums(sums))
    return rows, scanned.done(*sums)


def close_unknown(df: DataFrame, spec: PanelSpec = SHEET) -> DataFrame:
    """A missing status becomes 'Closed'; an empty one stays."""
    return df.na.fill("Closed", [spec.status])


def sum_outbreaks(df: DataFrame, spec: PanelSpec = SHEET, *, grid=None,
                  skip_first_transition: bool = True, one_row_per_date: bool = False) -> DataFrame:
    """Fill missing weeks, close unknown statuses, then add past events to the totals."""
    filled = close_unknown(fill_missing_dates(df, spec, grid=grid), spec)
    return add_past_events(filled, spec, skip_first_transition=skip_first_transition,
                           one_row_per_date=one_row_per_date)
