"""Several event rows of one entity and date become one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.cells import any_of, fingerprint, is_dirty, like_column, replace_columns, to_long
from rollcall.functions.spread import add_slot_facts
from rollcall.spec import SHEET, PanelSpec

# Facility types that the restricted collapse looks at.
RESTRICTED_TYPES = ("RESIDENTIAL CARE", "RCFE")


def _hashes(df: DataFrame, spec: PanelSpec, which: Column) -> dict[str, Column]:
    """Aggregates telling whether the rows selected by ``which`` are all alike."""
    content = [c for c in df.columns if c != spec.order]
    out = {}
    for seed in ("a", "b"):  # two independent hashes
        h = F.when(which, fingerprint(content, seed))
        out |= {f"_low_{seed}": F.min(h), f"_high_{seed}": F.max(h)}
    return out


def _rows_differ() -> Column:
    return F.coalesce((F.col("_low_a") != F.col("_high_a")) | (F.col("_low_b") != F.col("_high_b")),
                      F.lit(False))


def collapse_adding(df: DataFrame, spec: PanelSpec = SHEET, *, add_current: bool = True) -> DataFrame:
    """One row per (date, entity), its running totals summed over all event rows.

    The row kept is the OPEN one, or the first when none is open.  Each running total becomes
    the sum over the rows plus, with ``add_current``, the kept row's current-event value, when
    that is positive.  A slot with several different OPEN rows, or with a needed cell that is
    no number, is left as it is.  Rows without date or entity are dropped.
    """
    spec.check_pairs(df.columns)
    rows = df.where(F.col(spec.date).isNotNull() & F.col(spec.entity).isNotNull())
    is_open = F.coalesce(F.col(spec.status) == "OPEN", F.lit(False))
    open_order = F.when(is_open, F.col(spec.order))
    current_dirty = any_of(is_dirty(rows, c) for c in spec.current)
    facts = {"_first_open": F.min(open_order), "_first": F.min(spec.order),
             "_dirty": F.max(any_of(is_dirty(rows, c) for c in spec.running)),
             "_open_dirty": F.min_by(current_dirty, open_order),
             "_first_dirty": F.min_by(current_dirty, spec.order),
             **_hashes(rows, spec, is_open)}
    for i, c in enumerate(spec.running):
        facts[f"_sum{i}"] = F.sum(F.coalesce(to_long(rows, c), F.lit(0)))
    told = add_slot_facts(rows, spec, facts).withColumns({
        "_as_is": F.col("_dirty") | _rows_differ() | F.coalesce("_open_dirty", "_first_dirty"),
        "_kept": F.coalesce("_first_open", "_first")})
    kept = told.where(F.col("_as_is") | (F.col("_kept") == F.col(spec.order)))
    totals = {}
    for i, (running, current) in enumerate(spec.pairs):
        total = F.col(f"_sum{i}")
        if add_current:
            total = total + F.coalesce(to_long(rows, current), F.lit(0))
        totals[running] = F.when(~F.col("_as_is") & (total > 0),
                                 like_column(rows, running, total)).otherwise(F.col(f"`{running}`"))
    return replace_columns(kept, totals).select(*[F.col(f"`{c}`") for c in df.columns])


def collapse_diagnostics(df: DataFrame, spec: PanelSpec = SHEET) -> DataFrame:
    """Slots with more than one OPEN row: who they are, and whether the rows differ.

    One row per slot, describing column (facility, state type, county) and value in it, with
    ``rows`` (OPEN rows of the slot that hold the value); missing values are not listed.
    """
    is_open = F.col(spec.status) == "OPEN"
    named = [c for c in (spec.facility, spec.state_type, spec.county) if c in df.columns]
    told = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in named]
    rows = df.where(is_open)
    slots = (rows.groupBy(*spec.slot_key).agg(
        F.count(F.lit(1)).alias("open_rows"),
        *[h.alias(n) for n, h in _hashes(df, spec, is_open).items()])
        .where("open_rows > 1").withColumn("rows_differ", _rows_differ())
        .drop("_low_a", "_high_a", "_low_b", "_high_b"))
    # equal labels of a slot are combined before they meet it
    labels = (rows.select(*spec.slot_key, F.explode(F.array(*told)).alias("l"))
              .where("l.value is not null").groupBy(*spec.slot_key, "l.column", "l.value")
              .agg(F.count(F.lit(1)).alias("rows")))
    return slots.join(labels, spec.slot_key).select(
        *spec.slot_key, "open_rows", "rows_differ", "column", "value", "rows")


def collapse_without_adding(df: DataFrame, spec: PanelSpec = SHEET, *,
                            restrict_types: bool = False, types=RESTRICTED_TYPES) -> DataFrame:
    """Merge slots of exactly two rows, moving running totals instead of adding them.

    Two equal rows become one.  One OPEN row and one other become the OPEN row carrying the
    other's running totals, empty ones included.  Every other slot is left as it is; with
    ``restrict_types`` so is a slot whose first row is of no listed state type.
    """
    spec.check_pairs(df.columns)
    rows = df.where(F.col(spec.date).isNotNull() & F.col(spec.entity).isNotNull())
    is_open = F.coalesce(F.col(spec.status) == "OPEN", F.lit(False))
    listed = F.coalesce(F.upper(F.col(spec.state_type)).isin(*types), F.lit(False)) \
        if restrict_types else F.lit(True)
    moved = F.struct(*[F.col(f"`{c}`").alias(f"m{i}") for i, c in enumerate(spec.running)])
    told = add_slot_facts(rows, spec, {
        "_size": F.count(F.lit(1)), "_first": F.min(spec.order),
        "_open": F.sum(is_open.cast("int")),
        "_open_order": F.min(F.when(is_open, F.col(spec.order))),
        "_listed": F.min_by(listed, spec.order),
        "_moved": F.min_by(moved, F.when(~is_open, F.col(spec.order))),
        **_hashes(rows, spec, F.lit(True))})
    told = told.withColumn("_action", (
        F.when((F.col("_size") != 2) | ~F.col("_listed"), "as is")
        .when(~_rows_differ(), "one of two")
        .when(F.col("_open") == 1, "merge").otherwise("as is")))
    kept = told.where(
        (F.col("_action") == "as is")
        | ((F.col("_action") == "one of two") & (F.col(spec.order) == F.col("_first")))
        | ((F.col("_action") == "merge") & (F.col(spec.order) == F.col("_open_order"))))
    merged = {c: F.when(F.col("_action") == "merge", F.col("_moved").getField(f"m{i}"))
              .otherwise(F.col(f"`{c}`")) for i, c in enumerate(spec.running)}
    return replace_columns(kept, merged).select(*[F.col(f"`{c}`") for c in df.columns])
