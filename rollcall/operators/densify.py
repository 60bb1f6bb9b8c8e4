"""Densification: weeks a state skipped, entities that stopped reporting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions.cells import replace_columns
from rollcall.functions.dates import date_grid
from rollcall.spec import SHEET, PanelSpec


def _join_state_facts(rows: DataFrame, facts: DataFrame, keys: list[str], spec: PanelSpec) -> DataFrame:
    """Left join with facts of states or of their dates.

    However many entities report, there are no more facts than states times dates, so they are sent to the rows,
    which are not shuffled and lie in no group.
    """
    joined = rows.join(F.broadcast(facts), keys, "left")
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], *[c for c in facts.columns if c not in keys])


def fill_missing_dates(df: DataFrame, spec: PanelSpec = SHEET, *, grid: Sequence[int] | None = None) -> DataFrame:
    """Give every state a row set for each grid date on or after its first report.

    A grid date without any row in the state repeats all rows of the state's latest earlier
    report date, minus current-event and point-in-time columns.  Filled weeks are never a
    source for later ones, and source dates need not lie on the grid.
    """
    grid = date_grid() if grid is None else list(grid)
    state, date = F.col(f"`{spec.state}`"), F.col(spec.date)
    by_date = Window.partitionBy(state).orderBy(date)
    reported = (df.where(date.isNotNull()).select(state, date).distinct()
                .withColumn("_next", F.lead(date).over(by_date)))
    weeks = F.expr(f"cast(array({', '.join(str(int(d)) for d in grid)}) as array<int>)")
    gap = F.filter(weeks, lambda g: (g > date) & (F.col("_next").isNull() | (g < F.col("_next"))))
    gaps = (reported.withColumn("_gap", gap).where(F.size("_gap") > 0)
            .select("_gap", state, date))
    kind = df.schema[spec.date].dataType.simpleString()
    dated = _join_state_facts(df, gaps, [spec.state, spec.date], spec)
    own = F.array(date)
    every = F.when(F.col("_gap").isNull(), own).otherwise(
        F.concat(own, F.col("_gap").cast(f"array<{kind}>")))
    spread = dated.select(*[F.col(f"`{c}`") for c in df.columns], F.explode(every).alias("_at"))
    is_own = F.col("_at").eqNullSafe(date)
    changed = {c: F.when(is_own, F.col(f"`{c}`")) for c in spec.blank_on_fill(df.columns)}
    changed[spec.date] = F.col("_at")
    return replace_columns(spread, changed).drop("_at")


def close_missing(df: DataFrame, spec: PanelSpec = SHEET, *, closed: str = "Closed") -> DataFrame:
    """Report entities on the state dates they skip after their first report.

    Each skipped date repeats the first row of the entity's last real report, with empty
    current-event metrics and status ``closed``.  ``last_recorded`` is the date of the real
    report.  Rows without a date are dropped.
    """
    rows = df.where(F.col(spec.date).isNotNull())
    # one row per state, holding its sorted report dates
    calendar = (rows.select(spec.state, spec.date).distinct()
                .groupBy(spec.state).agg(F.sort_array(F.collect_list(spec.date)).alias("_dates")))

    def with_calendar(table: DataFrame) -> DataFrame:
        return _join_state_facts(table, calendar, [spec.state], spec)

    firsts = (rows.where(F.col(spec.entity).isNotNull())
              .groupBy(*spec.slot_key).agg(F.min(spec.order).alias(spec.order)))
    placed = with_calendar(firsts).select(
        *spec.slot_key, spec.order, F.array_position("_dates", F.col(spec.date)).alias("_pos"),
        F.size("_dates").alias("_count"))
    by_date = Window.partitionBy(*spec.entity_key).orderBy(spec.date)
    skipped = placed.withColumn(
        "_skipped", F.coalesce(F.lead("_pos").over(by_date) - 1, F.col("_count")) - F.col("_pos"))
    gaps = (with_calendar(skipped.where("_skipped > 0"))
            .select(*spec.slot_key, spec.order,
                    F.slice("_dates", (F.col("_pos") + 1).cast("int"),
                            F.col("_skipped").cast("int")).alias("_gap")))
    # the ordinal is unique in its slot, so this key has no hot value
    dated = rows.join(gaps, [*spec.slot_key, spec.order], "left")
    own = F.array(spec.date)
    every = F.when(F.col("_gap").isNull(), own).otherwise(F.concat(own, F.col("_gap")))
    spread = dated.select(*[F.col(f"`{c}`") for c in rows.columns if c != "last_recorded"],
                          F.col(spec.date).alias("last_recorded"), F.explode(every).alias("_at"))
    is_own = F.col("_at") == F.col("last_recorded")
    changed = {c: F.when(is_own, F.col(f"`{c}`")) for c in spec.current if c in rows.columns}
    changed[spec.status] = F.when(is_own, F.col(spec.status)).otherwise(closed)
    changed[spec.date] = F.col("_at")
    return replace_columns(spread, changed).drop("_at")
