"""Final row order and the common last step of the state chains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators.carry import close_unknown
from rollcall.operators.densify import fill_missing_dates
from rollcall.spec import SHEET, PanelSpec


def output_order(spec: PanelSpec = SHEET) -> list:
    names = (spec.facility, spec.county, spec.city, spec.state_type, spec.entity, spec.date)
    return [F.col(c).asc_nulls_last() for c in names]


def sort_output(df: DataFrame, spec: PanelSpec = SHEET) -> DataFrame:
    """Total order: facility, county, city, state type, entity, date; nulls last."""
    return df.orderBy(*output_order(spec))


def finish(df: DataFrame, spec: PanelSpec = SHEET, *, grid=None, close_unknown_status: bool = False,
           ordered: bool = True) -> DataFrame:
    """Fill missing weeks, optionally close unknown statuses, sort.

    ``ordered=False`` skips the sort where the writer sorts each file itself.
    """
    out = fill_missing_dates(df, spec, grid=grid)
    if close_unknown_status:
        out = close_unknown(out, spec)
    return sort_output(out, spec) if ordered else out
