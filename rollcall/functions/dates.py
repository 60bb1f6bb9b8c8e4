"""Dates are yyyymmdd integers on the API; grids are built from calendar dates."""

from __future__ import annotations

from datetime import datetime, timedelta

# First and last collection date of the weekly grid.
GRID_START = 20200521
GRID_END = 20210304
GRID_STEP_DAYS = 7


def date_grid(start: int = GRID_START, end: int = GRID_END, step_days: int = GRID_STEP_DAYS) -> list[int]:
    """yyyymmdd dates from ``start`` to ``end``, both included, ``step_days`` apart."""
    day, last = (datetime.strptime(str(d), "%Y%m%d") for d in (start, end))
    grid = []
    while day <= last:
        grid.append(int(day.strftime("%Y%m%d")))
        day += timedelta(days=step_days)
    return grid
