"""Column roles of a panel.

Operators never address columns by position.  A :class:`PanelSpec` names the role of each
column, so the same operator runs on the 42-column facility sheet and on any other
(state, entity, date) table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Column names of the facility sheet, in sheet order.
# "Cume_ResStaff_ ProbDeath" has a blank inside its name.
DESCRIPTIVE_COLUMNS = (
    "Date", "State", "County", "City", "Facility", "State_Facility_Type",
    "CTP_Facility_Type", "Regulate", "State_ID", "CMS_ID", "Outbrk_Open",
    "Outbrk_Closed", "Outbrk_Status", "Res_Census",
)
CUMULATIVE_COLUMNS = (
    "Cume_Res_Pos", "Cume_Res_ProbPos", "Cume_Res_Death", "Cume_Res_ProbDeath",
    "Cume_Staff_Pos", "Cume_Staff_ProbPos", "Cume_Staff_Death", "Cume_Staff_ProbDeath",
    "Cume_ResStaff_Pos", "Cume_ResStaff_ProbPos", "Cume_ResStaff_Death",
    "Cume_ResStaff_ ProbDeath",
)
OUTBREAK_COLUMNS = (
    "Outbrk_Res_Pos", "Outbrk_Res_ProbPos", "Outbrk_Res_Death", "Outbrk_Res_ProbDeath",
    "Outbrk_Staff_Pos", "Outbrk_Staff_ProbPos", "Outbrk_Staff_Death",
    "Outbrk_Staff_ProbDeath", "Outbrk_ResStaff_Pos", "Outbrk_ResStaff_ProbPos",
    "Outbrk_ResStaff_Death", "Outbrk_ResStaff_ProbDeath",
)
TRAILING_COLUMNS = ("Res_Test", "Staff_Test", "PPE", "ctp_id")
SHEET_COLUMNS = DESCRIPTIVE_COLUMNS + CUMULATIVE_COLUMNS + OUTBREAK_COLUMNS + TRAILING_COLUMNS

# Columns other than the Outbrk_ ones that a filled-in week leaves empty.
POINT_IN_TIME_COLUMNS = ("Res_Census", "Res_Test", "Staff_Test", "PPE")


def positional_pairs(columns) -> tuple[tuple[str, str], ...]:
    """The pairs a sheet's layout implies: twelve totals after 14 columns, then their counterparts."""
    n, start = len(CUMULATIVE_COLUMNS), len(DESCRIPTIVE_COLUMNS)
    columns = list(columns)
    return tuple(zip(columns[start:start + n], columns[start + n:start + 2 * n]))


def text_schema(columns) -> T.StructType:
    """All-string landing schema: cells are typed by the operator that needs numbers."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


@dataclass(frozen=True)
class PanelSpec:
    """Names the role of each panel column.

    ``order`` is a BIGINT row ordinal.  It must be unique within one (state, entity, date)
    and rank the rows of an entity wherever "first row" matters; readers add it at ingest.
    ``pairs`` maps each running-total column to its current-event column.
    """

    state: str = "State"
    entity: str = "ctp_id"
    date: str = "Date"
    order: str = "_ord"
    status: str = "Outbrk_Status"
    facility: str = "Facility"
    county: str = "County"
    city: str = "City"
    state_type: str = "State_Facility_Type"
    facility_type: str = "CTP_Facility_Type"
    regulator: str = "Regulate"
    federal_id: str = "CMS_ID"
    opened: str = "Outbrk_Open"
    closed: str = "Outbrk_Closed"
    pairs: tuple[tuple[str, str], ...] = tuple(zip(CUMULATIVE_COLUMNS, OUTBREAK_COLUMNS))
    event_prefix: str = "Outbrk_"
    point_in_time: tuple[str, ...] = POINT_IN_TIME_COLUMNS

    @property
    def running(self) -> list[str]:
        """Running-total columns."""
        return [r for r, _ in self.pairs]

    @property
    def current(self) -> list[str]:
        """Current-event columns."""
        return [c for _, c in self.pairs]

    @property
    def metrics(self) -> list[str]:
        return self.running + self.current

    @property
    def entity_key(self) -> list[str]:
        return [self.state, self.entity]

    @property
    def slot_key(self) -> list[str]:
        """(state, entity, date); several rows may share one slot."""
        return [self.state, self.entity, self.date]

    def blank_on_fill(self, columns) -> list[str]:
        """Columns of ``columns`` that a filled-in week must not inherit."""
        return [c for c in columns if c.startswith(self.event_prefix) or c in self.point_in_time]

    def check_pairs(self, columns) -> None:
        """Fail early when a sheet lacks one of the paired metric columns."""
        missing = [c for c in self.metrics if c not in columns]
        if missing:
            raise ValueError(f"panel lacks metric columns {missing}")

    def check_layout(self, columns) -> None:
        """Fail when a sheet's metric columns are not where the pairs of this spec say."""
        if positional_pairs(columns) != self.pairs:
            raise ValueError("metric columns are not in sheet order")


SHEET = PanelSpec()
