"""Column and row rules of single states."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.cells import replace_columns
from rollcall.spec import SHEET, PanelSpec

# County labels of subtotal rows, and spellings of one county.
SUBTOTAL_COUNTIES = ("TOTAL ICF", "TOTAL ALF", "TOTALS")
UNKNOWN_COUNTIES = ("UNKNOWN", "UNKNOWN COUNTY")
DADE_SPELLINGS = ("DADE", "MIAMI-DADE", "MIAMIͲDADE", "MIAMI‐DADE")
DADE = "MIAMI-DADE"

# Ordered substring replacements in county names.
COUNTY_REPLACEMENTS = (
    (" COUNTY", ""),
    ("BULLIT", "BULLITT"),
    ("SHLEBY", "SHELBY"),
    ("WOODFOORD", "WOODFORD"),
)

# A row that is empty in all of these says nothing.
FL_CONTENT = (
    "Outbrk_Status", "Res_Census", "Cume_Res_Death", "Cume_Staff_Death", "Cume_ResStaff_Death",
    "Cume_ResStaff_ ProbDeath", "Outbrk_Res_Pos", "Outbrk_Staff_Pos",
)

# State facility type -> (common facility type, regulator).
FL_TYPES = {
    "ALF": ("Assisted Living", "State"),
    "Assisted Living": ("Assisted Living", "State"),
    "NH": ("Nursing Home", "Federal"),
    "ICF": ("Other", "State"),
}


def drop_empty_metrics(df: DataFrame, spec: PanelSpec = SHEET) -> DataFrame:
    """Drop rows in which every metric is null."""
    return df.na.drop(how="all", subset=spec.metrics)


def drop_empty_content(df: DataFrame, columns=FL_CONTENT) -> DataFrame:
    """Drop rows in which all of ``columns`` are null."""
    return df.na.drop(how="all", subset=list(columns))


def clean_counties_fl(df: DataFrame, spec: PanelSpec = SHEET) -> DataFrame:
    """Drop subtotal rows, empty unknown counties, unify the spellings of Miami-Dade."""
    county = F.col(spec.county)
    rows = df.where(~F.coalesce(county.isin(*SUBTOTAL_COUNTIES), F.lit(False)))
    return replace_columns(rows, {spec.county: F.when(county.isin(*UNKNOWN_COUNTIES), "")
                                  .when(county.isin(*DADE_SPELLINGS), DADE).otherwise(county)})


def clean_counties_ky(df: DataFrame, spec: PanelSpec = SHEET, *, whole_word: bool = False) -> DataFrame:
    """Drop the word COUNTY and fix misspelt names.

    Replacements are literal, so BULLITT becomes BULLITTT; ``whole_word`` avoids that.
    """
    county = F.col(spec.county)
    for wrong, right in COUNTY_REPLACEMENTS:
        if whole_word:
            county = F.regexp_replace(county, wrong + r"\b", right)
        else:
            county = F.replace(county, F.lit(wrong), F.lit(right))
    return replace_columns(df, {spec.county: county})


def status_from_counts(df: DataFrame, spec: PanelSpec = SHEET,
                       counts=("Outbrk_Res_Pos", "Outbrk_Staff_Pos")) -> DataFrame:
    """OPEN where one of the current counts is present, else null."""
    reported = F.coalesce(*[F.col(c).cast("string") for c in counts]).isNotNull()
    return replace_columns(df, {spec.status: F.when(reported, "OPEN")})


def common_types(df: DataFrame, spec: PanelSpec = SHEET, *, types=FL_TYPES) -> DataFrame:
    """Common facility type and regulator from the state's own type; null where unknown."""
    kind = regulator = F.lit(None).cast("string")
    for state_type, (common, by) in types.items():
        match = F.col(spec.state_type) == state_type
        kind = F.when(match, common).otherwise(kind)
        regulator = F.when(match, by).otherwise(regulator)
    return replace_columns(df, {spec.facility_type: kind, spec.regulator: regulator})


def clear_federal_ids(df: DataFrame, spec: PanelSpec = SHEET, *, home: str = "NH") -> DataFrame:
    """Only rows of type ``home`` keep their federal id."""
    return replace_columns(df, {
        spec.federal_id: F.when(F.col(spec.state_type) == home, F.col(spec.federal_id))})


def since(df: DataFrame, first_date: int, spec: PanelSpec = SHEET) -> DataFrame:
    """Rows dated ``first_date`` or later."""
    return df.where(F.col(spec.date) >= first_date)
