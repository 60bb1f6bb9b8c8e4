"""Data-quality checks.  Each returns a frame of findings; none changes the panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions.cells import any_of, fingerprint, text_to_double, to_long
from rollcall.functions.spread import attach, by_entity, dealt, row_salt
from rollcall.operators.standardize import standardize
from rollcall.spec import SHEET, PanelSpec

# Error texts of the duplicate report.
OPEN_ROWS_DIFFER = "Multiple open outbreak rows with different data"
OPEN_ROWS_SAME = "Duplicate open outbreak rows with same data"
SAME_DATA = "duplicate date data"

# Suppression text and the number it stands for.
SUPPRESSED = {
    "<11": 1, "1-4": 1, "< 5": 1, "43^": 44, "58 *": 58, "0 *": 0, "8 *": 8, "60 *": 60,
    "4 *": 4, "55 *": 55, "56 *": 56, "18 *": 18, "25 *": 25, "3 *": 3, "2 *": 2, "4*": 4,
    "0 ^": 0, "35 ^": 35, "6 *": 6, "≤5": 1, "Redacted (1-4 cases)": 1,
    "Redacted (1-4 deaths)": 1, " ": -1,
}

# A row with one of these in a running total is not compared.
NOT_COMPARABLE = (
    "#VALUE!", "Data Pending", "Not Reported", "Closed", "02/02/1900", "--", "-", ".", "*",
    "No Data", "No data", "No data ", "[;", "ND", "NO DATA", "NO DATA ",
    "COVID-19 Positive Residents",
)

# Date spellings accepted for the opening and closing date of an event, by their shape.
DATE_SHAPES = {
    r"^\d{4}-\d{2}-\d{2}$": "yyyy-MM-dd",
    r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$": "yyyy-MM-dd HH:mm:ss",
    r"^\d{8}$": "yyyyMMdd",
    r"^\d{1,2}/\d{1,2}/\d{4}$": "M/d/yyyy",
    r"^\d{1,2}/\d{1,2}/\d{2}$": "M/d/yy",
    r"^\d{1,2}-\d{1,2}-\d{4}$": "M-d-yyyy",
    r"^\d{4}/\d{1,2}/\d{1,2}$": "yyyy/M/d",
    r"^[A-Z][a-z]{3,} \d{1,2}, \d{4}$": "MMMM d, yyyy",
    r"^[A-Z][a-z]{2} \d{1,2}, \d{4}$": "MMM d, yyyy",
    r"^\d{1,2} [A-Z][a-z]{2} \d{4}$": "d MMM yyyy",
}

DECREASE_COLUMNS = (
    "State", "Facility", "cumulative_field_decreased", "Date", "current_cumulative_value",
    "Prev Date", "prev_cumulative_value", "CTP_Facility_Type", "ctp_id",
)

def _not_integer(df: DataFrame, name: str) -> Column:
    """Integer text or a finite number passes; so does null."""
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.StringType):
        return c.isNotNull() & ~c.rlike(r"^\s*[+-]?[0-9]+\s*$")
    return c.isNotNull() & to_long(df, name).isNull()


def _not_a_date(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    if not isinstance(df.schema[name].dataType, T.StringType):
        return F.lit(False)
    # a failed parse is slow, so a spelling is tried only on text of its shape
    parsed = F.lit(None).cast("timestamp")
    for shape, spelling in DATE_SHAPES.items():
        parsed = F.when(c.rlike(shape), F.try_to_timestamp(c, F.lit(spelling))).otherwise(parsed)
    return c.isNotNull() & parsed.isNull()


def check_data_types(df: DataFrame, spec: PanelSpec = SHEET, *, sheet: str | None = None) -> DataFrame:
    """Violations as (State, check, column, value, n): n rows hold the offending value.

    Checks: ``date`` (null, no integer or not 8 digits), ``event_date``, ``metric`` (no integer;
    null passes), ``status`` (neither open nor closed, any case; null passes, '' does not) and,
    when ``sheet`` names the column telling input sheets apart, ``state`` (a sheet with more
    than two states: one row for each of them, with its rows there).
    """
    bad_cells = []

    def finding(check: str, column: str, bad: Column) -> Column:
        bad_cells.append(F.coalesce(bad, F.lit(False)))
        return F.when(bad, F.struct(F.lit(check).alias("check"), F.lit(column).alias("column"),
                                    F.col(f"`{column}`").cast("string").alias("value")))

    date = to_long(df, spec.date)
    bad_date = F.coalesce(_not_integer(df, spec.date) | (F.length(date.cast("string")) != 8),
                          F.lit(True))
    status = F.upper(F.col(spec.status))
    found = [finding("date", spec.date, bad_date)]
    found += [finding("event_date", c, _not_a_date(df, c))
              for c in (spec.opened, spec.closed) if c in df.columns]
    found += [finding("metric", c, _not_integer(df, c)) for c in spec.metrics]
    found += [finding("status", spec.status, ~status.isin("OPEN", "CLOSED"))]
    violations = (df.where(any_of(bad_cells)).select(F.col(f"`{spec.state}`").alias("State"),
                            F.explode(F.array_compact(F.array(*found))).alias("f"))
                  .groupBy("State", "f.check", "f.column", "f.value")
                  .agg(F.count(F.lit(1)).alias("n")))
    if sheet is None:
        return violations
    pairs = df.groupBy(sheet, spec.state).agg(F.count(F.lit(1)).alias("n"))
    many = pairs.groupBy(sheet).agg(F.count(F.lit(1)).alias("_states")).where("_states > 2")
    mixed = pairs.join(many, sheet).select(
        F.col(spec.state).alias("State"), F.lit("state").alias("check"), F.lit(spec.state).alias("column"),
        F.col(sheet).cast("string").alias("value"), "n")
    return violations.unionByName(mixed)


def open_duplicates(df: DataFrame, spec: PanelSpec = SHEET) -> DataFrame:
    """Rows of (date, entity) slots with more than one OPEN row, each distinct row once."""
    content = [c for c in df.columns if c != spec.order]
    rows = df.where((F.col(spec.status) == "OPEN") & F.col(spec.date).isNotNull()
                    & F.col(spec.entity).isNotNull())
    whole = dealt(rows, spec.entity_key)
    kept = [F.min(spec.order).alias(spec.order)] if spec.order in df.columns else []
    # copies are combined before the shuffle
    distinct = (rows if whole is None else whole).groupBy(*[F.col(f"`{c}`") for c in content]).agg(
        F.count(F.lit(1)).alias("_copies"), *kept)
    error = F.when(F.col("_kinds") > 1, OPEN_ROWS_DIFFER).otherwise(OPEN_ROWS_SAME)
    if whole is not None:  # an entity's rows lie in one task
        slot = Window.partitionBy(*spec.slot_key)
        return (distinct.where(F.col(spec.state).isNotNull())
                .withColumns({"_open": F.sum("_copies").over(slot), "_kinds": F.count(F.lit(1)).over(slot)})
                .where("_open > 1").select(*[F.col(f"`{c}`") for c in df.columns], error.alias("error")))
    facts = distinct.groupBy(*spec.slot_key).agg(
        F.sum("_copies").alias("_open"), F.count(F.lit(1)).alias("_rows"),
        F.count(F.lit(1)).alias("_kinds")).where("_open > 1").drop("_open")
    return (attach(distinct, facts, spec.slot_key, count="_rows",
                   salt=fingerprint(content, "s"), how="inner")
            .select(*[F.col(f"`{c}`") for c in df.columns], error.alias("error")))


def same_data_on_date(df: DataFrame, spec: PanelSpec = SHEET) -> DataFrame:
    """Rows that share all their metrics with another row of the state and date.

    Nulls are equal to each other, so rows without any metric are duplicates too.
    """
    keys = [spec.state, spec.date, "_h1", "_h2"]
    hashed = df.where(F.col(spec.date).isNotNull()).withColumns(
        {"_h1": fingerprint(spec.metrics, "a"), "_h2": fingerprint(spec.metrics, "b")})
    facts = (hashed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
             .select(*keys, "_rows", F.lit(SAME_DATA).alias("error")))
    return (attach(hashed, facts, keys, count="_rows", salt=row_salt(df, spec), how="inner")
            .drop("_h1", "_h2"))


def quality_errors(df: DataFrame, spec: PanelSpec = SHEET, *, standardized: bool = False) -> DataFrame:
    """Standardize without entity lookup, then report both kinds of duplicates."""
    rows = df if standardized else standardize(df, spec)
    return open_duplicates(rows, spec).unionByName(same_data_on_date(rows, spec))


def comparable_totals(df: DataFrame, spec: PanelSpec = SHEET) -> DataFrame:
    """Running totals as text ready for comparison, without the rows that cannot be compared.

    Missing cells become -1, suppression text becomes the number it stands for.  RI totals
    read their first token, RI deaths and MA resident-and-staff cases are not compared.
    """
    meaning = F.create_map(*[F.lit(x) for k, v in SUPPRESSED.items() for x in (k, str(v))])
    cells = {}
    for c in spec.running:
        text = F.col(f"`{c}`").cast("string")
        if c == "Cume_Res_Pos":
            first = F.split(text, " ").getItem(0).try_cast("bigint").cast("string")
            text = F.when(F.col(spec.state) == "RI", first).otherwise(text)
        if c == "Cume_Res_Death":
            text = F.when(F.col(spec.state) == "RI", F.lit("-1")).otherwise(text)
        text = F.coalesce(text, F.lit("-1"))
        if c == "Cume_ResStaff_Pos":
            text = F.when(F.col(spec.state) == "MA", F.lit("-1")).otherwise(text)
        cells[c] = F.coalesce(F.try_element_at(meaning, text), text)
    rows = df.withColumns(cells)
    return rows.where(~any_of(F.col(f"`{c}`").isin(*NOT_COMPARABLE) for c in spec.running))


def falling_totals(df: DataFrame, spec: PanelSpec = SHEET, *, only_this_week: bool = False,
                   one_row_per_date: bool = False) -> DataFrame:
    """Running totals that are lower than in the entity's previous row.

    Both values must read as numbers (truncated) and the current one must not be missing.
    ``only_this_week`` keeps findings on the state's latest date.
    """
    rows = comparable_totals(df.where(F.col(spec.entity).isNotNull()), spec)
    numbers = {f"_v{i}": F.coalesce(F.col(f"`{c}`").try_cast("bigint"),
                                    text_to_double(F.col(f"`{c}`")).try_cast("bigint"))
               for i, c in enumerate(spec.running)}
    slim = rows.select(spec.state, spec.facility, spec.date, spec.facility_type, spec.entity,
                       spec.order, *[v.alias(n) for n, v in numbers.items()])

    before = by_entity(slim, spec, fits=one_row_per_date).with_previous([spec.date, *numbers]).done("_prev")
    falls, pairs = [], []
    for i, c in enumerate(spec.running):
        now, was = F.col(f"_v{i}"), F.col("_prev").getField(f"_v{i}")
        fell = F.coalesce((now != -1) & (now < was), F.lit(False))
        falls.append(fell)
        pairs.append(F.when(fell, F.struct(F.lit(c).alias("field"), now.alias("now"), was.alias("was"))))
    # few rows fall, so only those are unpivoted
    found = before.where(any_of(falls)).select(
        F.col(spec.state).alias("State"), F.col(spec.facility).alias("Facility"),
        F.explode(F.array_compact(F.array(*pairs))).alias("f"), F.col(spec.date).alias("Date"),
        F.col("_prev").getField(spec.date).alias("Prev Date"),
        F.col(spec.facility_type).alias("CTP_Facility_Type"), F.col(spec.entity).alias("ctp_id"))
    report = found.select(
        "State", "Facility", F.col("f.field").alias("cumulative_field_decreased"), "Date",
        F.col("f.now").alias("current_cumulative_value"), "Prev Date",
        F.col("f.was").alias("prev_cumulative_value"), "CTP_Facility_Type", "ctp_id")
    if only_this_week:
        latest = (rows.groupBy(F.col(spec.state).alias("State")).agg(F.max(spec.date).alias("Date"))
                  .select("Date", "State"))
        report = report.join(latest, ["State", "Date"], "left_semi")
    return report.select(*DECREASE_COLUMNS)
