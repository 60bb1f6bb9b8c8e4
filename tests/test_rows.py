"""Row rules, text rules and lookups on hand-made rows."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from panels import PAIRS, bag, bag_of
from rollcall.functions.cells import fingerprint, sum_skipping_nulls, to_long
from rollcall.functions.dates import date_grid
from rollcall.operators import (carry, densify, entity, markers, ordering, quality, reconcile,
                                standardize, statewise)
from rollcall.spec import (CUMULATIVE_COLUMNS, OUTBREAK_COLUMNS, SHEET, SHEET_COLUMNS, PanelSpec,
                           text_schema)

SPEC = PanelSpec(pairs=PAIRS)


def sheet(spark, *rows, columns=SHEET_COLUMNS):
    """Full-width sheet rows from the few cells given; rows are numbered."""
    data = [tuple(r.get(c) for c in columns) for r in rows]
    df = spark.createDataFrame(data, text_schema(columns)).coalesce(1)
    return df.withColumn("_ord", F.monotonically_increasing_id())


def cells(df, *names):
    return [tuple(r) for r in df.select(*[F.col(f"`{n}`") for n in names]).collect()]


def home(n, date, **more):
    return {"Date": str(date), "State": "XX", "Facility": f"home-{n}", "ctp_id": str(n),
            "Outbrk_Status": "Open", "Cume_Res_Pos": "18", "CMS_ID": " ", **more}


def test_sheet_layout():
    assert len(SHEET_COLUMNS) == 42
    assert [SHEET_COLUMNS.index(c) for c in CUMULATIVE_COLUMNS] == list(range(14, 26))
    assert [SHEET_COLUMNS.index(c) for c in OUTBREAK_COLUMNS] == list(range(26, 38))
    assert all(o == r.replace("Cume", "Outbrk").replace(" ", "") for r, o in SHEET.pairs)
    SHEET.check_layout(SHEET_COLUMNS)
    with pytest.raises(ValueError, match="sheet order"):
        SHEET.check_layout(SHEET_COLUMNS[::-1])
    with pytest.raises(ValueError, match="Outbrk_Res_Pos"):
        SHEET.check_pairs([c for c in SHEET_COLUMNS if c != "Outbrk_Res_Pos"])


def test_grid():
    grid = date_grid()
    assert (len(grid), grid[0], grid[-1]) == (42, 20200521, 20210304)


def test_closing_with_text_dates(spark):
    rows = [home(1, "first"), home(2, "first"), home(1, "second"), home(3, "second"),
            home(2, "third", Cume_Res_Pos="100")]
    got = densify.close_missing(sheet(spark, *rows))
    assert sorted(cells(got, "Date", "ctp_id", "Outbrk_Status", "Cume_Res_Pos", "last_recorded")) == [
        ("first", "1", "Open", "18", "first"), ("first", "2", "Open", "18", "first"),
        ("second", "1", "Open", "18", "second"), ("second", "2", "Closed", "18", "first"),
        ("second", "3", "Open", "18", "second"), ("third", "1", "Closed", "18", "second"),
        ("third", "2", "Open", "100", "third"), ("third", "3", "Closed", "18", "second")]
    assert got.columns == [*SHEET_COLUMNS, "_ord", "last_recorded"]
    assert set(cells(got, "CMS_ID")) == {(" ",)}


def test_filled_weeks_take_off_grid_sources_and_run_to_the_end(spark):
    dates = [20200604, 20200611, 20200617, 20200625, 20200625]
    df = sheet(spark, *[home(1, d, Cume_Res_Pos=str(i), Outbrk_Open="2020-01-01", Res_Census="9", PPE="Y")
                        for i, d in enumerate(dates)])
    df = standardize.integer_dates(df)
    got = densify.fill_missing_dates(df, grid=date_grid(20200521, 20200709))
    assert sorted(cells(got, "Date", "Cume_Res_Pos", "Outbrk_Status", "Outbrk_Open", "Res_Census", "PPE"), key=str) == [
        (20200604, "0", "Open", "2020-01-01", "9", "Y"), (20200611, "1", "Open", "2020-01-01", "9", "Y"),
        (20200617, "2", "Open", "2020-01-01", "9", "Y"), (20200618, "2", None, None, None, None),
        (20200625, "3", "Open", "2020-01-01", "9", "Y"), (20200625, "4", "Open", "2020-01-01", "9", "Y"),
        (20200702, "3", None, None, None, None), (20200702, "4", None, None, None, None),
        (20200709, "3", None, None, None, None), (20200709, "4", None, None, None, None)]


def test_state_column_may_have_another_name(spark):
    columns = tuple("State " if c == "State" else c for c in SHEET_COLUMNS)
    df = sheet(spark, {**home(1, 20200604), "State ": "XX"}, columns=columns)
    got = densify.fill_missing_dates(standardize.integer_dates(df), replace(SHEET, state="State "))
    assert got.count() == 40


def test_markers_chain_and_first_dates(spark):
    rows = [home(1, 1, Cume_Res_Pos="5"), home(1, 2, Cume_Res_Pos="NO DATA"), home(1, 3, Cume_Res_Pos="Nd"),
            home(2, 2, Cume_Res_Pos="NO DATA", Res_Census="NO DATA"), home(3, 1, Cume_Res_Pos=None),
            home(3, 2, Cume_Res_Pos="closed"), home(4, 1, Cume_Res_Pos="Redacted (1-4 cases)")]
    got = markers.replace_no_data(sheet(spark, *rows))
    assert sorted(cells(got, "ctp_id", "Date", "Cume_Res_Pos", "Res_Census"), key=str) == [
        ("1", "1", "5", None), ("1", "2", "5", None), ("1", "3", "5", None), ("2", "2", None, "NO DATA"),
        ("3", "1", None, None), ("3", "2", None, None), ("4", "1", "redacted (1-4 cases)", None)]


def test_text_rules(spark):
    df = sheet(spark, {"Date": "20210101", "State": " ga ", "County": "de  kalb\t", "City": "St§one   Mtn",
                       "Facility": "A‐B\nͲC", "Outbrk_Status": "closed"},
               {"Date": "20210101", "Facility": None}, {"Date": None, "Facility": "X"})
    out = standardize.standardize(df)
    assert cells(out, "Date", "State", "County", "City", "Facility", "Outbrk_Status", "State_Facility_Type") == [
        (20210101, "GA", "DE KALB", "STONE MTN", "A-B -C", "CLOSED", "")]


def test_dates_must_be_numbers(spark):
    df = sheet(spark, home(1, "20210101.0"), home(2, "soon"))
    assert cells(standardize.unreadable_dates(df), "ctp_id") == [("2",)]
    assert cells(standardize.integer_dates(df.where("ctp_id = 1")), "Date") == [(20210101,)]
    with pytest.raises(Exception, match="not a date number: soon"):
        standardize.integer_dates(df).collect()


def registry(spark, *rows):
    names = [*entity.REGISTRY_COLUMNS, "_ord"]
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)],
                                 ", ".join(f"{n} {'long' if n == '_ord' else 'string'}" for n in names))


def test_entity_lookup(spark, groups):
    reg = registry(spark, ("Home", "c", "k", "XX", "NH", "XX", "old"), ("HOME", "C", "K", "xx", "nh", "XX", "new"),
                   ("Else", "", "", "XX", "", "YY", "far"), ("Blank", "", "", "XX", "", "XX", ""))
    known = {"Date": "1", "State": "XX", "Facility": "HOME", "City": "C", "County": "K", "CTP_Facility_Type": "NH"}
    df = sheet(spark, known, known, known)
    out = entity.add_entity_id(df, reg)
    assert cells(out, "ctp_id") == [("new",)] * 3 and out.columns == df.columns
    for name in ("ELSE", "BLANK", "NOWHERE"):
        lost = sheet(spark, {"State": "XX", "Facility": name, "City": "", "County": "", "CTP_Facility_Type": ""})
        with pytest.raises(Exception, match=f"no entity id for: {name}"):
            entity.add_entity_id(lost, reg).collect()
        assert cells(entity.unmatched_entities(lost, reg), "Facility", "rows") == [(name, 1)]


def test_county_rules(spark):
    names = ["JEFFERSON COUNTY", "BULLIT", "BULLITT", "SHLEBY", "WOODFOORD"]
    df = sheet(spark, *[{"County": n} for n in names])
    assert [c for c, in cells(statewise.clean_counties_ky(df), "County")] == [
        "JEFFERSON", "BULLITT", "BULLITTT", "SHELBY", "WOODFORD"]
    assert [c for c, in cells(statewise.clean_counties_ky(df, whole_word=True), "County")] == [
        "JEFFERSON", "BULLITT", "BULLITT", "SHELBY", "WOODFORD"]
    names = ["TOTALS", "UNKNOWN", "DADE", "MIAMIͲDADE", "POLK", None]
    df = sheet(spark, *[{"County": n} for n in names])
    assert [c for c, in cells(statewise.clean_counties_fl(df), "County")] == [
        "", "MIAMI-DADE", "MIAMI-DADE", "POLK", None]


def test_type_rules(spark):
    df = sheet(spark, *[{"State_Facility_Type": t, "CMS_ID": "1"} for t in ("ALF", "NH", "ICF", "", None)])
    out = statewise.clear_federal_ids(statewise.common_types(df))
    assert cells(out, "CTP_Facility_Type", "Regulate", "CMS_ID") == [
        ("Assisted Living", "State", None), ("Nursing Home", "Federal", "1"), ("Other", "State", None),
        (None, None, None), (None, None, None)]


def test_status_and_empty_rows(spark):
    df = sheet(spark, {"Outbrk_Res_Pos": "0"}, {"Outbrk_Staff_Pos": "1"}, {"Cume_Res_Pos": "1", "Outbrk_Status": "OPEN"})
    out = statewise.status_from_counts(df)
    assert cells(out, "Outbrk_Status") == [("OPEN",), ("OPEN",), (None,)]
    assert statewise.drop_empty_content(out).count() == 2
    assert statewise.drop_empty_metrics(sheet(spark, {"State": "MN"}, {"Outbrk_ResStaff_ProbDeath": "1"})).count() == 1


def test_unknown_status_and_order(spark):
    df = sheet(spark, home(2, 20210304, Outbrk_Status=None), home(1, 20210304, Outbrk_Status=""),
               {**home(3, 20210304), "Facility": None})
    out = ordering.finish(standardize.integer_dates(df), close_unknown_status=True)
    assert cells(out, "Facility", "Outbrk_Status") == [("home-1", ""), ("home-2", "Closed"), (None, "Open")]


def test_carry_is_case_sensitive(spark):
    rows = [home(1, 20210204, Outbrk_Status="OPEN", Outbrk_Res_Pos="4"),
            home(1, 20210211, Outbrk_Status="Closed"), home(1, 20210218, Outbrk_Status="CLOSED")]
    df = standardize.integer_dates(sheet(spark, *rows))
    assert bag_of(carry.carry_closed_event(df), ["Cume_Res_Pos"]) == bag([{"x": "18"}] * 3, ["x"])
    df = df.where("Date <> 20210211")
    assert sorted(cells(carry.carry_closed_event(df), "Cume_Res_Pos")) == [("18",), ("22",)]


def test_type_checks(spark):
    df = sheet(spark, home(1, 20210101, Outbrk_Open="soon", Outbrk_Closed="1/2/2021", Cume_Res_Pos="3.7"),
               home(2, 2021, Outbrk_Status="", Cume_Res_Pos="+3"), home(3, "x", Outbrk_Status=None, Cume_Res_Pos=" 4 "),
               {**home(4, 20210101), "Date": None, "Outbrk_Closed": "13/45/2020"})
    got = quality.check_data_types(df)
    assert sorted(cells(got, "check", "column", "value", "n"), key=str) == [
        ("date", "Date", "2021", 1), ("date", "Date", "x", 1), ("date", "Date", None, 1),
        ("event_date", "Outbrk_Closed", "13/45/2020", 1), ("event_date", "Outbrk_Open", "soon", 1),
        ("metric", "Cume_Res_Pos", "3.7", 1), ("status", "Outbrk_Status", "", 1)]
    typed = df.where("ctp_id = 1").withColumn("Cume_Res_Pos", F.lit(3.7))
    assert typed.transform(quality.check_data_types).where("check = 'metric'").count() == 0


def test_sheets_of_many_states(spark):
    df = sheet(spark, *[{**home(1, 20210101), "State": s, "PPE": p}
                        for s, p in (("A", "1"), ("B", "1"), (None, "1"), ("A", "2"), ("B", "2"))])
    got = quality.check_data_types(df.where("PPE = 2").unionByName(df.where("PPE = 1 and State is not null")), sheet="PPE")
    assert got.where("check = 'state'").count() == 0
    three = sheet(spark, *[{**home(1, 20210101), "State": s, "PPE": "1"} for s in "ABCA"])
    assert cells(quality.check_data_types(three, sheet="PPE").where("check = 'state'"), "State", "value", "n") \
        == [("A", "1", 2), ("B", "1", 1), ("C", "1", 1)]


def test_suppressed_totals(spark):
    rows = [home(1, 20210101, Cume_Res_Pos="43^", Cume_ResStaff_Pos="9"), home(1, 20210108, Cume_Res_Pos="43"),
            home(1, 20210115, Cume_Res_Pos="-"), home(1, 20210122, Cume_Res_Pos="≤5"), home(1, 20210129, Cume_Res_Pos=None),
            home(1, 20210205, Cume_Res_Pos="0 *")]
    df = standardize.integer_dates(sheet(spark, *rows))
    got = quality.falling_totals(df)
    assert sorted(cells(got, "Date", "current_cumulative_value", "Prev Date", "prev_cumulative_value")) == [
        (20210108, 43, 20210101, 44), (20210122, 1, 20210108, 43)]
    assert cells(quality.falling_totals(df, only_this_week=True), "Date") == []


def test_quality_errors(spark):
    same = dict(Outbrk_Status="open", Cume_Res_Pos="1")
    df = sheet(spark, home(1, 20210101, **same), home(1, 20210101, **same), home(1, 20210101, Outbrk_Status="Open", PPE="x"),
               home(2, 20210101, **same))
    got = quality.quality_errors(df)
    assert sorted(cells(got, "ctp_id", "PPE", "error"), key=str) == sorted([
        ("1", None, quality.OPEN_ROWS_DIFFER), ("1", "x", quality.OPEN_ROWS_DIFFER),
        ("1", None, quality.SAME_DATA), ("2", None, quality.SAME_DATA)], key=str)


def test_numbers_and_fingerprints(spark):
    df = spark.createDataFrame([("3.7",), (" 12 ",), ("9007199254740993",), ("1e3",), ("12d",), ("NaN",), ("<11",), (None,)], "c string")
    assert [r[0] for r in df.select(to_long(df, "c")).collect()] == [3, 12, 9007199254740993, 1000, None, None, None, None]
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", None)], "x string, y string")
    one, two, three = [r[0] for r in df.select(fingerprint(["x", "y"], "s")).collect()]
    assert one == three != two


def test_federal_table(spark):
    raw = spark.createDataFrame(
        [("01/31/2021", "015009", "Home", "AL", 1.0, None), ("05/24/2020", "1", "Early", "AL", 1.0, 1.0),
         ("02/07/21", "45.0", None, "AK", None, None), (None, "3", None, "AK", None, None)],
        "`Week Ending` string, ` Federal Provider Number` string, `Provider Name ` string, `Provider-State` string, `A/B` double, C double")
    got = reconcile.prepare_federal(raw, columns=("cms_week", "cms_federal_provider_number", "cms_provider_state", "cms_a_b", "cms_c"),
                                    totals={"cms_total": ("cms_a_b", "cms_c")})
    assert sorted(cells(got, "cms_week", "cms_federal_provider_number", "cms_total")) == [
        ("2021-01-31", "15009", 1.0), ("2021-02-07", "45", 0.0)]


def test_week_spellings(spark):
    df = spark.createDataFrame([("2021-01-31",), ("2021-01-31 00:00:00",), ("1/31/2021",), ("01/31/21",),
                                ("01/31/2021 12:00:00 AM",), (None,)], "w string")
    assert [r[0] for r in df.select(reconcile.iso_week(F.col("w"))).collect()] == ["2021-01-31"] * 5 + [None]
    with pytest.raises(Exception, match="no week-ending date: 31 Jan"):
        spark.createDataFrame([("31 Jan",)], "w string").select(reconcile.iso_week(F.col("w"))).collect()


def test_reconciliation(spark):
    fed = spark.createDataFrame([("w2", "1", "AR", "h1", 5.0), ("w2", "2", "AR", "h2", 9.0), ("w1", "1", "AR", "h1", None)],
                                "cms_week string, cms_federal_provider_number string, cms_provider_state string, cms_provider_name string, d double")
    nat = spark.createDataFrame([("w2", "1", "AR", "H1", 3.0), (None, "1", "AR", "H0", 1.0), ("w2", None, "AR", "H9", 2.0),
                                 ("w1", "7", "CT", "H7", 4.0)],
                                "ctp_cms_week string, ctp_cms_id string, ctp_state string, ctp_facility string, e double")
    inner = reconcile.add_differences(reconcile.match_both(fed, nat), {"x_diff": ("d", "e")})
    assert cells(inner, "cms_provider_name", "x_diff", "x_diff_abs") == [("h1", 2.0, 2.0)]
    outer = reconcile.match_outer(fed, nat)
    assert sorted(cells(outer, "cms_week", "cms_provider_name", "ctp_facility"), key=str) == sorted([
        ("w2", "h1", "H1"), ("w2", "h2", None), ("w1", "h1", None), (None, None, "H0"), (None, None, "H9"),
        (None, None, "H7")], key=str)
    alone = reconcile.unmatched_federal(outer)
    assert cells(reconcile.top_unmatched(alone, "d", ["cms_week"], n=1), "cms_provider_name", "rank") == [("h2", 1)]
    assert reconcile.latest_week(inner).first()[0] == "w2"
    assert sorted(cells(reconcile.at_latest_week(outer, inner, "cms_week", "ctp_cms_week"), "ctp_facility"), key=str) == [
        ("H1",), ("H9",), (None,)]
    assert cells(reconcile.unique_ids(nat, ["ctp_cms_week"]), "ctp_facility") in (
        [("H0",), ("H7",)], [("H7",), ("H0",)])
    assert sorted(cells(reconcile.unique_ids(nat.unionByName(nat.where("ctp_cms_week is null")), ["ctp_cms_week"]), "ctp_facility")) == [("H7",)]
    counts = reconcile.distinct_counts(outer, {"a": ("ctp_state", F.col("e") > 0), "none": ("ctp_state", F.col("e") > 99)})
    assert sorted(cells(counts, "measure", "n")) == [("a", 2), ("none", 0)]
    assert cells(reconcile.value_counts(outer, "cms_week"), "cms_week", "rows") == [("w2", 2), ("w1", 1)]


def test_sums_of_nothing_are_zero(spark):
    df = spark.createDataFrame([(None, None), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(sum_skipping_nulls(["a", "b"])).collect()] == [0.0, 1.0]
