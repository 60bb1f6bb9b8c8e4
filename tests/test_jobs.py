"""Files in, files out, whole chains, lineage."""

import csv
import os

import pytest
from pyspark.sql import functions as F

from panels import bag, bag_of
from rollcall.functions import lineage
from rollcall.plans import chains, jobs
from rollcall.sources import sheets, sinks
from rollcall.spec import SHEET_COLUMNS


def write_sheet(path, rows, columns=SHEET_COLUMNS, cut=0):
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(columns)
        for r in rows:
            line = [r.get(c, "") for c in columns]
            out.writerow(line[:len(line) - cut] if cut else line)
    return str(path)


def report(n, date, state="AR", **more):
    return {"Date": date, "State": state, "Facility": f"Home  {n}", "City": "C", "County": "K",
            "CTP_Facility_Type": "NH", "Outbrk_Status": "Open", "Cume_Res_Pos": 10 + n, "ctp_id": n, **more}


def test_reading_sheets(spark, tmp_path):
    rows = [report(1, 20210107, Facility="two\nlines", CMS_ID=" ", City="say \"hi\", you", County="N/A"),
            report(2, 20210107)]
    df = sheets.read_sheets(spark, write_sheet(tmp_path / "a.csv", rows))
    first, second = df.orderBy("_ord").collect()
    assert (first["Facility"], first["CMS_ID"], first["City"], first["County"]) == ("two\nlines", " ", 'say "hi", you', None)
    assert second["_ord"] > first["_ord"] and df.columns == [*SHEET_COLUMNS, "_ord"]
    assert {t for c, t in df.dtypes if c != "_ord"} == {"string"}
    short = sheets.read_sheets(spark, write_sheet(tmp_path / "b.csv", rows[1:], cut=1)).first()
    assert short["ctp_id"] is None and short["Facility"] == "Home  2"
    named = sheets.read_sheets(spark, str(tmp_path / "a.csv"), source="file").first()
    assert named["file"].endswith("a.csv")
    with pytest.raises(ValueError, match="header of"):
        sheets.read_sheets(spark, write_sheet(tmp_path / "c.csv", rows, columns=SHEET_COLUMNS[::-1])).collect()
    # blanks around names in the header do not matter
    path = tmp_path / "d.csv"
    path.write_text((tmp_path / "a.csv").read_text().replace("State,", " State ,", 1))
    assert [r["State"] for r in sheets.read_sheets(spark, str(path)).collect()] == ["AR", "AR"]


def test_row_order_follows_the_file(spark, tmp_path):
    rows = [report(n, 20210107) for n in range(3000)]
    path = write_sheet(tmp_path / "big.csv", rows)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16KB")
    try:
        df = sheets.read_sheets(spark, path, multi_line=False)
        assert df.rdd.getNumPartitions() > 4
        assert [int(r["ctp_id"]) for r in df.orderBy("_ord").collect()] == list(range(3000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_manifest(spark, tmp_path):
    path = write_sheet(tmp_path / "m.csv", [{"State": "AR", "Entry": "x"}, {"State": "AR", "Entry": "y"},
                                            {"State": "CT", "Entry": "z", "Final": "f"}], ("State", "Entry", "Final"))
    manifest = sheets.read_manifest(spark, path)
    assert sheets.manifest_paths(manifest, "Entry") == {"AR": "x", "CT": "z"}
    assert sheets.manifest_paths(manifest, "Final", ["CT"]) == {"CT": "f"}


def test_written_cells_come_back(spark, tmp_path):
    df = spark.createDataFrame([("A", "f", " ", None, 'q"u,o\nte', 1, "b")],
                               "State string, Facility string, CMS_ID string, County string, City string, Date int, State_Facility_Type string").withColumn("ctp_id", F.lit("1"))
    sinks.write_processed(df, str(tmp_path / "out"))
    names = df.columns
    got = sheets.read_processed(spark, str(tmp_path / "out"), columns=names)
    assert bag_of(got, names) == bag_of(df, names)
    lines = "".join(open(os.path.join(d, f)).read() for d, _, fs in os.walk(tmp_path / "out") for f in fs if f.startswith("part"))
    assert ",," in lines and '""' in lines.replace('"q""u', '""')


def test_absent_states_keep_their_output(spark, tmp_path):
    names = "State string, Facility string, County string, City string, State_Facility_Type string, ctp_id string, Date int"
    both = spark.createDataFrame([("A", "x", "", "", "", "1", 1), ("B", "y", "", "", "", "2", 1)], names)
    out = str(tmp_path / "out")
    sinks.write_processed(both, out, format="parquet")
    sinks.write_processed(both.where("State = 'A'").withColumn("Facility", F.lit("new")), out, format="parquet")
    sinks.write_processed(both.limit(0), out, format="parquet")
    assert sorted(tuple(r) for r in spark.read.parquet(out).select("State", "Facility").collect()) == [("A", "new"), ("B", "y")]
    sinks.publish(both, {"A": str(tmp_path / "p"), "B": str(tmp_path / "p"), "C": None}, format="parquet")
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2


def test_every_state_has_one_chain():
    assert len(chains.ALL_STATES) == len(set(chains.ALL_STATES)) == 43
    assert all(chains.special_steps(c) is not None for c in chains.CHAINS)
    with pytest.raises(ValueError):
        chains.special_steps("nowhere")


def full_set(tmp_path):
    """One small sheet per state, a registry and a manifest."""
    manifest, registry = [], []
    for s in chains.ALL_STATES:
        rows = []
        for n in (1, 2):
            registry.append({"Facility": f"HOME {n}", "City": "c", "County": "k", "ctp_state": s,
                             "CTP_Facility_Type": "nh", "state": s, "ctp_id": f"{s}{n}"})
            rows += [report(n, d, s, ctp_id="", State_Facility_Type="NH", Outbrk_Res_Pos=1, Cume_Res_Pos=10)
                     for d in (20201231, 20210107, 20210114) if (n, d) != (2, 20210107)]
        manifest.append({"State": s, "Entry": write_sheet(tmp_path / f"{s}.csv", rows),
                         "Final": str(tmp_path / "final")})
    return (write_sheet(tmp_path / "manifest.csv", manifest, ("State", "Entry", "Final")),
            write_sheet(tmp_path / "registry.csv", registry,
                        ("Facility", "City", "County", "ctp_state", "CTP_Facility_Type", "state", "ctp_id")))


def test_process_and_check_all_states(spark, tmp_path):
    manifest, registry = full_set(tmp_path)
    panel = jobs.process(spark, manifest, registry_path=registry, out=str(tmp_path / "out"), overwrite_final=True)
    per_state = {r["State"]: r["count"] for r in panel.groupBy("State").count().collect()}
    assert set(per_state) == set(chains.ALL_STATES)
    # 10 grid dates; on one of the reported ones only home 1 appears unless absences are closed
    closing = {*chains.CLOSING, "NC", "WY", "NJ", "KY"}
    assert all(n == (20 if s in closing else 19) for s, n in per_state.items()), per_state
    assert panel.where("last_recorded is not null").select("State").distinct().count() == 12
    assert panel.where("ctp_id = '' or ctp_id is null").count() == 0
    for folder in ("out", "final"):
        again = sheets.read_processed(spark, str(tmp_path / folder), columns=[*SHEET_COLUMNS, "last_recorded"])
        assert again.count() == panel.count()
    assert panel.drop("_ord").columns == [*SHEET_COLUMNS, "last_recorded"]
    found = jobs.check_states(spark, manifest, out=str(tmp_path / "reports"))
    assert found["dupes"].count() == 0
    assert found["types"].where("check = 'metric'").count() == 0
    assert found["date_data_dupes"].count() > 0
    assert os.path.isdir(tmp_path / "reports" / "date_data_dupes" / "sheet=CT")
    assert not os.path.isdir(tmp_path / "reports" / "dupes" / "sheet=CT")
    some = jobs.check_states(spark, states=["CT"], processed=str(tmp_path / "out"))
    assert {r["State"] for r in some["date_data_dupes"].collect()} == {"CT"}


def test_some_states(spark, tmp_path):
    manifest, registry = full_set(tmp_path)
    raw = sheets.read_states(spark, sheets.read_manifest(spark, manifest), ["CT", "AR"])
    raw = lineage.settle(raw.withColumn("ctp_id", F.trim("Facility")))
    counts = {}
    panel, skipped = chains.process_states(raw, ["CT", "AR", "ZZ"], counts=counts)
    assert skipped == ["ZZ"] and panel.select("State").distinct().count() == 2
    panel.collect()
    assert counts["plain 0 standardize"].get["rows"] == 5 and counts["closing 1 close_missing"].get["rows"] == 6
    lazy, _ = chains.process_states(raw, ["CT", "AR"], settling=False)
    assert bag_of(lazy, lazy.columns) == bag_of(panel, lazy.columns)


def test_settle_uses_the_configured_folder(spark, tmp_path):
    sc = spark.sparkContext
    df = lineage.settle(spark.range(3).toDF("x"))
    assert sc.getCheckpointDir().split(":")[-1] in df.inputFiles()[0] and bag_of(df, ["x"]) == bag([{"x": i} for i in range(3)], ["x"])


def test_reports_of_other_states_stay(spark, tmp_path):
    out, kind = str(tmp_path / "r"), "State string, n int"
    checked = spark.createDataFrame([("AR",), ("CT",)], "State string")
    sinks.write_report(spark.createDataFrame([("CT", 1), ("AR", 2)], kind), out, checked=checked)
    sinks.write_report(spark.createDataFrame([("TX", 3)], kind), out,
                       checked=spark.createDataFrame([("TX",), ("AR",)], "State string"))
    assert sorted(d for d in os.listdir(out) if d.startswith("sheet=")) == ["sheet=CT", "sheet=TX"]


def test_output_of_other_states_stays(spark, tmp_path):
    """A second run on another state, with single-line reading, leaves the first one's output."""
    manifest, registry = full_set(tmp_path)
    for states in (["CT"], ["AR"]):
        jobs.process(spark, manifest, states, registry_path=registry, out=str(tmp_path / "one"), multi_line=False)
    assert {d for d in os.listdir(tmp_path / "one") if d.startswith("sheet=")} == {"sheet=AR", "sheet=CT"}


def test_processed_cells_read_like_raw_ones(spark, tmp_path):
    df = spark.createDataFrame([("A", "NA", "#N/A", "x")], "State string, Facility string, City string, County string")
    df = df.withColumns({"State_Facility_Type": F.lit(""), "ctp_id": F.lit("1"), "Date": F.lit(1)})
    sinks.write_processed(df, str(tmp_path / "out"))
    got = sheets.read_processed(spark, str(tmp_path / "out"), states=["A"], source="file").first()
    assert (got["State"], got["Facility"], got["City"], got["County"]) == ("A", None, None, "x")
    assert "sheet=A" in got["file"]
    assert sheets.read_processed(spark, str(tmp_path / "out"), states=["B"]).count() == 0


def spoilt_set(tmp_path):
    """Sheets of three states with one bad date, one unknown facility, a slot of two OPEN rows and an early leaver."""
    manifest, registry = full_set(tmp_path)
    more = {"CT": [report(1, "soon", "CT", ctp_id=""), report(9, 20210107, "CT", ctp_id="")],
            "CO": [report(1, 20210107, "CO", ctp_id="", State_Facility_Type="NH", Outbrk_Res_Pos=5)],
            "KY": []}
    for s, rows in more.items():
        old = [] if s == "KY" else [report(1, 20210107, s, ctp_id="", State_Facility_Type="NH", Outbrk_Res_Pos=1, Cume_Res_Pos=10)]
        early = [report(2, 20210114, s, ctp_id="")] if s == "KY" else []
        write_sheet(tmp_path / f"{s}.csv", [*old, *rows, *early])
    return manifest, registry


def names_below(path):
    return sorted(d for d in os.listdir(path) if not d.startswith(("_SUCCESS", "._SUCCESS")))


def test_rows_set_aside_do_not_fail_the_job(spark, tmp_path):
    manifest, registry = spoilt_set(tmp_path)
    reports, states = str(tmp_path / "reports"), ["CT", "CO", "KY", "AR"]
    with pytest.raises(Exception, match="not a date number|no entity id"):
        jobs.process(spark, manifest, states, registry_path=registry, out=str(tmp_path / "out"))
    assert not os.path.exists(tmp_path / "out") or names_below(tmp_path / "out") == []
    panel = jobs.process(spark, manifest, states, registry_path=registry, out=str(tmp_path / "out"), reports=reports)
    assert {r["State"] for r in panel.select("State").distinct().collect()} == set(states)
    assert panel.where("Facility = 'HOME 9'").count() == 0

    def rows(kind):
        return spark.read.option("header", True).csv(f"{reports}/{kind}").collect()

    bad, = rows("bad_dates")
    assert (bad["State"], bad["Facility"], bad["Date"], bad["detail"], bad["Cume_Res_Pos"]) == ("CT", "HOME 1", None, "soon", "11")
    unknown, = rows("unknown_facilities")
    assert (unknown["Facility"], unknown["Date"], unknown["detail"]) == ("HOME 9", "20210107", "HOME 9 | C | K | CT | NH")
    assert {(r["State"], r["Date"], r["open_rows"]) for r in rows("unmerged_slots")} == {("CO", "20210107", "2")}
    assert [(r["State"], r["Facility"]) for r in rows("early_leavers")] == [("KY", "HOME 2")]
    steps = {(r["State"], r["step"]): int(r["rows"]) for r in rows("steps")}
    assert steps[("CT", "read")] == 3 and steps[("CT", "standardize")] == 1 and steps[("AR", "read")] == 5
    # a second run without the bad rows takes their reports away, those of other states stay
    write_sheet(tmp_path / "CT.csv", [report(1, 20210107, "CT", ctp_id="")])
    jobs.process(spark, manifest, ["CT"], registry_path=registry, reports=reports)
    assert [d for d in names_below(f"{reports}/bad_dates") if d.startswith("sheet=")] == []
    assert names_below(f"{reports}/unmerged_slots") == ["sheet=CO"]


def test_nothing_is_replaced_by_a_job_that_fails(spark, tmp_path, monkeypatch):
    """The last of several outputs fails while it is staged: those before it are not swapped."""
    manifest, registry = full_set(tmp_path)
    out, reports = tmp_path / "out", tmp_path / "reports"
    jobs.process(spark, manifest, ["CT", "AR"], registry_path=registry, out=str(out))
    panel = sheets.read_processed(spark, str(out))
    jobs.check(panel, str(reports))
    before = {d: sorted(os.listdir(d)) for d, _, _ in os.walk(tmp_path)}
    write_sheet(tmp_path / "CT.csv", [report(1, 20210107, "CT", ctp_id="")])
    stage = sinks.Staged

    def failing(df, path, format):
        if path.endswith(("final", "decreased_cumulative")):
            df = df.withColumn("State", F.raise_error(F.lit("disk full")).cast("string"))
        return stage(df, path, format)

    monkeypatch.setattr(sinks, "Staged", failing)
    with pytest.raises(Exception, match="disk full"):
        jobs.process(spark, manifest, ["CT", "AR"], registry_path=registry, out=str(out), overwrite_final=True)
    falling = panel.withColumn("Cume_Res_Pos", F.col("Date").cast("int") * -1)
    with pytest.raises(Exception, match="disk full"):
        jobs.check(falling, str(reports))
    after = {d: sorted(os.listdir(d)) for d, _, _ in os.walk(tmp_path) if "final" not in d and d != str(tmp_path)}
    assert after == {d: x for d, x in before.items() if d in after} and str(out / "sheet=CT") in after


def test_a_swap_that_fails_is_undone(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "r")
    kind = "State string, n int"
    sinks.write_report(spark.createDataFrame([("A", 1), ("B", 1), ("C", 1)], kind), path)
    staged = sinks.stage_report(spark.createDataFrame([("A", 2), ("B", 2)], kind), path)
    there = sinks._directories

    def missing(spark, at):  # a staged state whose directory is not there
        return there(spark, at) | ({"X": "sheet=X"} if "_staged" in at else {})

    monkeypatch.setattr(sinks, "_directories", missing)
    with pytest.raises(Exception, match="sheet=X"):
        staged.swap()
    monkeypatch.undo()
    got = spark.read.option("header", True).csv(path).select("State", "n").collect()
    assert sorted((r["State"], r["n"]) for r in got) == [("A", "1"), ("B", "1"), ("C", "1")]
    assert names_below(path) == ["sheet=A", "sheet=B", "sheet=C"]


def test_tables_of_a_job_are_removed(spark, tmp_path, monkeypatch):
    manifest, registry = full_set(tmp_path)
    work = tmp_path / "work"
    monkeypatch.setattr(lineage, "shared_folder", lambda spark: str(work))
    states = ["CT", "CO", "WY", "KY"]
    with lineage.scope(spark):
        panel = jobs.process(spark, manifest, states, registry_path=registry, out=str(tmp_path / "out"),
                             reports=str(tmp_path / "reports"))
        assert panel.count() > 0
        jobs.check(panel, str(tmp_path / "checks"))
        scope, = os.listdir(work)
        # the panel and four kinds of findings
        assert len([d for d in os.listdir(work / scope) if d.startswith("rollcall-") and "scope" not in d]) == 5
    assert os.listdir(work) == []
    write_sheet(tmp_path / "CO.csv", [report(9, 20210107, "CO", ctp_id="")])
    with pytest.raises(Exception, match="no entity id"):
        jobs.process(spark, manifest, states, registry_path=registry, out=str(tmp_path / "out"))
    assert os.listdir(work) == []
    panel = jobs.process(spark, manifest, ["CT"], registry_path=registry, out=str(tmp_path / "out"))
    assert len(os.listdir(work)) == 1 and panel.count() > 0


def test_headers_are_read_without_a_job(spark, tmp_path):
    """Only the beginnings of files are read: no Spark job runs before the scan of the sheets."""
    import gzip
    rows = [report(n, 20210107) for n in range(50)]
    plain = write_sheet(tmp_path / "a b.csv", rows)
    with gzip.open(tmp_path / "c.csv.gz", "wt") as f:
        f.write(open(plain).read())
    tracker, group = spark.sparkContext.statusTracker(), "headers"
    spark.sparkContext.setJobGroup(group, "headers")
    try:
        df = sheets.read_sheets(spark, [plain, str(tmp_path / "c.csv.gz")])
        assert not tracker.getJobIdsForGroup(group)
        assert df.count() == 100
        with pytest.raises(ValueError, match="header of"):
            sheets.read_sheets(spark, [plain, write_sheet(tmp_path / "d.csv", rows, columns=SHEET_COLUMNS[::-1])])
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_closed_totals_that_are_text(spark):
    from panels import SPEC
    from rollcall.operators import carry
    rows = [("S", "E", d, s, a, b) for d, s, a, b in (
        (20201203, "OPEN", "1", 1), (20201210, "CLOSED", "<11", 4), (20201217, "OPEN", "2", 2),
        (20201223, "CLOSED", "3", 5), (20201231, "OPEN", "1", 1))]
    df = spark.createDataFrame(rows, "State string, ctp_id string, Date int, Outbrk_Status string, Cume_Res_Pos string, Cume_Staff_Death int")
    df = df.withColumns({"_ord": F.col("Date").cast("bigint"), "Outbrk_Res_Pos": F.lit(0), "Outbrk_Staff_Death": F.lit(0)})
    got = carry.add_past_events(df, SPEC).orderBy("Date").collect()
    assert [r["Cume_Res_Pos"] for r in got] == ["1", "<11", "2", "3", "1"]
    assert [r["Cume_Staff_Death"] for r in got] == [1, 4, 6, 9, 10]
    assert [tuple(r) for r in carry.unreadable_closings(df, SPEC).collect()] == [("S", "E", "Cume_Res_Pos")]
