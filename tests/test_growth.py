"""What keeps a task's memory and the rows shuffled from growing faster than the input."""

import re

import pytest
from pyspark.sql import functions as F

from rollcall.functions import cells, spread
from rollcall.operators import carry, collapse, densify, entity, quality, standardize
from rollcall.plans import jobs, supplier_panel

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_tasks_of_the_panel_grow_with_shipments(spark, monkeypatch):
    monkeypatch.setattr(supplier_panel, "TASK_ITEMS", 100)
    items = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    plan = _plan(supplier_panel.panel(spark, SF))
    dealt = f", {-(-items // 100)}), REPARTITION_BY_NUM"
    assert dealt in plan and plan.count("hashpartitioning(ctp_id") == 2  # shipments and suppliers, each once


def test_filling_weeks_does_not_shuffle_reports(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.createDataFrame([("X", "a", 1, 19950105, 1), ("X", "a", 1, 19950202, 2)],
                                     "State string, Facility string, ctp_id int, Date int, _ord bigint")
        out = densify.fill_missing_dates(rows, supplier_panel.SPEC, grid=supplier_panel.GRID[:5])
        assert "SortMergeJoin" not in _plan(out)
        assert sorted(r["Date"] for r in out.collect()) == [19950105, 19950112, 19950119, 19950126, 19950202]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_tidy_text_is_the_pattern(spark):
    texts = [None, "", " ", "a b", " a  b ", "a\tb", "\x0ba\x0c", "a\x1c\x1fb", "a\x85b", "a  b", "é x", "ß \n", "a​b"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    pattern = F.trim(F.regexp_replace(F.upper(F.coalesce("t", F.lit(""))), cells.BLANK_RUN, " "))
    assert all(r["a"] == r["b"] for r in rows.select(cells.tidy_text(F.col("t")).alias("a"), pattern.alias("b")).collect())


def _reports(spark):
    rows = [(s, f"f{e}", e, 20210107 + d, status, 5 + d, 9 - d, 1, 0) for s in ("X", None) for e in (*range(4), None)
            for d in range(4) for status in ("OPEN", "OPEN", "CLOSED", "OPEN")]
    rows += [("X", "f9", 9, 20210107, "OPEN", n, 6, 1, 0) for n in range(3)]
    return spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "State string, Facility string, ctp_id int, Date int, "
                                 "Outbrk_Status string, Cume_Res_Pos int, Cume_Staff_Pos int, Outbrk_Res_Pos int, "
                                 "Outbrk_Staff_Pos int, _ord bigint").withColumn("CTP_Facility_Type", F.lit("NH"))


@pytest.mark.parametrize("step", [collapse.collapse_adding, quality.open_duplicates, quality.falling_totals,
                                  carry.add_past_events, carry.carry_closed_event])
def test_entities_that_fit_a_task_are_dealt_once(spark, monkeypatch, step):
    """No second shuffle by chunk, tasks by the number of rows, and the rows that chunks give."""
    monkeypatch.setattr(spread, "TASK_ROWS", 10)
    rows = _reports(spark).localCheckpoint()
    out = step(rows, supplier_panel.SPEC)
    plan = _plan(out)
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan and "_chunk" not in plan
    assert out.rdd.getNumPartitions() > spark.sparkContext.defaultParallelism
    monkeypatch.setattr(spread, "CHUNK_BITS", 1)
    monkeypatch.setattr(spread, "HOT_ROWS", 2)
    hot = step(rows, supplier_panel.SPEC)
    assert out.exceptAll(hot).isEmpty() and hot.exceptAll(out).isEmpty() and not out.isEmpty()


def test_tidied_rows_take_methods_that_the_jvm_compiles(spark):
    """The JVM interprets methods of more than 8,000 bytes, whatever is in them."""
    rows = _reports(spark).localCheckpoint().withColumns({c: F.col("Facility") for c in ("County", "City", "State_Facility_Type")})
    out = standardize.tidy_text_columns(rows, supplier_panel.SPEC)
    code = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "codegen")
    assert 0 < max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < 8000


@pytest.mark.parametrize("hot_rows", [1_000_000, 2])
def test_lookup_counts_rows_once(spark, monkeypatch, hot_rows):
    """One pass counts rows, by one number; the registry is joined as it is."""
    monkeypatch.setattr(spread, "HOT_ROWS", hot_rows)
    rows = _reports(spark).localCheckpoint().where("State is not null and Facility != 'f3'").withColumns(
        {"Facility": F.upper("Facility"), "City": F.lit(""), "County": F.lit("")}).drop("ctp_id")
    registry = spark.createDataFrame([(f"f{e}", None, "", "x", "nh", "X", f"S{e}{n}", 2 * e + n) for e in (*range(3), 9, None) for n in (0, 1)
                                      if e is not None] + [("fNone", "", "", "X", "NH", "X", "S", 99)],
                                     ", ".join(f"{c} string" for c in entity.REGISTRY_COLUMNS) + ", _ord bigint")
    out = entity.match_entities(rows, registry, supplier_panel.SPEC)
    plan = _plan(out)
    assert plan.count("partial_count(1)") == 1 and "xxhash64(Facility" in plan
    assert {(r["Facility"], r["_id"]) for r in out.select("Facility", "_id").collect()} == {
        *((f"F{e}", f"S{e}1") for e in (0, 1, 2, 9)), ("FNONE", "S")}
    assert out.count() == rows.count()


def test_process_keeps_methods_short_enough_to_be_compiled(spark, monkeypatch):
    """Steps over all columns of a sheet would else run interpreted; the session's own setting comes back."""
    name, seen = "spark.sql.codegen.hugeMethodLimit", []

    def stop(*_):
        seen.append(spark.conf.get(name))
        raise KeyError(name)

    monkeypatch.setattr(jobs.sheets, "read_manifest", stop)
    before = spark.conf.get(name)
    with pytest.raises(KeyError):
        jobs.process(spark, "manifest")
    assert seen == ["8000"] and spark.conf.get(name) == before


def test_sheets_take_one_pass_over_shipments(spark, monkeypatch, tmp_path):
    """The manifest names the sheets written; the panel is not made again for it."""
    plans, write = [], supplier_panel._csv
    monkeypatch.setattr(supplier_panel, "_csv", lambda rows, *a, **k: (plans.append(_plan(rows)), write(rows, *a, **k)))
    coded = supplier_panel._coded(spark, SF)
    supplier_panel._entry_files(spark, SF, str(tmp_path), coded, supplier_panel.STATES)
    assert ["l_shipdate" in p for p in plans] == [True, False, False]
    listed = {tuple(r) for r in spark.read.option("header", True).csv(f"{tmp_path}/manifest").collect()}
    assert listed == {(s, f"{tmp_path}/entry/sheet={s}", f"{tmp_path}/final-{s}")
                      for s, in coded.select("State").distinct().collect()}
