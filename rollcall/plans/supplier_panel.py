"""The operators on a weekly supplier panel made from the driver's tables.

An entity is a supplier, its state the nation, a report the supplier's shipments of one week
with one line status (dated on that week's Thursday).  Noise is injected by modulus, and the
spec carries two metric pairs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.functions.cells import replace_columns
from rollcall.functions.dates import date_grid
from rollcall.functions.lineage import settle, shared_folder
from rollcall.operators import (carry, collapse, densify, entity, markers, ordering, peers, quality,
                                reconcile, standardize, statewise, unreset)
from rollcall.operators.reconcile import Side
from rollcall.plans import chains, jobs
from rollcall.plans.chains import run_chain
from rollcall.sources import sheets, sinks
from rollcall.spec import SHEET_COLUMNS, PanelSpec, text_schema

SPEC = PanelSpec(pairs=(("Cume_Res_Pos", "Outbrk_Res_Pos"), ("Cume_Staff_Pos", "Outbrk_Staff_Pos")))
GRID = date_grid(19950105, 20011101)
METRICS = ["Cume_Res_Pos", "Cume_Staff_Pos", "Outbrk_Res_Pos", "Outbrk_Staff_Pos"]
REPORT = ["State", "Facility", "ctp_id", "Date", "Outbrk_Status", *METRICS]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# shipments to a task that makes the panel; two of them give about one report
TASK_ITEMS = 100_000


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REPORT columns, ``nation_key`` and ``week`` for noise, ``_ord`` (OPEN before CLOSED).

    Shipments are dealt by supplier once; all that follows works on a supplier's rows where they lie.  The number
    of tasks grows with the shipments, as packed bytes, by which Spark would choose it, say little about rows.
    """
    items = table(spark, sf_dir, "lineitem")
    tasks = max(spark.sparkContext.defaultParallelism, -(-items.count() // TASK_ITEMS))  # counted from file footers
    thursday = F.date_add(F.trunc("l_shipdate", "week"), 3)
    weekly = (items.select(F.col("l_suppkey").alias("ctp_id"), thursday.alias("day"), (F.col("l_linestatus") == "O").alias("open"),
                           "l_quantity")
              .repartition(tasks, "ctp_id").groupBy("ctp_id", "day", F.when(F.col("open"), "OPEN").otherwise("CLOSED")
                                                    .alias("Outbrk_Status"))
              .agg(F.sum("l_quantity").cast("bigint").alias("Outbrk_Res_Pos"),
                   F.count(F.lit(1)).alias("Outbrk_Staff_Pos")))
    # at most two rows per supplier and week
    so_far = (Window.partitionBy("ctp_id").orderBy("day", "Outbrk_Status")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    date = F.year("day") * 10000 + F.month("day") * 100 + F.day("day")
    totals = weekly.select(
        "ctp_id", "Outbrk_Status", "Outbrk_Res_Pos", "Outbrk_Staff_Pos", date.alias("Date"),
        (F.datediff("day", F.lit("1995-01-05").cast("date")) / 7).cast("int").alias("week"),
        F.sum("Outbrk_Res_Pos").over(so_far).alias("Cume_Res_Pos"),
        F.sum("Outbrk_Staff_Pos").over(so_far).alias("Cume_Staff_Pos"),
        (date.cast("bigint") * 2 + (F.col("Outbrk_Status") == "CLOSED").cast("bigint")).alias("_ord"))
    suppliers = (table(spark, sf_dir, "supplier")
                 .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
                 .select(F.col("s_suppkey").alias("ctp_id"), F.col("s_name").alias("Facility"),
                         F.col("n_name").alias("State"), F.col("n_nationkey").alias("nation_key")))
    # the totals lie sorted by supplier already, so a merge join moves only the suppliers
    return totals.join(suppliers.hint("merge"), "ctp_id").select(*REPORT, "nation_key", "week", "_ord")


def iso(date: str) -> Column:
    """A yyyymmdd number as yyyy-MM-dd text."""
    t = F.col(date).cast("string")
    return F.concat_ws("-", F.substring(t, 1, 4), F.substring(t, 5, 2), F.substring(t, 7, 2))


def every(n: int, *parts: str) -> Column:
    """True on every n-th combination of the given integer columns."""
    total = F.col(parts[0])
    for p in parts[1:]:
        total = total + F.col(p)
    return total % n == 0


def thinned(p: DataFrame) -> DataFrame:
    """Without every fifth week of each state."""
    return p.where(~every(5, "nation_key", "week"))


def one_row_per_date(p: DataFrame) -> DataFrame:
    """The OPEN row of a supplier and week, or the CLOSED one where there is no other."""
    slot = Window.partitionBy("ctp_id", "Date").orderBy("_ord")  # one or two rows
    return p.withColumn("nth", F.row_number().over(slot)).where("nth = 1").drop("nth")


def dirty(p: DataFrame) -> DataFrame:
    """Totals as text with some suppressed; some rows doubled, some OPEN rows with a rival."""
    text = replace_columns(p, {
        "Cume_Res_Pos": F.col("Cume_Res_Pos").cast("string"),
        "Cume_Staff_Pos": F.when(every(19, "ctp_id", "week"), "<11")
        .when(every(23, "ctp_id", "week"), F.lit(None))
        .otherwise(F.col("Cume_Staff_Pos").cast("string"))})
    # 0 is the row itself, 1 its double, 2 its rival
    copies = F.array_compact(F.array(
        F.lit(0), F.when(every(17, "ctp_id", "week"), 1),
        F.when(every(13, "ctp_id", "week") & (F.col("Outbrk_Status") == "OPEN"), 2)))
    return (text.withColumn("copy", F.explode(copies)).withColumns({
        "_ord": F.col("_ord") * 4 + F.col("copy"),
        "Outbrk_Res_Pos": F.col("Outbrk_Res_Pos") + (F.col("copy") == 2).cast("int"),
        "State_Facility_Type": F.when(every(3, "ctp_id"), "RCFE")
        .when(every(2, "ctp_id"), "Residential Care").otherwise("NH")}).drop("copy"))


def labelled(p: DataFrame) -> DataFrame:
    """Reports with noisy text labels in the sheet's columns."""
    return p.select(
        F.col("Date").cast("string").alias("Date"),
        F.concat(F.lit(" "), F.lower("State"), F.lit("\t ")).alias("State"),
        F.when(~every(4, "ctp_id"), F.concat(F.lit("North  "), F.col("State"), F.lit(" county")))
        .alias("County"),
        F.lit("Saint‐Paul \n West").alias("City"),
        F.regexp_replace("Facility", "#0", "  §#Ͳ ").alias("Facility"),
        F.lower("Outbrk_Status").alias("Outbrk_Status"),
        F.lit("  nursing\thome").alias("State_Facility_Type"),
        F.lit("Nursing Home").alias("CTP_Facility_Type"),
        "ctp_id", *METRICS, "_ord")


LABELS = ["Date", "State", "County", "City", "Facility", "Outbrk_Status", "State_Facility_Type",
          "CTP_Facility_Type", "ctp_id", *METRICS]


def std_text(spark, sf_dir):
    out = standardize.tidy_text_columns(standardize.integer_dates(labelled(panel(spark, sf_dir)), SPEC), SPEC)
    return standardize.clean_names(out, SPEC).select(*LABELS)


def std_dedup(spark, sf_dir):
    rows = labelled(panel(spark, sf_dir))
    # 0 is the row itself, 1 the same in other spelling, 2 one without a name
    copies = F.array_compact(F.array(F.lit(0), F.when(every(3, "ctp_id"), 1), F.when(every(10, "ctp_id"), 2)))
    more = rows.withColumn("copy", F.explode(copies)).withColumns({
        "Facility": F.when(F.col("copy") == 0, F.col("Facility")).when(F.col("copy") == 1, F.upper("Facility")),
        "_ord": F.col("_ord") + F.col("copy") * 1_000_000_000}).drop("copy")
    return standardize.standardize(more, SPEC).select(*LABELS)


def registry(spark, sf_dir) -> DataFrame:
    """Suppliers as a registry; every sixth has an outdated entry before its current one."""
    suppliers = (table(spark, sf_dir, "supplier")
                 .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
                 .select(F.lower("s_name").alias("Facility"), F.lit("").alias("City"),
                         F.lower(F.concat(F.lit("Region "), F.col("n_regionkey"))).alias("County"),
                         F.lower("n_name").alias("ctp_state"), F.lit("Supplier").alias("CTP_Facility_Type"),
                         F.col("n_name").alias("state"),
                         F.concat(F.lit("S"), F.col("s_suppkey")).alias("ctp_id"),
                         (F.col("s_suppkey") * 2 + 1).alias("_ord"), F.col("s_suppkey").alias("key")))
    outdated = suppliers.where(every(6, "key")).withColumns(
        {"ctp_id": F.concat(F.lit("OLD"), F.col("key")), "_ord": F.col("_ord") - 1})
    return suppliers.unionByName(outdated)


def _for_lookup(spark, sf_dir) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    return (panel(spark, sf_dir).join(nations, F.col("State") == F.col("n_name"))
            .select(F.col("Date"), F.col("State"), F.upper("Facility").alias("Facility"),
                    F.lit("").alias("City"),
                    F.concat(F.lit("REGION "), F.col("n_regionkey")).alias("County"),
                    F.lit("SUPPLIER").alias("CTP_Facility_Type"), "Outbrk_Status",
                    F.col("ctp_id").alias("s_suppkey"), "_ord"))


def entity_lookup(spark, sf_dir):
    out = entity.add_entity_id(_for_lookup(spark, sf_dir), registry(spark, sf_dir).drop("key"), SPEC)
    return out.select("State", "Facility", "County", "Date", "Outbrk_Status", "s_suppkey", "ctp_id")


def entity_unmatched(spark, sf_dir):
    known = registry(spark, sf_dir).where(~every(7, "key")).drop("key")
    return entity.unmatched_entities(_for_lookup(spark, sf_dir), known, SPEC)


def fill_missing_dates(spark, sf_dir):
    return densify.fill_missing_dates(thinned(panel(spark, sf_dir)), SPEC, grid=GRID).select(*REPORT)


def close_missing(spark, sf_dir):
    return densify.close_missing(panel(spark, sf_dir), SPEC).select(*REPORT, "last_recorded")


def locf_markers(spark, sf_dir):
    return markers.replace_no_data(_marked(panel(spark, sf_dir)), SPEC).select(*REPORT)


def _marked(p: DataFrame) -> DataFrame:
    """Totals as text, some of them markers."""
    return replace_columns(p, {
        "Cume_Res_Pos": F.when(every(11, "ctp_id", "week"), "NO DATA")
        .otherwise(F.col("Cume_Res_Pos").cast("string")),
        "Cume_Staff_Pos": F.when(every(7, "ctp_id", "week"), "Not Reported")
        .when(every(9, "ctp_id", "week"), F.lit(None))
        .otherwise(F.col("Cume_Staff_Pos").cast("string"))})


def collapse_add(spark, sf_dir):
    return collapse.collapse_adding(dirty(panel(spark, sf_dir)), SPEC).select(*REPORT)


def collapse_diagnostics(spark, sf_dir):
    """Doubles and rivals carry names of their own, so a slot has up to three labels."""
    rows = dirty(panel(spark, sf_dir))
    named = replace_columns(rows, {"Facility": F.concat("Facility", F.lit(" "), F.col("_ord") % 4)})
    return collapse.collapse_diagnostics(named, SPEC).select(
        "State", "ctp_id", "Date", "open_rows", "rows_differ", "column", "value", "rows")


def collapse_no_add(spark, sf_dir):
    return collapse.collapse_without_adding(dirty(panel(spark, sf_dir)), SPEC).select(*REPORT)


def collapse_no_add_listed(spark, sf_dir):
    return (collapse.collapse_without_adding(dirty(panel(spark, sf_dir)), SPEC, restrict_types=True)
            .select(*REPORT, "State_Facility_Type"))


CARRY_SINCE = 19970101


def carry_closed(spark, sf_dir):
    rows = one_row_per_date(panel(spark, sf_dir))
    return carry.carry_closed_event(rows, SPEC, since=CARRY_SINCE, one_row_per_date=True).select(*REPORT)


def carry_closed_many_rows(spark, sf_dir):
    return carry.carry_closed_event(panel(spark, sf_dir), SPEC, since=CARRY_SINCE).select(*REPORT)


def sum_outbreaks(spark, sf_dir):
    rows = thinned(one_row_per_date(panel(spark, sf_dir)))
    return carry.sum_outbreaks(rows, SPEC, grid=GRID, one_row_per_date=True).select(*REPORT)


def sum_outbreaks_many_rows(spark, sf_dir):
    return carry.add_past_events(panel(spark, sf_dir), SPEC).select(*REPORT)


# totals start anew six weeks before the panel ends
RESET = unreset.Reset(20010920, 20010921, 20010921, ("Cume_Res_Pos", "Cume_Staff_Pos"))


def _reset_rows(spark, sf_dir) -> DataFrame:
    """The whole panel, some totals suppressed, also on the base date."""
    rows = replace_columns(one_row_per_date(panel(spark, sf_dir)), {
        "Cume_Staff_Pos": F.when(every(4, "ctp_id", "week"), "<11").otherwise(F.col("Cume_Staff_Pos").cast("string"))})
    return settle(rows)  # read several times


def sum_outbreaks_text(spark, sf_dir):
    """Closed totals that are text leave later totals of their column alone."""
    return carry.add_past_events(_reset_rows(spark, sf_dir), SPEC).select(*REPORT)


def unreadable_closings(spark, sf_dir):
    return carry.unreadable_closings(_reset_rows(spark, sf_dir), SPEC)


def undo_reset(spark, sf_dir):
    return unreset.undo_reset(_reset_rows(spark, sf_dir), SPEC, RESET).select(*REPORT)


def early_leavers(spark, sf_dir):
    return unreset.early_leavers(_reset_rows(spark, sf_dir), SPEC, RESET)


def drop_all_null(spark, sf_dir):
    return statewise.drop_empty_metrics(_with_gaps(panel(spark, sf_dir)), SPEC).select(*REPORT)


def _with_gaps(p: DataFrame) -> DataFrame:
    return replace_columns(p, {c: F.when(~every(k, "ctp_id", "week"), F.col(c))
                               for c, k in zip(METRICS, (3, 6, 6, 9))})


FL_CONTENT = ("Outbrk_Status", "Cume_Staff_Pos", "Outbrk_Res_Pos", "Outbrk_Staff_Pos")


def _typed(p: DataFrame) -> DataFrame:
    """State types, federal ids and counties, blank or contradictory on some rows."""
    kind = F.when(every(4, "ctp_id"), "ALF").when(every(9, "ctp_id", "week") & every(5, "ctp_id"), "ICF")
    return p.withColumns({
        "State_Facility_Type": F.when(every(6, "ctp_id", "week"), "").otherwise(kind.otherwise("NH")),
        "CMS_ID": F.when(every(3, "ctp_id", "week"), F.lit(None)).otherwise(
            F.concat(F.lit("C"), F.col("ctp_id"), F.when(every(8, "week"), "X").otherwise(""))),
        "County": F.when(every(7, "ctp_id", "week"), "").when(
            every(10, "ctp_id") & every(2, "week"), "EAST").otherwise(F.concat(F.lit("C"), F.col("State")))})


PEERS = ["State", "Facility", "ctp_id", "Date", "Outbrk_Status", "State_Facility_Type", "CMS_ID", "County"]


def peer_fill_type(spark, sf_dir):
    return peers.fill_types_from_peers(_typed(panel(spark, sf_dir)), SPEC).select(*PEERS)


def peer_fill_county(spark, sf_dir):
    return peers.fill_counties_from_peers(_typed(panel(spark, sf_dir)), SPEC).select(*PEERS)


def _florida(p: DataFrame) -> DataFrame:
    """Labels of all kinds, counts with gaps, and the columns that the state's rules overwrite."""
    return replace_columns(_typed(p), {
        "County": F.when(every(15, "week"), "TOTAL ALF").when(every(13, "week"), "UNKNOWN COUNTY")
        .when(every(11, "week"), "MIAMI‐DADE").when(every(7, "week"), "DADE").otherwise(F.col("County")),
        "Outbrk_Res_Pos": F.when(~every(4, "ctp_id", "week"), F.col("Outbrk_Res_Pos")),
        "Outbrk_Staff_Pos": F.when(~every(2, "ctp_id", "week"), F.col("Outbrk_Staff_Pos")),
        "Cume_Staff_Pos": F.when(~every(8, "ctp_id", "week"), F.col("Cume_Staff_Pos")),
    }).withColumns({"CTP_Facility_Type": F.lit("?"), "Regulate": F.lit("?")})


FLORIDA = [*PEERS, "CTP_Facility_Type", "Regulate", *METRICS]


def fl_rules(spark, sf_dir):
    rows = _florida(panel(spark, sf_dir))
    out = statewise.status_from_counts(statewise.clean_counties_fl(rows, SPEC), SPEC)
    out = statewise.drop_empty_content(out, FL_CONTENT)
    out = statewise.clear_federal_ids(statewise.common_types(out, SPEC), SPEC)
    return out.select(*FLORIDA)


def _kentucky_county() -> Column:
    names = F.array(*[F.lit(n) for n in ("JEFFERSON COUNTY", "BULLIT", "BULLITT COUNTY", "SHLEBY",
                                         "WOODFOORD COUNTY", "BOONE")])
    return F.element_at(names, (F.col("ctp_id") % 6 + 1).cast("int"))


def ky_county(spark, sf_dir):
    p = panel(spark, sf_dir).withColumn("County", _kentucky_county())
    return statewise.clean_counties_ky(p, SPEC).select(*REPORT, "County")


def _suspect(p: DataFrame) -> DataFrame:
    """Totals as text with suppression, junk and falls; odd dates and statuses."""
    return replace_columns(p, {
        "Cume_Res_Pos": F.when(every(13, "ctp_id", "week"), "<11")
        .when(every(29, "ctp_id", "week"), "Data Pending")
        .when(every(17, "ctp_id", "week"), (F.col("Cume_Res_Pos") - 400).cast("string"))
        .otherwise(F.col("Cume_Res_Pos").cast("string")),
        "Cume_Staff_Pos": F.when(every(31, "ctp_id", "week"), "58 *")
        .when(every(7, "ctp_id", "week"), F.lit(None))
        .when(every(5, "ctp_id", "week"), F.concat(F.col("Cume_Staff_Pos"), F.lit(".5")))
        .otherwise(F.col("Cume_Staff_Pos").cast("string")),
    }).withColumn("CTP_Facility_Type", F.lit("Nursing Home"))


def dq_types(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("State"), F.concat(F.lit("sheet "), F.col("n_regionkey")).alias("sheet"))
    p = _suspect(panel(spark, sf_dir)).join(nations, "State").withColumns({
        "Date": F.when(every(37, "ctp_id", "week"), "19-1-5").when(every(41, "ctp_id", "week"), F.lit(None))
        .otherwise(F.col("Date").cast("string")),
        "Outbrk_Status": F.when(every(43, "ctp_id", "week"), "Unknown").when(every(47, "ctp_id", "week"), "")
        .when(every(53, "ctp_id", "week"), F.lit(None)).otherwise(F.lower("Outbrk_Status")),
        "Outbrk_Open": F.when(every(59, "ctp_id", "week"), "soon").when(every(3, "week"), "3/4/1998")
        .otherwise("1998-03-04"),
        "Outbrk_Closed": F.when(every(61, "ctp_id", "week"), "13/45/2020")})
    return quality.check_data_types(p, SPEC, sheet="sheet")


def dq_open_dupes(spark, sf_dir):
    rows = standardize.drop_exact_duplicates(dirty(panel(spark, sf_dir)), SPEC)
    return quality.open_duplicates(rows, SPEC).select(*REPORT, "error")


def dq_date_dupes(spark, sf_dir):
    p = panel(spark, sf_dir)
    coarse = replace_columns(p, {
        "Cume_Res_Pos": F.when(~every(5, "ctp_id"), (F.col("Cume_Res_Pos") % 3)),
        "Cume_Staff_Pos": F.col("Cume_Staff_Pos") % 2,
        "Outbrk_Res_Pos": F.lit(None).cast("bigint"),
        "Outbrk_Staff_Pos": F.when(every(2, "week"), F.col("Outbrk_Staff_Pos"))})
    return quality.same_data_on_date(coarse, SPEC).select(*REPORT, "error")


def dq_decrease(spark, sf_dir):
    rows = _suspect(one_row_per_date(panel(spark, sf_dir)))
    return quality.falling_totals(rows, SPEC, one_row_per_date=True)


def dq_decrease_many_rows(spark, sf_dir):
    return quality.falling_totals(_suspect(panel(spark, sf_dir)), SPEC)


def dq_decrease_this_week(spark, sf_dir):
    return quality.falling_totals(_suspect(panel(spark, sf_dir)), SPEC, only_this_week=True)


# --- reconciliation: OPEN rows play the federal table, CLOSED rows the national export

FEDERAL = Side("cms_week", "cms_federal_provider_number", "cms_provider_state", "cms_provider_name")
NATIONAL = Side("ctp_cms_week", "ctp_cms_id", "ctp_state", "ctp_facility")
FED_COLUMNS = ["cms_week", "cms_federal_provider_number", "cms_provider_name", "cms_provider_state",
               "cms_cases", "cms_suspected", "cms_deaths"]
FED_TOTALS = {"cms_total_cases": ("cms_cases", "cms_suspected")}
NAT_TOTALS = {"ctp_total_cases": ("ctp_cases", "ctp_probable"),
              "ctp_total_deaths": ("ctp_deaths",)}
DIFFERENCES = {"cms_ctp_cases_diff": ("cms_total_cases", "ctp_total_cases"),
               "cms_ctp_deaths_diff": ("cms_deaths", "ctp_total_deaths")}


def federal_raw(spark, sf_dir) -> DataFrame:
    """OPEN rows under spreadsheet headings, provider numbers padded with zeros."""
    p = panel(spark, sf_dir).where(F.col("Outbrk_Status") == "OPEN")
    return p.select(
        iso("Date").alias("Week Ending"),
        F.concat(F.lpad((F.col("ctp_id") + 1).cast("string"), 8, "0"), F.lit(".0"))
        .alias("Federal Provider Number"),
        F.col("Facility").alias(" Provider Name"), F.col("State").alias("Provider-State"),
        F.col("Cume_Res_Pos").alias("Cases"),
        F.when(~every(3, "ctp_id", "week"), F.col("Outbrk_Res_Pos")).alias("Suspected"),
        F.when(~every(10, "ctp_id", "week"), F.col("Cume_Staff_Pos")).alias("Deaths"))


def federal(spark, sf_dir) -> DataFrame:
    return reconcile.prepare_federal(federal_raw(spark, sf_dir), since="1995-02-01",
                                     columns=FED_COLUMNS, totals=FED_TOTALS)


def national(spark, sf_dir) -> DataFrame:
    return reconcile.prepare_national(national_raw(spark, sf_dir), totals=NAT_TOTALS)


def national_raw(spark, sf_dir) -> DataFrame:
    """CLOSED rows, some without a federal id, some twice."""
    p = panel(spark, sf_dir).where(F.col("Outbrk_Status") == "CLOSED")
    rows = p.select(
        iso("Date").alias("ctp_cms_week"),
        F.when(~every(12, "ctp_id", "week"), (F.col("ctp_id") + 1).cast("string")).alias("ctp_cms_id"),
        F.col("Facility").alias("ctp_facility"), F.col("State").alias("ctp_state"),
        F.col("ctp_id").alias("ctp_ctp_id"),
        F.when(every(4, "ctp_id"), "Nursing Home").otherwise("Uncategorized").alias("ctp_ctp_facility_type"),
        F.col("Cume_Res_Pos").alias("ctp_cases"),
        F.when(every(5, "ctp_id", "week"), F.col("Outbrk_Res_Pos")).alias("ctp_probable"),
        F.when(~every(11, "ctp_id", "week"), F.col("Cume_Staff_Pos")).alias("ctp_deaths"))
    times = F.when(every(9, "ctp_ctp_id"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumn("time", F.explode(times)).drop("time")


FED_ALL = [*FED_COLUMNS, *FED_TOTALS]
NAT_ALL = ["ctp_cms_week", "ctp_cms_id", "ctp_facility", "ctp_state", "ctp_ctp_id", "ctp_ctp_facility_type",
           "ctp_cases", "ctp_probable", "ctp_deaths", *NAT_TOTALS]


def _inner(spark, sf_dir) -> DataFrame:
    return _matched(federal(spark, sf_dir), national(spark, sf_dir))


def _matched(fed: DataFrame, nat: DataFrame) -> DataFrame:
    return reconcile.add_differences(reconcile.match_both(fed, nat, FEDERAL, NATIONAL), DIFFERENCES)


def _sides(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Both sources written out, for queries that read them several times."""
    return settle(federal(spark, sf_dir)), settle(national(spark, sf_dir))


def _outer(spark, sf_dir) -> DataFrame:
    return reconcile.match_outer(*_sides(spark, sf_dir), FEDERAL, NATIONAL)


def recon_federal(spark, sf_dir):
    return federal(spark, sf_dir).select(*FED_ALL)


def recon_national(spark, sf_dir):
    return national(spark, sf_dir).select(*NAT_ALL)


def recon_inner(spark, sf_dir):
    diffs = [d + e for d in DIFFERENCES for e in ("", "_abs")]
    return _inner(spark, sf_dir).select(*FED_ALL, *NAT_ALL, *diffs)


def recon_outer(spark, sf_dir):
    return _outer(spark, sf_dir).select(*FED_ALL, *NAT_ALL)


def recon_latest(spark, sf_dir):
    outer = settle(_outer(spark, sf_dir))  # its matched rows tell the latest week
    matched = outer.where(F.col("cms_week").isNotNull() & F.col("ctp_cms_week").isNotNull())
    return reconcile.at_latest_week(outer, matched, "cms_week", "ctp_cms_week").select(*FED_ALL, *NAT_ALL)


def recon_unmatched_top5(spark, sf_dir):
    alone = reconcile.unmatched_federal(_outer(spark, sf_dir), FEDERAL, NATIONAL)
    return (reconcile.top_unmatched(alone, "cms_deaths",
                                    ["cms_week", "cms_federal_provider_number"], f=FEDERAL)
            .select("cms_provider_state", "rank", "cms_week", "cms_provider_name", "cms_deaths"))


def recon_divergent(spark, sf_dir):
    return (reconcile.most_divergent(_matched(*_sides(spark, sf_dir)), "cms_ctp_cases_diff", 15, "ctp_state",
                                     ["cms_week", "cms_federal_provider_number"])
            .select("ctp_state", "end", "rank", "cms_week", "ctp_facility", "cms_ctp_cases_diff"))


def recon_divergent_report(spark, sf_dir):
    """Of the latest week, providers named once, the five lowest and highest differences of a state."""
    matched = settle(_matched(*_sides(spark, sf_dir)))
    latest = reconcile.at_latest_week(matched, matched, "ctp_cms_week")
    once = reconcile.unique_ids(latest, ["ctp_cms_id"])
    return (reconcile.most_divergent(once, "cms_ctp_cases_diff", 15, "ctp_state",
                                     ["cms_week", "cms_federal_provider_number"])
            .select("ctp_state", "end", "rank", "cms_week", "ctp_facility", "cms_ctp_cases_diff"))


def recon_exports(spark, sf_dir):
    """Both sources through CSV files with counts written as decimals."""
    folder = f"{shared_folder(spark)}/exports-{uuid.uuid4().hex}"
    counts = {"federal": ["Cases", "Suspected", "Deaths"], "national": ["ctp_cases", "ctp_probable", "ctp_deaths"]}
    for name, rows in (("federal", federal_raw(spark, sf_dir)), ("national", national_raw(spark, sf_dir))):
        rows.withColumns({c: F.col(c).cast("double").cast("string") for c in counts[name]}).write.csv(
            f"{folder}/{name}", header=True)
    fed, nat = (sheets.read_export(spark, f"{folder}/{n}", c) for n, c in counts.items())
    nat = nat.withColumn("ctp_ctp_id", F.col("ctp_ctp_id").cast("bigint"))
    outer = reconcile.match_outer(
        settle(reconcile.prepare_federal(fed, since="1995-02-01", columns=FED_COLUMNS, totals=FED_TOTALS)),
        settle(reconcile.prepare_national(nat, totals=NAT_TOTALS)), FEDERAL, NATIONAL)
    return outer.select(*FED_ALL, *NAT_ALL)


def recon_divergent_week(spark, sf_dir):
    matched = _matched(*_sides(spark, sf_dir))
    latest = reconcile.at_latest_week(matched, matched, "ctp_cms_week")
    return (reconcile.divergent(latest, "cms_ctp_cases_diff", 15, "cms_federal_provider_number")
            .select("ctp_state", "ctp_facility", "cms_week", "cms_ctp_cases_diff", "cms_ctp_cases_diff_abs"))


def recon_unique_ids(spark, sf_dir):
    return reconcile.unique_ids(national(spark, sf_dir), ["ctp_cms_week", "ctp_state"]).select(*NAT_ALL)


def recon_totals(spark, sf_dir):
    alone = F.col("ctp_cms_week").isNull()
    return reconcile.totals_by_state(
        _outer(spark, sf_dir).withColumn("state", F.coalesce("cms_provider_state", "ctp_state")), "state", {
            "deaths": F.col("ctp_total_deaths"),
            "home_deaths": F.when(F.col("ctp_ctp_facility_type") == "Nursing Home", F.col("ctp_total_deaths")),
            "other_deaths": F.when(F.col("ctp_ctp_facility_type") == "Uncategorized", F.col("ctp_total_deaths")),
            "unmatched_deaths": F.when(alone, F.col("cms_deaths")),
            "unmatched_cases": F.when(alone, F.col("cms_total_cases")),
            "unmatched_rows": F.when(alone, F.lit(1))})


def recon_value_counts(spark, sf_dir):
    return reconcile.value_counts(_outer(spark, sf_dir), "cms_week")


def recon_counts(spark, sf_dir):
    return reconcile.distinct_counts(_outer(spark, sf_dir), {
        "national_with_case": ("ctp_ctp_id", F.col("ctp_total_cases") > 900),
        "national_with_death": ("ctp_ctp_id", F.col("ctp_total_deaths") > 300),
        "federal_with_case": ("cms_federal_provider_number", F.col("cms_total_cases") > 5000),
        "federal_with_death": ("cms_federal_provider_number", F.col("cms_deaths") > 100),
        "states_with_data": ("ctp_state", F.col("ctp_ctp_id").isNotNull()),
        "nobody": ("ctp_state", F.col("cms_deaths") < 0)})


def recon_series(spark, sf_dir):
    return reconcile.facility_series(
        _outer(spark, sf_dir), "Supplier#000000003", _state_of(3, spark, sf_dir),
        ["ctp_cms_week", "ctp_facility", "ctp_total_deaths", "cms_deaths"], NATIONAL)


def _state_of(key: int, spark, sf_dir) -> Column:
    nation = table(spark, sf_dir, "supplier").where(F.col("s_suppkey") == key).select("s_nationkey")
    name = (table(spark, sf_dir, "nation").join(nation, F.col("n_nationkey") == F.col("s_nationkey"))
            .select(F.max("n_name")))
    return name.scalar()


# --- whole state chains, from standardized rows

def _ready(spark, sf_dir) -> DataFrame:
    return thinned(panel(spark, sf_dir)).withColumns(
        {c: F.lit("") for c in ("County", "City", "State_Facility_Type", "CTP_Facility_Type")})


def state_chain_plain(spark, sf_dir):
    return run_chain(_ready(spark, sf_dir), "plain", SPEC, grid=GRID, ordered=True).select(*REPORT)


def state_chain_closing(spark, sf_dir):
    return run_chain(_ready(spark, sf_dir), "closing", SPEC, grid=GRID).select(*REPORT, "last_recorded")


def state_chain_nj(spark, sf_dir):
    return run_chain(_ready(spark, sf_dir), "new_jersey", SPEC, grid=GRID, since=19960101,
                     carry_from=19970101).select(*REPORT, "last_recorded")


def state_chain_wy(spark, sf_dir):
    return run_chain(_ready(spark, sf_dir), "wyoming", SPEC, grid=GRID).select(*REPORT, "last_recorded")


def state_chain_collapsing(spark, sf_dir):
    return run_chain(_ready(spark, sf_dir), "collapsing", SPEC, grid=GRID).select(*REPORT)


def state_chain_merging(spark, sf_dir):
    rows = dirty(thinned(panel(spark, sf_dir)))
    return run_chain(rows, "merging", SPEC, grid=GRID, standardized=True).select(*REPORT)


def state_chain_listed(spark, sf_dir):
    rows = dirty(thinned(panel(spark, sf_dir)))
    return run_chain(rows, "merging_listed_types", SPEC, grid=GRID, standardized=True).select(
        *REPORT, "State_Facility_Type")


def state_chain_marked(spark, sf_dir):
    rows = _marked(thinned(panel(spark, sf_dir)))
    return run_chain(rows, "marked", SPEC, grid=GRID, standardized=True).select(*REPORT)


def state_chain_dropping(spark, sf_dir):
    rows = _with_gaps(thinned(panel(spark, sf_dir)))
    return run_chain(rows, "dropping_empty", SPEC, grid=GRID, standardized=True).select(*REPORT)


def state_chain_florida(spark, sf_dir):
    """Every fourth facility has a census, the other content columns are empty."""
    rows = _florida(thinned(panel(spark, sf_dir))).withColumns(
        {c: F.lit(None).cast("bigint") for c in statewise.FL_CONTENT if c not in REPORT}
        | {"Res_Census": F.when(every(4, "ctp_id"), F.col("ctp_id"))})
    return run_chain(rows, "florida", SPEC, grid=GRID, standardized=True).select(*FLORIDA, "Res_Census")


def state_chain_kentucky(spark, sf_dir):
    rows = _reset_rows(spark, sf_dir).withColumn("County", _kentucky_county())
    return run_chain(rows, "kentucky", SPEC, grid=GRID, standardized=True, reset=RESET).select(*REPORT, "County")


def state_chain_looked_up(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(F.col("n_name").alias("State"), "n_regionkey")
    rows = _ready(spark, sf_dir).drop("County", "CTP_Facility_Type").join(nations, "State").withColumns({
        "County": F.concat(F.lit("REGION "), F.col("n_regionkey")), "CTP_Facility_Type": F.lit("Supplier")})
    # rows are read twice: busy facilities are counted ahead
    return run_chain(settle(rows.drop("n_regionkey")), "looked_up_twice", SPEC, grid=GRID,
                     registry=registry(spark, sf_dir).drop("key")).select(*REPORT, "last_recorded")


def finish_panel(spark, sf_dir):
    p = _ready(spark, sf_dir).withColumn(
        "Outbrk_Status", F.when(~every(6, "ctp_id", "week"), F.col("Outbrk_Status")))
    return ordering.finish(p, SPEC, grid=GRID, close_unknown_status=True).select(*REPORT)


STATES = ("CT", "AR", "CO", "NJ", "WY")
CHAIN_OPTIONS = {"grid": GRID, "since": 19960101, "carry_from": 19970101}


def _coded(spark, sf_dir) -> DataFrame:
    """Nations stand for five states with five different chains."""
    code = F.element_at(F.array(*[F.lit(c) for c in STATES]), (F.col("nation_key") % 5 + 1).cast("int"))
    return _ready(spark, sf_dir).withColumn("State", code)


def process_states(spark, sf_dir):
    out, _ = chains.process_states(_coded(spark, sf_dir), STATES, SPEC, **CHAIN_OPTIONS)
    return out.select(*REPORT, "last_recorded")


def _csv(rows: DataFrame, path: str, by: str | None = None) -> None:
    writer = rows.write.option("header", True).option("escape", '"').option("ignoreTrailingWhiteSpace", False)
    (writer if by is None else writer.partitionBy(by)).csv(path)


def _entry_files(spark, sf_dir, folder: str, coded: DataFrame, states, known: Column | None = None) -> None:
    """Sheets, registry (of the ``known`` suppliers) and manifest as CSV."""
    rows = coded.withColumn("sheet", F.col("State"))
    cells = [F.col(c) if c in rows.columns and c != "ctp_id" else F.lit(None).cast("string").alias(c)
             for c in SHEET_COLUMNS]
    # a supplier's rows lie in one file, in order; the heading of the state has a stray blank
    sheet = rows.repartition("sheet", "ctp_id").sortWithinPartitions("sheet", "ctp_id", "_ord").select(*cells, "sheet")
    _csv(sheet.withColumnRenamed("State", "State "), f"{folder}/entry", by="sheet")
    nothing = F.lit(None).cast("string")
    code = F.element_at(F.array(*[F.lit(c) for c in states]), (F.col("s_nationkey") % len(states) + 1).cast("int"))
    _csv(table(spark, sf_dir, "supplier").where(F.lit(True) if known is None else known).select(
        F.col("s_name").alias("Facility"), nothing.alias("City"), nothing.alias("County"), code.alias("ctp_state"),
        nothing.alias("CTP_Facility_Type"), code.alias("state"), F.concat(F.lit("S"), F.col("s_suppkey")).alias("ctp_id")),
        f"{folder}/registry")
    # the sheets just written, by their folders; the panel need not be made again for that
    names = F.array(*[F.lit(s) for s in sinks.states_below(spark, f"{folder}/entry")]).cast("array<string>")
    there = spark.range(1, numPartitions=1).select(F.explode(names).alias("sheet"))
    _csv(there.select(F.col("sheet").alias("State"), F.concat(F.lit(f"{folder}/entry/sheet="), "sheet").alias("Entry"),
                      F.concat(F.lit(f"{folder}/final-"), "sheet").alias("Final")), f"{folder}/manifest")


def job_process(spark, sf_dir):
    """The job from files to files: sheets, registry and manifest are written as CSV, two runs process them,
    and the result is read from the common output for three states, from their Final paths for the others."""
    folder = f"{shared_folder(spark)}/job-{uuid.uuid4().hex}"
    _entry_files(spark, sf_dir, folder, _coded(spark, sf_dir), STATES)
    for states in (STATES[:2], STATES[2:]):
        jobs.process(spark, f"{folder}/manifest", states, registry_path=f"{folder}/registry", out=f"{folder}/out",
                     overwrite_final=True, multi_line=False, **CHAIN_OPTIONS)
    finals = sheets.manifest_paths(sheets.read_manifest(spark, f"{folder}/manifest"), "Final", STATES[3:])
    out = sheets.read_processed(spark, f"{folder}/out", states=STATES[:3], multi_line=False).unionByName(
        sheets.read_processed(spark, sorted(finals.values()), multi_line=False), allowMissingColumns=True)
    return out.select("State", "Facility", "ctp_id", F.col("Date").cast("int").alias("Date"), "Outbrk_Status",
                      *[F.col(c).cast("bigint").alias(c) for c in METRICS],
                      F.col("last_recorded").cast("int").alias("last_recorded"))


SIDE_STATES = ("CT", "CO", "KY")


def job_side_reports(spark, sf_dir):
    """What the process job sets aside and reports, by facility, and the rows of its panel.

    Some reports have an unreadable date, every seventh supplier is unknown to the registry, some OPEN rows
    have a rival.  A first run has left a report that this one must take away.
    """
    folder = f"{shared_folder(spark)}/side-{uuid.uuid4().hex}"
    code = F.element_at(F.array(*[F.lit(c) for c in SIDE_STATES]), (F.col("nation_key") % 3 + 1).cast("int"))
    copies = F.array_compact(F.array(F.lit(0), F.when(every(13, "ctp_id", "week") & (F.col("Outbrk_Status") == "OPEN"), 1)))
    rows = panel(spark, sf_dir).withColumn("copy", F.explode(copies)).withColumns({
        "State": code, "_ord": F.col("_ord") * 2 + F.col("copy"), "Outbrk_Res_Pos": F.col("Outbrk_Res_Pos") + F.col("copy"),
        "Date": F.when(every(29, "ctp_id", "week"), "soon").otherwise(F.col("Date").cast("string"))}).drop("copy")
    _entry_files(spark, sf_dir, folder, rows, SIDE_STATES, known=~every(7, "s_suppkey"))
    reports = f"{folder}/reports"
    sinks.write_report(table(spark, sf_dir, "nation").select(F.lit("CT").alias("State"), F.lit("OLD").alias("Facility")),
                       f"{reports}/early_leavers")
    jobs.process(spark, f"{folder}/manifest", SIDE_STATES, registry_path=f"{folder}/registry", out=f"{folder}/out",
                 reports=reports, multi_line=False, grid=[], reset=RESET)

    aside = (*SHEET_COLUMNS, "detail")
    columns = {"bad_dates": aside, "unknown_facilities": aside, "early_leavers": ("State", "Facility"),
               "unmerged_slots": ("State", "ctp_id", "Date", "open_rows", "rows_differ", "column", "value", "rows")}

    def read(kind: str) -> DataFrame:  # a kind without rows has no file to take a schema from
        return (spark.read.schema(text_schema((*columns[kind], "sheet"))).option("header", True)
                .option("enforceSchema", False).option("escape", '"').csv(f"{reports}/{kind}"))

    found = [read(kind).groupBy("State", "Facility").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit(kind))
             for kind in ("bad_dates", "unknown_facilities", "early_leavers")]
    slots = read("unmerged_slots").where("column = 'Facility'").groupBy("State", F.col("value").alias("Facility")).agg(
        F.count_distinct("Date").alias("n"))
    done = sheets.read_processed(spark, f"{folder}/out", multi_line=False).groupBy("State", "Facility").agg(
        F.count_distinct("Date").alias("n"))
    out = slots.withColumn("kind", F.lit("unmerged_slots")).unionByName(done.withColumn("kind", F.lit("panel")))
    for more in found:
        out = out.unionByName(more)
    return out.select("kind", "State", "Facility", "n")


def job_step_counts(spark, sf_dir):
    """The ledger of the process job: rows of each state after each step of its chain."""
    folder = f"{shared_folder(spark)}/steps-{uuid.uuid4().hex}"
    _entry_files(spark, sf_dir, folder, _coded(spark, sf_dir), STATES)
    jobs.process(spark, f"{folder}/manifest", STATES, registry_path=f"{folder}/registry", reports=f"{folder}/reports",
                 multi_line=False, **CHAIN_OPTIONS)
    steps = spark.read.schema("State string, chain string, nth int, step string, rows bigint, sheet string").option(
        "header", True).csv(f"{folder}/reports/steps")
    return steps.select("State", "chain", "nth", "step", "rows")


def publish_empty_state(spark, sf_dir):
    """A second publication in which every other nation has become empty leaves these nations' reports."""
    folder = f"{shared_folder(spark)}/publish-{uuid.uuid4().hex}"
    rows = settle(_ready(spark, sf_dir))
    targets = {r["n_name"]: f"{folder}/{r['n_nationkey'] % 3}" for r in table(spark, sf_dir, "nation").collect()}
    sinks.publish(rows.drop("week"), targets, SPEC, format="parquet")
    sinks.publish(rows.where(every(2, "nation_key")).drop("week").withColumn("Facility", F.upper("Facility")), targets,
                  SPEC, format="parquet")
    return sheets.read_processed(spark, sorted(set(targets.values())), format="parquet").select(*REPORT)


def job_check(spark, sf_dir):
    """Findings per state and kind in the reports of the check job on a published panel."""
    folder = f"{shared_folder(spark)}/check-{uuid.uuid4().hex}"
    rows = dirty(one_row_per_date(panel(spark, sf_dir)))
    rows = rows.withColumns({c: F.lit("") for c in ("County", "City", "CTP_Facility_Type")})
    sinks.write_processed(rows.drop("nation_key", "week"), f"{folder}/final", SPEC)
    _csv(table(spark, sf_dir, "nation").select(F.col("n_name").alias("State"), F.lit("").alias("Entry"),
                                               F.lit(f"{folder}/final").alias("Final")), f"{folder}/manifest")
    found = jobs.check_states(spark, f"{folder}/manifest", out=f"{folder}/reports", spec=SPEC, multi_line=False)
    out = found["types"].groupBy("State").agg(F.sum("n").alias("n")).withColumn("kind", F.lit("types"))
    for kind in ("dupes", "date_data_dupes", "decreased_cumulative"):
        # a kind without findings has a folder without files
        report = spark.read.schema("first string, sheet string").option("header", True).csv(f"{folder}/reports/{kind}")
        out = out.unionByName(report.groupBy(F.col("sheet").alias("State")).agg(F.count(F.lit(1)).alias("n"))
                              .withColumn("kind", F.lit(kind)))
    return out.select("State", "kind", "n")


def output_order(spark, sf_dir):
    """Place of each report in its state's files, in the order of their names."""
    rows = one_row_per_date(_ready(spark, sf_dir)).withColumns({
        "Facility": F.when(every(4, "ctp_id"), "Supplier").otherwise(F.col("Facility")),
        "County": F.when(~every(5, "ctp_id"), F.concat(F.lit("County "), F.col("ctp_id") % 3)),
        "City": F.concat(F.lit("City "), F.col("ctp_id") % 2),
        "State_Facility_Type": F.when(every(3, "ctp_id"), "NH").otherwise("ALF")})
    path = f"{shared_folder(spark)}/ordered-{uuid.uuid4().hex}"
    sinks.write_processed(rows.drop("week", "nation_key"), path, SPEC, format="parquet")
    read = spark.read.parquet(path).select("State", "Facility", "ctp_id", "Date", F.col("_metadata.file_name").alias("file"),
                                           F.col("_metadata.row_index").alias("at"))
    # files of a state follow each other; there are few
    files = read.groupBy("State", "file").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.coalesce(F.sum("n").over(
        Window.partitionBy("State").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return read.join(files, ["State", "file"]).select(
        "State", "Facility", "ctp_id", "Date", (F.col("before") + F.col("at") + 1).alias("rank"))


def check_findings(spark, sf_dir):
    """Findings per state and kind of a panel checked as a whole."""
    rows = dirty(panel(spark, sf_dir)).withColumn("CTP_Facility_Type", F.lit(""))
    rows = rows.withColumns({"County": F.lit(""), "City": F.lit(""),
                             "sheet": F.concat(F.lit("sheet "), F.col("nation_key") % 5)})
    found = jobs.findings(settle(rows), SPEC, sheet="sheet")
    counts = [found[kind].groupBy("State").agg(F.sum("n" if kind == "types" else F.lit(1)).alias("n"))
              .withColumn("kind", F.lit(kind)) for kind in sorted(found)]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out.select("State", "kind", "n")


def written_and_read(spark, sf_dir):
    """The panel through the CSV writer and reader, written state by state in two runs."""
    rows = _ready(spark, sf_dir).withColumns({
        "Facility": F.when(every(7, "ctp_id"), F.concat(F.lit('a "b", '), F.col("Facility"), F.lit("\nc")))
        .otherwise(F.col("Facility")),
        "Outbrk_Status": F.when(every(6, "ctp_id", "week"), " ")
        .when(~every(5, "ctp_id", "week"), F.col("Outbrk_Status"))})
    path = f"{shared_folder(spark)}/written-{uuid.uuid4().hex}"
    for half in (0, 1):
        sinks.write_processed(rows.where(F.col("nation_key") % 2 == half).select(
            *REPORT, "County", "City", "State_Facility_Type", "_ord"), path, SPEC)
    return sheets.read_processed(spark, path).select(
        "State", "Facility", F.col("ctp_id").cast("bigint").alias("ctp_id"),
        F.col("Date").cast("int").alias("Date"), "Outbrk_Status",
        *[F.col(c).cast("bigint").alias(c) for c in METRICS])


QUERIES = {f.__name__: f for f in (
    std_text, std_dedup, entity_lookup, entity_unmatched, fill_missing_dates, close_missing, locf_markers,
    collapse_add, collapse_diagnostics, collapse_no_add, collapse_no_add_listed, carry_closed,
    carry_closed_many_rows, sum_outbreaks, sum_outbreaks_many_rows, sum_outbreaks_text, unreadable_closings, undo_reset, early_leavers,
    drop_all_null, fl_rules, peer_fill_type, peer_fill_county, ky_county, dq_types, dq_open_dupes,
    dq_date_dupes, dq_decrease, dq_decrease_many_rows, dq_decrease_this_week, recon_federal,
    recon_national, recon_inner, recon_outer, recon_latest, recon_unmatched_top5, recon_divergent,
    recon_divergent_week, recon_divergent_report, recon_exports, recon_unique_ids, recon_totals, recon_value_counts, recon_counts,
    recon_series, state_chain_plain, state_chain_closing, state_chain_nj, state_chain_wy,
    state_chain_collapsing, state_chain_merging, state_chain_listed, state_chain_marked,
    state_chain_dropping, state_chain_florida, state_chain_kentucky, state_chain_looked_up, finish_panel, output_order,
    process_states, job_process, job_side_reports, job_step_counts, publish_empty_state, check_findings, job_check, written_and_read)}
