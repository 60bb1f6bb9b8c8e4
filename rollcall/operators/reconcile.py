"""Reconciliation of a finished panel with a second, federal source."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions.cells import sum_skipping_nulls

# Columns kept of the federal table, after normalization.
FEDERAL_COLUMNS = (
    "cms_week", "cms_federal_provider_number", "cms_provider_name", "cms_provider_state",
    "cms_residents_weekly_confirmed_covid_19", "cms_residents_total_confirmed_covid_19",
    "cms_residents_weekly_suspected_covid_19", "cms_residents_total_suspected_covid_19",
    "cms_residents_weekly_covid_19_deaths", "cms_residents_total_covid_19_deaths",
    "cms_residents_weekly_all_deaths", "cms_residents_total_all_deaths",
    "cms_staff_weekly_confirmed_covid_19", "cms_staff_total_confirmed_covid_19",
    "cms_staff_weekly_suspected_covid_19", "cms_staff_total_suspected_covid_19",
    "cms_staff_weekly_covid_19_deaths", "cms_staff_total_covid_19_deaths",
)
FEDERAL_SINCE = "2020-05-24"

# Totals and the columns they add up.
FEDERAL_TOTALS = {
    "cms_resident_total_cases": ("cms_residents_total_confirmed_covid_19",
                                 "cms_residents_total_suspected_covid_19"),
    "cms_staff_total_cases": ("cms_staff_total_confirmed_covid_19",
                              "cms_staff_total_suspected_covid_19"),
}
NATIONAL_TOTALS = {
    "ctp_resident_total_cases": ("ctp_cume_res_pos", "ctp_cume_res_probpos"),
    "ctp_staff_total_cases": ("ctp_cume_staff_pos", "ctp_cume_staff_probpos"),
    "ctp_resstaff_total_cases": ("ctp_cume_resstaff_pos", "ctp_cume_resstaff_probpos"),
    "ctp_resident_total_deaths": ("ctp_cume_res_death", "ctp_cume_res_probdeath"),
    "ctp_resident_and_resstaff_total_deaths": (
        "ctp_cume_res_death", "ctp_cume_res_probdeath",
        "ctp_cume_resstaff_death", "ctp_cume_resstaff_probdeath"),
    "ctp_staff_total_deaths": ("ctp_cume_staff_death", "ctp_cume_staff_probdeath"),
    "ctp_resstaff_total_deaths": ("ctp_cume_resstaff_death", "ctp_cume_resstaff_probdeath"),
}

# Difference column -> (federal total, national total).
DIFFERENCES = {
    "cms_ctp_resident_cases_diff": ("cms_resident_total_cases", "ctp_resident_total_cases"),
    "cms_ctp_staff_cases_diff": ("cms_staff_total_cases", "ctp_staff_total_cases"),
    "cms_ctp_resident_deaths_diff": ("cms_residents_total_covid_19_deaths",
                                     "ctp_resident_total_deaths"),
    "cms_ctp_staff_deaths_diff": ("cms_staff_total_covid_19_deaths", "ctp_staff_total_deaths"),
    "cms_ctp_resident_and_resstaff_deaths_diff": (
        "cms_residents_total_covid_19_deaths", "ctp_resident_and_resstaff_total_deaths"),
}


@dataclass(frozen=True)
class Side:
    """Key and label columns of one source.  All of them must have the source's prefix."""

    week: str
    id: str
    state: str
    name: str

    @property
    def key(self) -> list[str]:
        return [self.week, self.id]


FEDERAL = Side("cms_week", "cms_federal_provider_number", "cms_provider_state", "cms_provider_name")
NATIONAL = Side("ctp_cms_week", "ctp_cms_id", "ctp_state", "ctp_facility")


def normalize_names(df: DataFrame, prefix: str = "cms_") -> DataFrame:
    """Column names lower-cased and trimmed, blanks, slashes and dashes as '_', with a prefix."""
    swap = str.maketrans(" /-", "___")
    return df.toDF(*[prefix + c.lower().strip().translate(swap) for c in df.columns])


def provider_number(c: Column) -> Column:
    """Text without leading zeros, cut at the first '.'."""
    return F.split(F.ltrim(c.cast("string"), F.lit("0")), "[.]").getItem(0)


# Spellings of a week-ending date, by their shape.
WEEK_SHAPES = {
    r"^\d{4}-\d{2}-\d{2}$": "yyyy-MM-dd",
    r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$": "yyyy-MM-dd HH:mm:ss",
    r"^\d{1,2}/\d{1,2}/\d{4}$": "M/d/yyyy",
    r"^\d{1,2}/\d{1,2}/\d{2}$": "M/d/yy",
    r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2} [AP]M$": "M/d/yyyy h:mm:ss a",
}


def iso_week(c: Column) -> Column:
    """A week-ending date as yyyy-MM-dd text; fails on text that is no date."""
    week = F.lit(None).cast("timestamp")
    for shape, spelling in WEEK_SHAPES.items():
        week = F.when(c.rlike(shape), F.try_to_timestamp(c, F.lit(spelling))).otherwise(week)
    refuse = F.raise_error(F.concat(F.lit("no week-ending date: "), c))
    return F.when(c.isNotNull() & week.isNull(), refuse).otherwise(F.date_format(week, "yyyy-MM-dd"))


def add_totals(df: DataFrame, totals: dict[str, tuple[str, ...]]) -> DataFrame:
    """Row-wise sums that skip nulls; a row without any value sums to 0."""
    return df.withColumns({name: sum_skipping_nulls(list(parts)) for name, parts in totals.items()})


def prepare_federal(raw: DataFrame, *, since: str = FEDERAL_SINCE, columns=FEDERAL_COLUMNS,
                    totals=FEDERAL_TOTALS) -> DataFrame:
    """Federal table: normalized names, ISO weeks after ``since``, provider numbers, totals."""
    named = normalize_names(raw.withColumn("week", iso_week(F.col("Week Ending").cast("string"))))
    keyed = named.withColumn("cms_federal_provider_number",
                             provider_number(F.col("cms_federal_provider_number")))
    return add_totals(keyed.where(F.col("cms_week") > since).select(*columns), totals)


def prepare_national(raw: DataFrame, *, totals=NATIONAL_TOTALS) -> DataFrame:
    """National export without exact duplicates, with totals."""
    return add_totals(raw.dropDuplicates(), totals)


def match_both(fed: DataFrame, nat: DataFrame, f: Side = FEDERAL, n: Side = NATIONAL) -> DataFrame:
    """Inner join on (week, provider); both sides keep their key columns."""
    return fed.join(nat, (F.col(f.week) == F.col(n.week)) & (F.col(f.id) == F.col(n.id)))


def match_outer(fed: DataFrame, nat: DataFrame, f: Side = FEDERAL, n: Side = NATIONAL) -> DataFrame:
    """Full outer join on (week, provider); both sides keep their key columns.

    Written as the national rows with their match, if any, plus what the federal side has alone.
    Unlike one full outer join, both can be split at run time where a national key is hot, and
    rows without a key, which are many in the national export, never meet in one task.
    """
    keyed = nat.where(F.col(n.week).isNotNull() & F.col(n.id).isNotNull())
    unkeyed = nat.where(F.col(n.week).isNull() | F.col(n.id).isNull())
    same = (F.col(f.week) == F.col(n.week)) & (F.col(f.id) == F.col(n.id))
    fed_only = fed.join(keyed.select(*n.key), same, "left_anti")
    return (keyed.join(fed, same, "left").select(*[F.col(f"`{c}`") for c in (*fed.columns, *nat.columns)])
            .unionByName(fed_only, allowMissingColumns=True)
            .unionByName(unkeyed, allowMissingColumns=True))


def add_differences(df: DataFrame, differences=DIFFERENCES) -> DataFrame:
    """Per difference: federal minus national and its absolute value; null if either is null."""
    out = {}
    for name, (a, b) in differences.items():
        out[name] = F.col(a) - F.col(b)
        out[name + "_abs"] = F.abs(F.col(a) - F.col(b))
    return df.withColumns(out)


def latest_week(df: DataFrame, week: str = NATIONAL.week) -> DataFrame:
    """One row with the greatest week."""
    return df.agg(F.max(week).alias("latest_week"))


def at_latest_week(df: DataFrame, matched: DataFrame, *weeks: str, latest: str = NATIONAL.week) -> DataFrame:
    """Rows of ``df`` in which one of ``weeks`` is the greatest ``latest`` week of ``matched``."""
    last = F.broadcast(latest_week(matched, latest))  # a single row
    keys = [c for c in weeks]
    if len(keys) == 1:
        return df.join(last, F.col(keys[0]) == F.col("latest_week"), "left_semi")
    # one of several weeks: compared through the last one that is set, then the other
    picked = F.explode(F.array_distinct(F.array_compact(F.array(*[F.col(k) for k in keys]))))
    tagged = df.withColumn("_week", picked)
    return tagged.join(last, F.col("_week") == F.col("latest_week"), "left_semi").drop("_week")


def unique_ids(df: DataFrame, id_columns: list[str]) -> DataFrame:
    """Drop every row whose id occurs more than once; null is an id like any other.

    Ids are counted before the shuffle, so a hot id reaches a task as one row per input task.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    counted = df.groupBy(*id_columns).agg(F.count(F.lit(1)).alias("_rows"),
                                          F.any_value(row).alias("_row"))
    return counted.where("_rows = 1").select("_row.*")


def divergent(df: DataFrame, difference: str, cutoff: float, *keys: str) -> DataFrame:
    """Rows whose absolute difference exceeds the cutoff, from the lowest difference up."""
    return df.where(F.col(difference + "_abs") > cutoff).orderBy(difference, *keys)


def most_divergent(df: DataFrame, difference: str, cutoff: float, state: str, ties: list[str],
                   n: int = 5) -> DataFrame:
    """Per state, the ``n`` lowest and ``n`` highest differences beyond the cutoff."""
    rows = df.where(F.col(difference + "_abs") > cutoff)

    def ranked(order: Column, end: str) -> DataFrame:
        w = Window.partitionBy(state).orderBy(order, *ties)
        return (rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
                .withColumn("end", F.lit(end)))

    return ranked(F.col(difference).asc(), "lowest").unionByName(
        ranked(F.col(difference).desc(), "highest"))


def unmatched_federal(outer: DataFrame, f: Side = FEDERAL, n: Side = NATIONAL) -> DataFrame:
    """Federal rows that the national export has no row for."""
    return outer.where(F.col(n.week).isNull() & F.col(f.week).isNotNull())


def top_unmatched(unmatched: DataFrame, by: str, ties: list[str], n: int = 5, f: Side = FEDERAL) -> DataFrame:
    """Per state, the ``n`` unmatched providers with the greatest ``by``, nulls last."""
    w = Window.partitionBy(f.state).orderBy(F.col(by).desc_nulls_last(), *ties)
    return (unmatched.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n))


def totals_by_state(df: DataFrame, state: str, sums: dict[str, Column]) -> DataFrame:
    """Filtered sums per state in one pass; absent values count as 0."""
    return df.groupBy(state).agg(*[F.coalesce(F.sum(v), F.lit(0)).alias(k) for k, v in sums.items()])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; nulls are not counted."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("rows")).orderBy(F.col("rows").desc(), column))


def distinct_counts(df: DataFrame, measures: dict[str, tuple[str, Column]]) -> DataFrame:
    """(measure, n): distinct ids among the rows that meet a measure's condition.

    A null id that meets the condition counts as one id.
    """
    hits = F.array_compact(F.array(*[
        F.when(cond, F.struct(F.lit(name).alias("measure"), F.col(i).cast("string").alias("id")))
        for name, (i, cond) in measures.items()]))
    # copies of one (measure, id) are combined before the shuffle
    found = df.select(F.explode(hits).alias("h")).select("h.measure", "h.id").distinct()
    # one row holding every count, so that a measure without any id reports 0
    counts = found.agg(*[F.count_if(F.col("measure") == m).alias(m) for m in measures])
    table = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("n")) for m in measures])
    return counts.select(F.inline(table))


def facility_series(outer: DataFrame, name: str, state: str, columns: list[str],
                    n: Side = NATIONAL) -> DataFrame:
    """One facility's matched history by week."""
    return (outer.where((F.col(n.name) == name) & (F.col(n.state) == state)
                        & F.col(n.week).isNotNull())
            .select(*columns).orderBy(n.week, *[c for c in columns if c != n.week]))
