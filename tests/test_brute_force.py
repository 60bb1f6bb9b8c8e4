"""Every stateful operator against a plain loop, with and without forced spreading."""

import pytest

import loops
from panels import COLUMNS, LABELS, METRICS, PAIRS, SPEC, frame, random_rows, same
from rollcall.operators import (carry, collapse, densify, markers, peers, quality, standardize, unreset)

SEEDS = [1, 2]
RUNNING = [c for c, _ in PAIRS]
CURRENT = [o for _, o in PAIRS]


@pytest.mark.parametrize("seed", SEEDS)
def test_fill_missing_dates(spark, groups, seed):
    rows = random_rows(seed)
    grid = [20201126, 20201203, 20201210, 20201217, 20201224, 20201231, 20210107, 20210114, 20210121,
            20210128, 20210204]
    got = densify.fill_missing_dates(frame(spark, rows), SPEC, grid=grid)
    blank = ["Outbrk_Status", *CURRENT, "Res_Census"]
    same(got, loops.fill(rows, grid, blank), COLUMNS)


@pytest.mark.parametrize("seed", SEEDS)
def test_close_missing(spark, groups, seed):
    rows = random_rows(seed, thin=0.5)
    got = densify.close_missing(frame(spark, rows), SPEC)
    same(got, loops.close(rows, CURRENT), [*COLUMNS, "last_recorded"])


@pytest.mark.parametrize("seed", SEEDS)
def test_replace_no_data(spark, groups, seed):
    rows = random_rows(seed, junk=0.35)
    got = markers.replace_no_data(frame(spark, rows), SPEC)
    same(got, loops.repair(rows, RUNNING, set(markers.NO_DATA)), COLUMNS)


@pytest.mark.parametrize("add", [True, False])
@pytest.mark.parametrize("seed", SEEDS)
def test_collapse_adding(spark, groups, seed, add):
    rows = random_rows(seed, junk=0.04)
    got = collapse.collapse_adding(frame(spark, rows), SPEC, add_current=add)
    same(got, loops.collapse_adding(rows, PAIRS, add), COLUMNS)


@pytest.mark.parametrize("types", [None, collapse.RESTRICTED_TYPES])
@pytest.mark.parametrize("seed", SEEDS)
def test_collapse_without_adding(spark, groups, seed, types):
    rows = random_rows(seed, most=2)
    got = collapse.collapse_without_adding(frame(spark, rows), SPEC, restrict_types=types is not None)
    same(got, loops.merge_pairs(rows, PAIRS, types), COLUMNS)


@pytest.mark.parametrize("seed", SEEDS)
def test_carry_closed_event(spark, groups, seed):
    rows = random_rows(seed, statuses=["OPEN", "CLOSED"], nulls=0.3)
    got = carry.carry_closed_event(frame(spark, rows), SPEC, since=20201217)
    want = loops.carry(rows, PAIRS, 20201217)
    same(got, want, COLUMNS)
    one = carry.carry_closed_event(frame(spark, rows), SPEC, since=20201217, one_row_per_date=True)
    same(one, want, COLUMNS)


@pytest.mark.parametrize("skip", [True, False])
@pytest.mark.parametrize("seed", SEEDS)
def test_add_past_events(spark, groups, seed, skip):
    rows = random_rows(seed, statuses=["OPEN", "closed", "CLOSED", "Closed", "", None])
    got = carry.add_past_events(frame(spark, rows), SPEC, skip_first_transition=skip)
    want = loops.past_events(rows, PAIRS, skip)
    same(got, want, COLUMNS)
    one = carry.add_past_events(frame(spark, rows), SPEC, skip_first_transition=skip, one_row_per_date=True)
    same(one, want, COLUMNS)


@pytest.mark.parametrize("seed", SEEDS)
def test_sum_outbreaks(spark, groups, seed):
    rows = random_rows(seed, statuses=["OPEN", "CLOSED", None])
    grid = [20201224, 20210204]
    filled = loops.fill(rows, grid, ["Outbrk_Status", *CURRENT, "Res_Census"])
    known = [{**r, "Outbrk_Status": r["Outbrk_Status"] or "Closed"} for r in filled]
    same(carry.sum_outbreaks(frame(spark, rows), SPEC, grid=grid), loops.past_events(known, PAIRS), COLUMNS)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_undo_reset(spark, groups, seed):
    rows = random_rows(seed, entities=8, thin=0.15, nulls=0.25)
    reset = unreset.Reset(columns=tuple(RUNNING))
    want, leavers = loops.undo_reset(rows, PAIRS, reset)
    df = frame(spark, rows)
    same(unreset.undo_reset(df, SPEC, reset), want, COLUMNS)
    assert {tuple(r) for r in unreset.early_leavers(df, SPEC, reset).collect()} == leavers


@pytest.mark.parametrize("this_week", [False, True])
@pytest.mark.parametrize("seed", SEEDS)
def test_falling_totals(spark, groups, seed, this_week):
    rows = random_rows(seed, junk=0.2)
    for r in rows:
        if r["State"] == "S1":
            r["State"] = "RI"
            r["Cume_Res_Pos"] = r["Cume_Res_Pos"] and r["Cume_Res_Pos"] + " total"
    want = loops.falling(rows, RUNNING, quality.SUPPRESSED, set(quality.NOT_COMPARABLE), this_week)
    got = quality.falling_totals(frame(spark, rows), SPEC, only_this_week=this_week)
    same(got, want, quality.DECREASE_COLUMNS)
    one = quality.falling_totals(frame(spark, rows), SPEC, only_this_week=this_week, one_row_per_date=True)
    same(one, want, quality.DECREASE_COLUMNS)


@pytest.mark.parametrize("seed", SEEDS)
def test_peers(spark, groups, seed):
    rows = random_rows(seed, entities=10, thin=0.8)
    df = frame(spark, rows)
    same(peers.fill_types_from_peers(df, SPEC), loops.peer_types(rows), COLUMNS)
    same(peers.fill_counties_from_peers(df, SPEC), loops.peer_counties(rows), COLUMNS)


@pytest.mark.parametrize("seed", SEEDS)
def test_duplicate_checks(spark, groups, seed):
    rows = random_rows(seed, nulls=0.6, junk=0)
    df = frame(spark, rows)
    shown = [*LABELS, "Date", *METRICS, "error"]
    same(quality.open_duplicates(df, SPEC),
         loops.open_duplicates(rows, quality.OPEN_ROWS_DIFFER, quality.OPEN_ROWS_SAME), shown)
    same(quality.same_data_on_date(df, SPEC), loops.same_data(rows, METRICS, quality.SAME_DATA), shown)


@pytest.mark.parametrize("seed", SEEDS)
def test_exact_duplicates_keep_the_first(spark, seed):
    rows = random_rows(seed)
    firsts = {}
    for r in rows:
        firsts.setdefault(loops.content(r), r)
    same(standardize.drop_exact_duplicates(frame(spark, rows), SPEC), firsts.values(), COLUMNS)
