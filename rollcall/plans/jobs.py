"""The two jobs a user runs: process raw sheets, check a finished panel."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from contextlib import nullcontext
from threading import Thread

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rollcall.functions.lineage import compilable, scope, settle
from rollcall.operators import quality, standardize
from rollcall.plans.chains import ALL_STATES, SIDE_OUTPUTS, process_states
from rollcall.sources import sheets, sinks
from rollcall.spec import SHEET, PanelSpec

log = logging.getLogger(__name__)


def process(spark: SparkSession, manifest_path: str, states: Iterable[str] | None = None, *,
            registry_path: str | None = None, out: str | None = None, overwrite_final: bool = False,
            reports: str | None = None, format: str = "csv", spec: PanelSpec = SHEET,
            multi_line: bool = True, **options) -> DataFrame:
    """Read the sheets of the states, run their chains, write the panel.

    ``out`` receives one directory per state; ``overwrite_final`` writes each state below the
    manifest's Final path.  In both, states without rows keep what is there.  ``multi_line`` goes
    to the reader, further options go to the chains.

    ``reports`` receives a folder for each of SIDE_OUTPUTS and ``steps``, with one directory per state.  Rows
    with an unreadable date or an unknown facility then go to ``bad_dates`` and ``unknown_facilities``
    instead of failing the job; ``unmerged_slots`` lists slots with several OPEN rows, ``early_leavers``
    facilities without a base for their reset totals; ``steps`` has the rows after each step of a chain.

    All output is staged before any of it replaces older output.  What the job writes on its way is removed
    at its end, but for the table behind the result, which belongs to a ``lineage.scope`` around the call.
    """
    with compilable(spark), scope(spark) if out or overwrite_final or reports else nullcontext():
        manifest = sheets.read_manifest(spark, manifest_path)
        raw = sheets.read_states(spark, manifest, states, spec=spec, multi_line=multi_line)
        registry = None
        if registry_path is not None:
            registry = sheets.read_registry(spark, registry_path, spec=spec)
        side, counts = ({}, {}) if reports else (None, None)
        panel, skipped = process_states(raw, states, spec, registry=registry, side=side, counts=counts, **options)
        if skipped:
            log.error("no chain for states: %s", ", ".join(skipped))
        if not (out or overwrite_final or reports):
            return panel
        panel = settle(panel, by=spec.state, lasting=True).select(*panel.columns)  # each target reads its states only
        stages = []
        if out:
            stages.append(lambda: sinks.stage_processed(panel, out, spec, format=format))
        if overwrite_final:
            stages += sinks.stages_of(panel, sheets.manifest_paths(manifest, "Final", states), spec, format=format)
        found = _reports(spark, side, counts, spec) if reports else {}
        stages += [lambda kind=kind: sinks.stage_report(found[kind], f"{reports}/{kind}", spec.state, format=format)
                   for kind in found]
        wanted = set(ALL_STATES if states is None else states)
        staged = sinks.commit(stages)
        for s in staged[:len(staged) - len(found)]:
            s.swap()
        for s in staged[len(staged) - len(found):]:
            s.swap(gone=lambda others: others & wanted)  # a state without such rows loses its old report
        return panel


def _reports(spark: SparkSession, side: dict[str, list[DataFrame]], counts: dict[str, Observation],
             spec: PanelSpec) -> dict[str, DataFrame]:
    """Side outputs of all chains by kind, and the ledger of steps.  Kinds no chain looked for are left out."""
    found = {}
    for kind in SIDE_OUTPUTS:
        parts = side.get(kind, [])
        if parts:
            found[kind] = parts[0]
            for more in parts[1:]:
                found[kind] = found[kind].unionByName(more, allowMissingColumns=True)
            found[kind] = found[kind].drop(spec.order)
    return found | {"steps": step_counts(spark, counts, spec)}


def step_counts(spark: SparkSession, counts: dict[str, Observation], spec: PanelSpec = SHEET,
                wait: float = 30) -> DataFrame:
    """(state, chain, nth, step, rows): rows of each state after each step, as observed while the chains ran.

    Call it after the panel has been written.  A step that no action ran to its end, as the optimizer may
    see that its rows are not needed, has no count; such a step is waited for only once, ``wait`` seconds.
    """
    got: dict[str, dict] = {}

    def gather() -> None:
        for name in counts:
            one = Thread(target=lambda name=name: got.setdefault(name, counts[name].get), daemon=True)
            one.start()
            waiting.append(one)

    waiting: list[Thread] = []
    gather()
    left = wait
    for one in waiting:
        one.join(left)
        if one.is_alive():
            left = 0.1  # the time is up; those after it are there already or will not come
    rows = []
    for name in counts:
        chain, nth, step = name.split(" ")
        nth = 0 if nth == "-" else int(nth) + 1
        seen = got.get(name, {})
        rows += [(label.removeprefix("rows of "), chain, nth, step, n) for label, n in seen.items() if label != "rows"]
    return spark.createDataFrame(rows, f"`{spec.state}` string, chain string, nth int, step string, rows bigint")


def findings(panel: DataFrame, spec: PanelSpec = SHEET, *, only_this_week: bool = False,
             sheet: str | None = None) -> dict[str, DataFrame]:
    """All checks of a panel: types on the rows as they are, the others on standardized rows.

    ``sheet`` names the column that tells input sheets apart, to find sheets of several states.
    """
    rows = settle(standardize.standardize(panel.drop(*([sheet] if sheet else [])), spec))
    errors = settle(quality.quality_errors(rows, spec, standardized=True))
    same_data = F.col("error") == quality.SAME_DATA
    return {
        "types": quality.check_data_types(panel, spec, sheet=sheet),
        "dupes": errors.where(~same_data),
        "date_data_dupes": errors.where(same_data),
        "decreased_cumulative": quality.falling_totals(rows, spec, only_this_week=only_this_week),
    }


def check(panel: DataFrame, out: str | None = None, spec: PanelSpec = SHEET, *, format: str = "csv",
          only_this_week: bool = False, sheet: str | None = None) -> dict[str, DataFrame]:
    """Check a panel and write one report per kind of finding, one directory per state.

    Reports of states that are not in the panel stay; a state without findings loses its old one.  All
    reports are staged before any replaces an old one.  The tables behind the findings returned belong to a
    ``lineage.scope`` around the call.
    """
    if not out:
        return findings(panel, spec, only_this_week=only_this_week, sheet=sheet)
    kinds = {"dupes": spec.state, "date_data_dupes": spec.state, "decreased_cumulative": "State"}
    with scope(panel.sparkSession):
        found = {kind: settle(df, lasting=True)
                 for kind, df in findings(panel, spec, only_this_week=only_this_week, sheet=sheet).items()}
        staged = sinks.commit([lambda kind=kind, state=state: sinks.stage_report(
            found[kind].drop(spec.order), f"{out}/{kind}", state, format=format) for kind, state in kinds.items()])
        checked = sinks.among(panel.select(F.upper(F.trim(F.col(f"`{spec.state}`"))).alias("state")))
        for s in staged:
            s.swap(gone=checked)
    return found


def check_states(spark: SparkSession, manifest_path: str | None = None, states: Iterable[str] | None = None, *,
                 processed: str | None = None, out: str | None = None, format: str = "csv",
                 spec: PanelSpec = SHEET, only_this_week: bool = False,
                 multi_line: bool = True) -> dict[str, DataFrame]:
    """Check published panels, or with ``processed`` the output of an own run."""
    if processed is not None:
        paths = [processed]
    else:
        manifest = sheets.read_manifest(spark, manifest_path)
        paths = sorted({p for p in sheets.manifest_paths(manifest, "Final", states).values() if p})
    panel = sheets.read_processed(spark, paths, format=format, multi_line=multi_line, states=states,
                                  source="_sheet")
    if states is not None:
        panel = panel.where(F.col(f"`{spec.state}`").isin(*states))
    return check(settle(panel), out, spec, only_this_week=only_this_week, sheet="_sheet")
