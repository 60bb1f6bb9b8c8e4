"""Partitioned writers for processed panels and check reports.

Everything is written to a staging folder first and then swapped in by renames, state by state, so a job that
fails while it computes or writes leaves the old output as it was.  A state that has no staged rows is not
swapped.  On file systems that copy on rename a swap takes as long as a copy.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions.lineage import files_at
from rollcall.operators.ordering import output_order
from rollcall.spec import SHEET, PanelSpec

# Directory key; the State column itself stays inside the files.
STATE_DIRECTORY = "sheet"


def _csv_options(writer):
    # missing values are empty cells; blanks inside cells are data
    return (writer.option("header", True).option("nullValue", "").option("emptyValue", "")
            .option("quote", '"').option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False))


class Staged:
    """Output in a hidden folder below its target: one directory per state that has rows."""

    def __init__(self, df: DataFrame, path: str, format: str):
        self.spark, self.path = df.sparkSession, path
        self.folder = f"{path}/_staged-{uuid.uuid4().hex}"
        writer = df.write.partitionBy(STATE_DIRECTORY)
        if format == "csv":
            writer = _csv_options(writer)
        try:
            writer.format(format).save(self.folder)
        except BaseException:
            self.discard()
            raise

    def discard(self) -> None:
        files, at = files_at(self.spark, self.folder)
        files.delete(at, True)

    def swap(self, gone: Callable[[set[str]], Iterable[str]] | None = None) -> set[str]:
        """Put the staged states in the place of their old output; returns those states.

        ``gone`` gets the states with old output that are not staged and names those to remove.  If a
        rename fails, what was moved is moved back.
        """
        old = f"{self.path}/_old-{uuid.uuid4().hex}"
        moved = []
        files, _ = files_at(self.spark, self.path)

        def move(source: str, target: str) -> None:
            if not files.rename(files_at(self.spark, source)[1], files_at(self.spark, target)[1]):
                raise OSError(f"cannot rename {source} to {target}")
            moved.append((source, target))

        there, staged = _directories(self.spark, self.path), _directories(self.spark, self.folder)
        leaving = [] if gone is None else list(gone(set(there) - set(staged)))
        files.mkdirs(files_at(self.spark, old)[1])
        try:
            for state in [*staged, *leaving]:
                if state in there:
                    move(f"{self.path}/{there[state]}", f"{old}/{there[state]}")
                if state in staged:
                    move(f"{self.folder}/{staged[state]}", f"{self.path}/{staged[state]}")
        except BaseException:
            for source, target in reversed(moved):
                files.rename(files_at(self.spark, target)[1], files_at(self.spark, source)[1])
            if not _directories(self.spark, old):
                files.delete(files_at(self.spark, old)[1], True)
            raise
        else:
            files.delete(files_at(self.spark, old)[1], True)
        finally:
            self.discard()
        return set(staged)


def _directories(spark: SparkSession, path: str) -> dict[str, str]:
    """State -> name of its directory."""
    files, root = files_at(spark, path)
    key = f"{STATE_DIRECTORY}="
    names = [s.getPath().getName() for s in files.listStatus(root)] if files.exists(root) else []
    return {unquote(n[len(key):]): n for n in names if n.startswith(key)}


def states_below(spark: SparkSession, path: str) -> list[str]:
    """The states that have a directory there."""
    return sorted(_directories(spark, path))


def commit(stages: Iterable[Callable[[], Staged]]) -> list[Staged]:
    """Stage several outputs; if one fails, none is kept."""
    done: list[Staged] = []
    try:
        for stage in stages:
            done.append(stage())
    except BaseException:
        for s in done:
            s.discard()
        raise
    return done


def stage_processed(df: DataFrame, path: str, spec: PanelSpec = SHEET, *, format: str = "csv") -> Staged:
    """Files of each state in output order; the range sort splits a large state over several tasks, and
    its files follow each other in name order."""
    state = F.col(f"`{spec.state}`")
    ordered = df.drop(spec.order).orderBy(state, *output_order(spec))
    return Staged(ordered.withColumn(STATE_DIRECTORY, state), path, format)


def write_processed(df: DataFrame, path: str, spec: PanelSpec = SHEET, *, format: str = "csv",
                    keep_absent_states: bool = True) -> set[str]:
    """One directory per state, files in output order; returns the states written.

    With ``keep_absent_states`` the data of states without any row in ``df`` is
    left untouched, so an empty result never replaces published output.
    """
    return stage_processed(df, path, spec, format=format).swap(None if keep_absent_states else lambda absent: absent)


def stages_of(df: DataFrame, targets: dict[str, str], spec: PanelSpec = SHEET, *, format: str = "csv"
              ) -> list[Callable[[], Staged]]:
    """What stages each state below its target path; states sharing a path are written together."""
    by_path: dict[str, list[str]] = {}
    for state, path in targets.items():
        if path:
            by_path.setdefault(path, []).append(state)

    def stage(path: str, states: list[str]) -> Callable[[], Staged]:
        return lambda: stage_processed(df.where(F.col(f"`{spec.state}`").isin(*states)), path, spec, format=format)

    return [stage(*item) for item in by_path.items()]


def publish(df: DataFrame, targets: dict[str, str], spec: PanelSpec = SHEET, *, format: str = "csv") -> set[str]:
    """Write each state below its target path, all or none; returns the states written.

    A state without rows keeps what it has published.
    """
    return set().union(*[s.swap() for s in commit(stages_of(df, targets, spec, format=format))])


def stage_report(df: DataFrame, path: str, state: str = "State", *, format: str = "csv") -> Staged:
    return Staged(df.withColumn(STATE_DIRECTORY, F.col(f"`{state}`")), path, format)


def among(checked: DataFrame) -> Callable[[set[str]], list[str]]:
    """Of given states those in the first column of ``checked``."""
    column = F.col(f"`{checked.columns[0]}`")

    def find(states: set[str]) -> list[str]:
        # at most one row per directory
        return [r[0] for r in checked.where(column.isin(*states)).distinct().collect()] if states else []

    return find


def write_report(df: DataFrame, path: str, state: str = "State", *, format: str = "csv",
                 checked: DataFrame | None = None) -> set[str]:
    """One directory per state with findings; reports of an earlier run on these states are replaced.

    ``checked`` has the states looked at in its first column: those that have a report here but no
    finding now lose it.  Other states keep theirs.
    """
    return stage_report(df, path, state, format=format).swap(None if checked is None else among(checked))
