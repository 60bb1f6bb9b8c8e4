"""The chain of transforms for each state."""

from __future__ import annotations

import contextvars
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from rollcall.functions.cells import tidy_text
from rollcall.functions.lineage import settle
from rollcall.operators import (carry, collapse, densify, entity, markers, ordering, peers,
                                statewise, standardize, unreset)
from rollcall.spec import SHEET, PanelSpec

Step = Callable[[DataFrame], DataFrame]

# Which states share a chain.
PLAIN = ("CT", "DC", "GA", "ID", "IN", "MA", "MD", "MI", "MO", "MS", "NV", "NY", "OH", "OK",
         "RI", "SC", "TX", "WV")
CLOSING = ("AR", "HI", "IA", "KS", "NM", "TN", "UT", "VT", "WI")
COLLAPSING = ("CO", "IL", "ME", "OR", "VA")
MERGING = ("DE", "ND")
MARKED = ("LA", "PA")
CHAINS: dict[str, tuple[str, ...]] = {
    "plain": PLAIN, "closing": CLOSING, "looked_up_twice": ("NC",), "collapsing": COLLAPSING,
    "merging": MERGING, "merging_listed_types": ("CA",), "marked": MARKED,
    "dropping_empty": ("MN",), "florida": ("FL",), "kentucky": ("KY",),
    "new_jersey": ("NJ",), "wyoming": ("WY",),
}
ALL_STATES = tuple(sorted(s for states in CHAINS.values() for s in states))

# Fixed value: earlier reports of the NJ sheet are left out.
NJ_SINCE = 20201224


def special_steps(chain: str, spec: PanelSpec = SHEET, *, registry: DataFrame | None = None,
                  grid: Sequence[int] | None = None,
                  since: int = NJ_SINCE, carry_from: int = carry.CARRY_FROM,
                  reset: unreset.Reset = unreset.Reset()) -> list[tuple[str, Step]]:
    """Named steps of a chain between standardizing and finishing."""
    def step(f, **options) -> tuple[str, Step]:
        return f.__name__, partial(f, spec=spec, **options)

    close = step(densify.close_missing)
    collapse_add = step(collapse.collapse_adding)
    if chain == "plain":
        return []
    if chain == "closing":
        return [close]
    if chain == "looked_up_twice":
        again = [] if registry is None else [step(entity.add_entity_id, registry=registry)]
        return [*again, close]
    if chain == "collapsing":
        return [collapse_add]
    if chain == "merging":
        return [step(collapse.collapse_without_adding)]
    if chain == "merging_listed_types":
        return [step(collapse.collapse_without_adding, restrict_types=True)]
    if chain == "marked":
        return [step(markers.replace_no_data)]
    if chain == "dropping_empty":
        return [step(statewise.drop_empty_metrics)]
    if chain == "florida":
        return [step(statewise.clean_counties_fl), step(statewise.status_from_counts),
                ("drop_empty_content", statewise.drop_empty_content),
                step(peers.fill_types_from_peers), step(peers.fill_counties_from_peers),
                step(statewise.common_types), step(statewise.clear_federal_ids)]
    if chain == "kentucky":
        return [step(statewise.clean_counties_ky), step(unreset.undo_reset, reset=reset)]
    if chain == "new_jersey":
        return [close, step(statewise.since, first_date=since), collapse_add,
                step(carry.carry_closed_event, since=carry_from)]
    if chain == "wyoming":
        return [collapse_add, close, step(carry.sum_outbreaks, grid=grid)]
    raise ValueError(f"no chain named {chain}")


# Steps that read their input several times; their input is settled first.
REUSING = {"add_entity_id", "close_missing", "collapse_adding", "collapse_without_adding",
           "replace_no_data", "fill_types_from_peers", "fill_counties_from_peers", "undo_reset",
           "carry_closed_event", "sum_outbreaks", "finish"}

# Side outputs that hold rows set aside, and the tag of these rows.
ISSUES = {"bad_dates": standardize.BAD_DATE, "unknown_facilities": entity.UNKNOWN}
SIDE_OUTPUTS = (*ISSUES, "unmerged_slots", "early_leavers")


def run_chain(df: DataFrame, chain: str, spec: PanelSpec = SHEET, *,
              registry: DataFrame | None = None,
              grid: Sequence[int] | None = None, ordered: bool = False, standardized: bool = False,
              settling: bool = True, counts: dict[str, Observation] | None = None,
              states: Sequence[str] = (), side: dict[str, list[DataFrame]] | None = None,
              **options) -> DataFrame:
    """Standardize, run the special steps of ``chain``, finish.

    With ``settling`` the input of steps that read it several times is written out first;
    without, the chain is one lazy plan, for frames whose ordinals are already fixed.
    ``counts`` receives an observation with the rows after each step, in all and of each of ``states``;
    the rows before the first step are among them, as ``read``.

    ``side`` receives frames by kind (SIDE_OUTPUTS).  With it rows that have an unreadable date or an
    unknown facility are set aside instead of failing the chain: the step that notices tags them, rows are
    written once by tag, and the chain goes on with those that have none.
    """
    def seen(df: DataFrame, name: str) -> DataFrame:
        if counts is None:
            return df
        state = tidy_text(F.col(f"`{spec.state}`"))
        counts[name] = Observation(f"{name} {uuid.uuid4().hex}")
        return df.observe(counts[name], F.count(F.lit(1)).alias("rows"),
                          *[F.count_if(state == s).alias(f"rows of {s}") for s in states])

    def set_aside(tagged: DataFrame) -> DataFrame:
        rows = settle(tagged.withColumn("_issue", F.coalesce("_issue", F.lit("none"))), by="_issue")
        for kind, issue in ISSUES.items():
            side.setdefault(kind, []).append(rows.where(F.col("_issue") == issue).drop("_issue")
                                             .withColumnRenamed("_detail", "detail"))
        return rows.where("_issue = 'none'").drop("_issue", "_detail")

    first = [] if standardized else [("standardize", partial(
        standardize.standardize, spec=spec, registry=registry))]
    last = ("finish", partial(ordering.finish, spec=spec, grid=grid, ordered=ordered,
                              close_unknown_status=chain == "wyoming"))
    steps = [*first, *special_steps(chain, spec, registry=registry, grid=grid, **options), last]
    out = seen(df, f"{chain} - read")
    for i, (name, transform) in enumerate(steps):
        if settling and i > 0 and name in REUSING:
            out = settle(out)
        if side is not None and name == "standardize":
            out = set_aside(standardize.sort_out(out, spec, registry=registry))
        elif side is not None and name == "add_entity_id":
            untagged = out.withColumns({c: F.lit(None).cast("string") for c in ("_issue", "_detail")})
            out = set_aside(entity.set_aside_unknown(untagged, registry, spec))
        else:
            if side is not None and name in ("collapse_adding", "collapse_without_adding"):
                side.setdefault("unmerged_slots", []).append(collapse.collapse_diagnostics(out, spec))
            if side is not None and name == "undo_reset":
                side.setdefault("early_leavers", []).append(
                    unreset.early_leavers(out, spec, options.get("reset", unreset.Reset())))
            out = transform(out)
        out = seen(out, f"{chain} {i} {name}")
    return out


def process_states(df: DataFrame, states: Iterable[str] | None = None, spec: PanelSpec = SHEET, *,
                   settling: bool = True, **options) -> tuple[DataFrame, list[str]]:
    """Run every state's chain and put the results together.

    Returns the panel and the requested states that have no chain.  States sharing a chain run
    as one job, which reads only its own part of the settled input.
    """
    wanted = ALL_STATES if states is None else tuple(states)
    skipped = [s for s in wanted if s not in ALL_STATES]
    chosen = {chain: [s for s in members if s in wanted] for chain, members in CHAINS.items()}
    chosen = {chain: members for chain, members in chosen.items() if members}
    if not chosen:
        raise ValueError("none of the requested states has a chain")
    # looked up, so that the state's text is tidied once for all chains
    chains = F.create_map(*[F.lit(x) for chain, members in chosen.items() for s in members for x in (s, chain)])
    chain_of = F.try_element_at(chains, tidy_text(F.col(f"`{spec.state}`")))
    tagged = df.withColumn("_chain", chain_of).where(F.col("_chain").isNotNull())
    if settling:
        tagged = settle(tagged, by="_chain")
    def part_of(chain: str) -> DataFrame:
        return run_chain(tagged.where(F.col("_chain") == chain).drop("_chain"), chain, spec,
                         settling=settling, states=chosen[chain], **options)

    # chains do not wait for each other's written steps; their tables belong to the scope around
    run = inheritable_thread_target(tagged.sparkSession)(part_of)
    with ThreadPoolExecutor(len(chosen)) as pool:
        parts = list(pool.map(lambda context, chain: context.run(run, chain),
                              [contextvars.copy_context() for _ in chosen], chosen))
    panel = parts[0]
    for part in parts[1:]:
        panel = panel.unionByName(part, allowMissingColumns=True)
    return panel, skipped
