"""Joins and row-order scans that survive hot groups.

One entity, name or set of copies may hold a large share of all rows.  No function here
brings the rows of such a group into one task:

* ``attach`` joins rows with one fact row per group.  The rows of hot groups are spread over many
  shuffle partitions.
* ``InOrder`` looks back, sums up and aggregates over groups in row order.  Rows are range-sorted and
  cut into chunks, each chunk is scanned by itself, and one summary row per chunk carries the scan
  from chunk to chunk.
* ``dealt`` counts the rows of each group ahead.  Where none is larger than a chunk, the rows are dealt by
  group once and scanned where they lie; chunks are for inputs with a larger one.
"""

from __future__ import annotations

from collections.abc import Callable
from copy import copy

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions.cells import fingerprint
from rollcall.functions.lineage import settle
from rollcall.spec import PanelSpec

# ``attach`` spreads a group with this many rows.
HOT_ROWS = 1_000_000
# A chunk of sorted rows holds at most 2^CHUNK_BITS of them.
CHUNK_BITS = 20
# ``dealt`` gives a task about this many rows.
TASK_ROWS = 200_000


def attach(rows: DataFrame, facts: DataFrame, keys: list[str], *, count: str, salt: Column,
           how: str = "left", hot_rows: int | None = None, null_keys: bool = False,
           hot_facts: DataFrame | None = None) -> DataFrame:
    """Join each row with the fact row of its group.

    ``facts`` has one row per group: the keys, ``count`` (rows in the group, dropped from the
    result) and the facts.  ``salt`` is any integer that differs between the rows of a group.
    With ``null_keys`` a missing key part is a value like any other; else such rows get no fact.
    Facts that come from elsewhere need no ``count`` if ``hot_facts`` has those of ``busy`` groups with theirs.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    names = [c for c in facts.columns if c not in keys and c != count]
    out = rows.columns
    counted = facts if hot_facts is None else hot_facts
    if null_keys:  # a struct is never null
        whole = F.struct(*[F.col(f"`{k}`") for k in keys]).alias("_key")
        counted, rows = counted.select(whole, count, *names), rows.select("*", whole)
        facts, keys = facts.select(whole, *names), ["_key"]
    fact = F.struct(*[F.col(f"`{c}`") for c in names])
    hot = counted.where(F.col(count) >= hot_rows).select(*keys, fact.alias("_hot_fact"), F.col(count).alias("_hot_rows"))
    # about hot_rows rows per spot, however large the group is
    spots = F.ceil(F.col("_hot_rows") / F.lit(hot_rows)).cast("bigint")
    spot = F.when(F.col("_hot_fact").isNull(), F.lit(-1)).otherwise(
        F.pmod(F.xxhash64(salt), spots)).cast("bigint")
    # at most one row per hot_rows rows, so they are sent to the rows, which would else be shuffled for them
    spread_rows = rows.join(F.broadcast(hot), keys, "left").withColumn("_spot", spot)
    cold = facts.select(*keys, fact.alias("_fact"), F.lit(-1).cast("bigint").alias("_spot"))
    joined = spread_rows.join(cold, [*keys, "_spot"], "left")
    fact = F.coalesce("_hot_fact", "_fact")
    if how == "inner":
        joined = joined.where(fact.isNotNull())
    return joined.select(*[F.col(f"`{c}`") for c in out], *[fact.getField(c).alias(c) for c in names])


def busy(rows: DataFrame, facts: DataFrame, keys: list[str], *, count: str, hot_rows: int | None = None) -> DataFrame:
    """The facts of groups with many rows, with the ``count``.

    Rows are counted by a hash of their key, which is shorter; groups that clash only count as larger than they are.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    name = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
    many = rows.groupBy(name.alias("_name")).agg(F.count(F.lit(1)).alias(count)).where(F.col(count) >= hot_rows)
    # at most one for hot_rows rows
    return facts.withColumn("_name", name).join(F.broadcast(many), "_name").drop("_name")


def row_salt(df: DataFrame, spec: PanelSpec) -> Column:
    """The ordinal; in frames without one a hash of the row, which keeps exact copies together.

    Either gives the same value when a lost task runs again.
    """
    return F.col(spec.order) if spec.order in df.columns else fingerprint(df.columns, "salt")


def dealt(rows: DataFrame, keys: list[str]) -> DataFrame | None:
    """The rows with those of a group in one task; None if a group has more than 2^CHUNK_BITS rows.

    The number of tasks grows with the rows, as packed bytes, by which Spark would choose it, say little about them.
    """
    names = [F.col(f"`{k}`") for k in keys]
    sizes = (rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
             .agg(F.max("n").alias("most"), F.sum("n").alias("total")).first())
    if (sizes["most"] or 0) > 1 << CHUNK_BITS:
        return None
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-(sizes["total"] or 0) // TASK_ROWS))
    return rows.repartition(tasks, *names)


# the rows of one group in one chunk
SEGMENT = ["_group", "_chunk"]


class InOrder:
    """Rows of groups in row order, to which scans add columns.

    The rows are range-sorted by group and order and written, so that ``_place`` numbers them for good;
    a chunk is a run of at most 2^CHUNK_BITS places within a range partition, however many tasks the rows
    came from.  A group that continues in the next chunk is the last of one and the first of the other, so
    a chunk has at most two segments of such groups.  ``cut`` holds their rows: it is scanned ahead for
    the summaries that all rows are joined with, on segments, which are never larger than a chunk.

    With ``fits`` the caller promises that the rows of any group fit one task.  Then each group is one
    segment and nothing is carried.
    """

    def __init__(self, rows: DataFrame, keys: list[str], order: list[Column], *, fits: bool = False):
        self.columns = rows.columns
        if fits:
            self.rows, self.cut = rows, None
            self._segment, self._order = keys, order
            return
        by = [*[F.col(f"`{k}`").asc() for k in keys], *order]
        placed = settle(rows.repartitionByRange(*by).sortWithinPartitions(*by)
                        .withColumn("_place", F.monotonically_increasing_id()))
        # a struct is never null, so a missing key part is a value like any other
        self.rows = placed.withColumns({"_group": F.struct(*[F.col(f"`{k}`") for k in keys]),
                                        "_chunk": F.shiftright("_place", CHUNK_BITS)})
        self._segment, self._order = SEGMENT, [F.col("_place").asc()]
        # hashes will do here: a clash only takes along a segment of a group that was not cut
        key = F.xxhash64("_group")
        ends = self.rows.groupBy("_chunk").agg(F.array_distinct(F.array(
            F.min_by(key, "_place"), F.max_by(key, "_place"))).alias("ends"))
        several = F.count(F.lit(1)).over(Window.partitionBy("_key"))
        segments = (ends.select("_chunk", F.explode("ends").alias("_key")).withColumn("n", several)
                    .where("n > 1").select("_key", "_chunk"))
        self.cut = settle(self.rows.withColumn("_key", key).join(segments, ["_key", "_chunk"], "left_semi").drop("_key"))

    def _then(self, add: Callable[[DataFrame], DataFrame]) -> InOrder:
        """The same rows after ``add``, which must keep them."""
        out = copy(self)
        out.rows, out.cut = add(self.rows), None if self.cut is None else add(self.cut)
        return out

    def _carried(self, summary: dict[str, Column], along: dict[str, Column]) -> DataFrame:
        """Per segment of a group that was cut: ``along``, computed over the summaries of the group's segments."""
        return self.cut.groupBy(*SEGMENT).agg(*[s.alias(n) for n, s in summary.items()]).select(
            *SEGMENT, *[a.alias(n) for n, a in along.items()])

    def with_columns(self, columns: dict[str, Column]) -> InOrder:
        return self._then(lambda rows: rows.withColumns(columns))

    def with_previous(self, wanted: list[str]) -> InOrder:
        """Add ``_prev``, the struct of ``wanted`` of the group's previous row (null on the first), and
        ``_nth``, which counts its rows from 1."""
        here = F.struct(*[F.col(f"`{c}`") for c in wanted])
        inside = Window.partitionBy(*self._segment).orderBy(*self._order)
        local = {"_prev": F.lag(here).over(inside), "_nth": F.row_number().over(inside).cast("bigint")}
        if self.cut is None:
            return self.with_columns(local)
        chunks = Window.partitionBy("_group").orderBy("_chunk")
        before = self._carried(
            {"rows": F.count(F.lit(1)), "last": F.max_by(here, "_place")},
            {"_last": F.lag("last").over(chunks),
             "_rows": F.sum("rows").over(chunks.rowsBetween(Window.unboundedPreceding, -1))})
        return self._then(lambda rows: rows.withColumns(local).join(before, SEGMENT, "left").withColumns(
            {"_prev": F.coalesce("_prev", "_last"), "_nth": F.col("_nth") + F.coalesce("_rows", F.lit(0))})
            .drop("_last", "_rows"))

    def with_sums(self, amounts: dict[str, Column]) -> InOrder:
        """Add, per name in ``amounts``, the running sum over the group up to the current row."""
        inside = (Window.partitionBy(*self._segment).orderBy(*self._order)
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        local = {n: F.sum(a).over(inside) for n, a in amounts.items()}
        if self.cut is None:
            return self.with_columns(local)
        earlier = (Window.partitionBy("_group").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1))
        before = self._carried({n: F.sum(a) for n, a in amounts.items()},
                               {f"_before_{n}": F.sum(n).over(earlier) for n in amounts})
        # a sum over nothing but nulls is null, with or without earlier chunks
        both = {n: F.when(F.col(n).isNull(), F.col(f"_before_{n}"))
                .otherwise(F.col(n) + F.coalesce(f"_before_{n}", F.lit(0))) for n in amounts}
        return self._then(lambda rows: rows.withColumns(local).join(before, SEGMENT, "left").withColumns(both)
                          .drop(*[f"_before_{n}" for n in amounts]))

    def with_facts(self, facts: dict[str, Column]) -> InOrder:
        """Add aggregates over the row's whole group."""
        inside = Window.partitionBy(*self._segment)
        local = {n: f.over(inside) for n, f in facts.items()}
        if self.cut is None:
            return self.with_columns(local)
        whole = F.struct(*[F.col(n) for n in facts]).alias("_whole")
        told = self.cut.groupBy("_group").agg(*[f.alias(n) for n, f in facts.items()]).select("_group", whole)
        segments = self.cut.select(*SEGMENT).distinct().join(told, "_group")
        both = {n: F.when(F.col("_whole").isNull(), F.col(n)).otherwise(F.col("_whole").getField(n)) for n in facts}
        return self._then(lambda rows: rows.withColumns(local).join(segments, SEGMENT, "left").withColumns(both)
                          .drop("_whole"))

    def done(self, *added: str) -> DataFrame:
        """The rows with their own columns and those named."""
        return self.rows.select(*[F.col(f"`{c}`") for c in self.columns], *added)


def in_order(rows: DataFrame, spec: PanelSpec, *, fits: bool = False) -> InOrder:
    """The rows of each entity by date, then ordinal."""
    return InOrder(rows, list(spec.entity_key), [F.col(spec.date).asc_nulls_last(), F.col(spec.order).asc()], fits=fits)


def by_entity(rows: DataFrame, spec: PanelSpec, *, fits: bool = False) -> InOrder:
    """``in_order`` in chunks only where an entity has more rows than one."""
    whole = rows if fits else dealt(rows, spec.entity_key)
    return in_order(rows if whole is None else whole, spec, fits=whole is not None)


def add_slot_facts(rows: DataFrame, spec: PanelSpec, facts: dict[str, Column]) -> DataFrame:
    """Add aggregates over each row's (state, entity, date) slot."""
    whole = dealt(rows, spec.entity_key)
    slots = InOrder(rows if whole is None else whole, list(spec.slot_key), [F.col(spec.order).asc()],
                    fits=whole is not None)
    return slots.with_facts(facts).done(*facts)
