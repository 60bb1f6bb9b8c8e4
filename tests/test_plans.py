"""Shapes of physical plans, and hot groups really being spread."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from rollcall.functions import spread
from rollcall.operators import reconcile
from rollcall.plans import supplier_panel

SF = "/root/testdata/sf0.001"
SPEC = supplier_panel.SPEC


def explained(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@contextlib.contextmanager
def settings(spark, **conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(supplier_panel.QUERIES))
def test_no_product_and_no_python(spark, name):
    plan = explained(supplier_panel.QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert bad not in plan, plan


def test_scan_reads_only_needed_columns(spark):
    plan = explained(supplier_panel.fill_missing_dates(spark, SF))
    assert "l_extendedprice" not in plan and "l_orderkey" not in plan


def test_top_rows_are_cut_before_the_shuffle(spark):
    for q in (supplier_panel.recon_unmatched_top5, supplier_panel.recon_divergent):
        assert "WindowGroupLimit" in explained(q(spark, SF))


def test_filled_weeks_shuffle_no_rows(spark):
    df = spark.range(1000).select(
        F.concat(F.lit("S"), F.col("id") % 3).alias("State"), (F.col("id") % 10).alias("ctp_id"),
        (20200604 + (F.col("id") % 5)).cast("int").alias("Date"), F.lit("OPEN").alias("Outbrk_Status"),
        *[F.lit(1).alias(c) for c in supplier_panel.METRICS])
    from rollcall.operators.densify import fill_missing_dates
    plan = explained(fill_missing_dates(df, supplier_panel.SPEC))
    rows_side = plan[plan.index("LeftOuter"):].split("BroadcastExchange")[0]
    assert "Exchange" not in rows_side


def test_hot_group_is_spread(spark, monkeypatch):
    monkeypatch.setattr(spread, "HOT_ROWS", 500)
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 997).alias("k"), "id")
    facts = rows.groupBy("k").agg(F.count("id").alias("n"), F.min("id").alias("least"))
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                            "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        out = spread.attach(rows, facts, ["k"], count="n", salt=F.col("id"))
        held = (out.where("k = -1").groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert sum(r["count"] for r in held) == 10_000
        assert len(held) >= 6 and max(r["count"] for r in held) < 5_000
        assert out.where("k = -1 and least <> 0").count() == 0
        assert out.where("least is null").count() == 0 and out.count() == 30_000


def test_copies_of_a_row_are_spread_too(spark, monkeypatch):
    monkeypatch.setattr(spread, "HOT_ROWS", 100)
    rows = spark.range(4_000).select(F.lit("same").alias("k"), F.lit(1).alias("v"), F.col("id").alias("_ord"))
    facts = rows.groupBy("k").agg(F.count("v").alias("n"), F.sum("v").alias("total"))
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                            "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        out = spread.attach(rows, facts, ["k"], count="n", salt=F.col("_ord"))
        assert out.groupBy(F.spark_partition_id()).count().count() >= 6
        assert out.where("total <> 4000").count() == 0


def test_skewed_reconciliation_is_split(spark):
    """A hot (week, id) on the national side is split at run time; rows without id never shuffle together."""
    nat = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "w").otherwise(F.concat(F.lit("w"), F.col("id"))).alias("ctp_cms_week"),
        F.when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.lit("1")).alias("ctp_cms_id"),
        F.col("id").alias("v"))
    fed = spark.createDataFrame([("w", "1"), ("w2", "1"), ("x", "9")],
                                "cms_week string, cms_federal_provider_number string")
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB"}):
        out = reconcile.match_outer(fed.repartition(4), nat.repartition(8))
        assert out.count() == 60_001
        out = reconcile.match_outer(fed.repartition(4), nat.repartition(8))
        assert out.where("cms_week is not null and ctp_cms_week is not null").count() == 20_001
        out.collect()
        assert "skew=true" in explained(out)


def test_hot_entity_from_many_tasks_has_few_chunks(spark, monkeypatch):
    """Summary rows of a hot entity follow its rows, not the tasks its rows came from."""
    monkeypatch.setattr(spread, "CHUNK_BITS", 10)
    rows = spark.range(0, 20_000, 1, 500).select(
        F.lit("S").alias("State"), F.lit("E").alias("ctp_id"), F.lit(20210107).alias("Date"),
        (F.spark_partition_id().cast("bigint") * (1 << 33) + F.col("id")).alias("_ord"))
    chunked = spread.in_order(rows, SPEC)
    n = chunked.rows.select(*spread.SEGMENT).distinct().count()
    assert 20 <= n <= 20 + 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert chunked.cut.count() == 20_000
    seen = chunked.with_previous(["_ord"]).done("_prev", "_nth")
    assert seen.agg(F.max("_nth")).first()[0] == 20_000
    assert seen.where("_prev is null").count() == 1


@pytest.mark.parametrize("bits", [0, 1, 3, 20])
def test_scans_of_hot_and_ordinary_groups(spark, monkeypatch, bits):
    """Wherever chunks are cut, scans give what plain windows give; a missing key part is a key like any other."""
    monkeypatch.setattr(spread, "CHUNK_BITS", bits)
    group = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 97)
    rows = spark.range(3_000).select(
        F.when(group % 5 > 0, F.lit("S")).alias("State"), group.cast("string").alias("ctp_id"),
        (20210107 + F.col("id") % 7).cast("int").alias("Date"), F.col("id").alias("_ord"),
        F.when(F.col("id") % 4 > 0, F.col("id") % 11).alias("v"))
    tables = []
    for fits in (True, False):
        out = (spread.in_order(rows, SPEC, fits=fits).with_previous(["v"])
               .with_columns({"met": F.coalesce(F.col("_prev.v"), F.lit(0)) * F.col("_nth")})
               .with_sums({"total": F.col("met"), "thin": F.col("v")})
               .with_facts({"size": F.count(F.lit(1)), "last": F.max_by("_prev", "Date"), "least": F.min("v")}))
        tables.append(out.done("_prev.v", "_nth", "met", "total", "thin", "size", "least"))
    assert tables[0].exceptAll(tables[1]).isEmpty() and tables[0].count() == tables[1].count() == 3_000


def test_only_groups_that_were_cut_are_summarized(spark, monkeypatch):
    """Ordinary groups cost no summary: at most two segments a chunk, and no broadcast is forced."""
    monkeypatch.setattr(spread, "CHUNK_BITS", 10)
    rows = spark.range(40_000).select(F.lit("S").alias("State"), (F.col("id") % 10_000).alias("ctp_id"),
                                      F.lit(20210107).alias("Date"), F.col("id").alias("_ord"))
    scan = spread.in_order(rows, SPEC)
    chunks = scan.rows.select("_chunk").distinct().count()
    assert scan.cut.select(*spread.SEGMENT).distinct().count() <= 2 * chunks
    assert scan.cut.count() <= 4 * chunks
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        out = scan.with_previous(["_ord"]).done("_nth")
        assert out.where("_nth = 4").count() == 10_000
        assert "Broadcast" not in explained(out)


def test_slots_of_many_rows(spark, monkeypatch):
    monkeypatch.setattr(spread, "CHUNK_BITS", 1)
    rows = spark.range(9_000).select(
        F.when(F.col("id") % 3_000 > 0, F.lit("S")).alias("State"), (F.col("id") % 3_000).cast("string").alias("ctp_id"),
        F.lit(20210107).alias("Date"), F.col("id").alias("_ord"))
    slots = spread.add_slot_facts(rows, SPEC, {"size": F.count(F.lit(1))})
    assert slots.count() == 9_000 and slots.where("size != 3").count() == 0
