"""Columns of users come back as they were, whatever their names."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rollcall.llm import decontaminate, lines, mixing, near, quality

NAMES = ("_doc", "_kept", "_gone", "_judged", "_quality", "_key", "_copies", "user", "doc", "kept", "score", "judged",
         "key", "copies", "id", "gone", "row", "packed", "place", "size", "nth")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, f"a{k} b{k} c{k} d{k} e{k} f{k}\nshared line of {k % 3} words here\nanother one {k}", "en", f"s{k % 2}", 60)
            for k in range(30)]
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    extra = {n: F.concat(F.lit(f"{n} "), "doc_id") for n in NAMES}
    return spark.createDataFrame(rows, kind).withColumns(extra).repartition(3)


def test_they_survive_every_stage(spark, docs):
    labels = spark.createDataFrame([(k, int(k % 2)) for k in range(30)], "doc_id bigint, quality int")
    items = spark.createDataFrame([("x", "a3 b3 c3 d3 e3 f3")], "item_id string, text string")
    stages = {
        "lines": lines.dedup(docs), "near": near.keep_one(docs, width=5),
        "decontaminate": decontaminate.decontaminate(docs, items),
        "spans": decontaminate.decontaminate(docs, items, remove="span"),
        "quality": quality.accepted(docs, labels, threshold=0.0), "mix": mixing.emit(docs).drop("mix_copy")}
    for name, out in stages.items():
        assert out.dtypes == docs.dtypes, name
        got = out.collect()
        assert got and all(r[n] == f"{n} {r['doc_id']}" for r in got for n in NAMES), name


def test_labels_of_other_kinds(spark, docs):
    """Any label but 1 is negative; labels of one kind give that kind's share as score."""
    two = spark.createDataFrame([(k, 2 * (k % 2)) for k in range(30)], "doc_id bigint, quality int")
    assert {r["score"] for r in quality.report(docs, two).collect()} == {0.0}
