"""The pipeline against a plain one on planted rows."""

from __future__ import annotations

import random

import brute
import corpus_pipeline
import pytest
from rollcall.llm import lines, quality

KIND = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng = random.Random(21)
    good = [f"word{k}" for k in range(400)]
    items = [(k, " ".join(rng.choices(good, k=30))) for k in range(5)]
    block = "\n".join(" ".join(rng.choices(good, k=8)) for _ in range(30))
    rows, labels = [], []
    for k in range(300):
        lines_ = [" ".join(rng.choices(good, k=10)) for _ in range(rng.randint(4, 12))]
        text = "\n".join(lines_)
        if k % 6 == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        elif k % 20 == 1:
            text = text + "\n" + block
        elif k % 20 == 3 and rows:
            text = rows[-2][1]
        elif k % 20 == 5:
            text = text + " " + items[k % 5][1]
        rows.append((k, text, "en", f"s{k % 3}", len(text)))
        labels.append((k, int(k % 6 != 0), 0))
    rows += [(300, None, None, None, None), (301, "", "en", "s0", 0), (None, "word1 word2 word3", None, "s1", 17)]
    folder = str(tmp_path_factory.mktemp("planted"))
    spark.createDataFrame(rows, KIND).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id int, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def by_id(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_stages_against_plain_ones(spark, planted):
    folder, rows, items = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near", "decontaminate", "mix"]

    kept = stages["quality"](spark, docs, folder)
    model = quality.trained(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    scores = {r[0]: model.score([(r[1] or "").encode()])[0] for r in rows}
    assert set(by_id(kept)) == {i for i, s in scores.items() if s >= 0.7}
    assert {r[0] for r in rows[:300] if r[0] % 6} <= set(by_id(kept))
    assert not {r[0] for r in rows[:300] if r[0] % 6 == 0} & set(by_id(kept))

    before = by_id(kept)
    cut = stages["lines"](spark, kept, folder)
    numbered = {(-1 if i is None else i): t for i, t in before.items()}
    want = brute.repeated_lines_removed([(i, t) for i, t in numbered.items() if i >= 0])
    got = by_id(cut)
    for i, t in want.items():
        if t == (before[i] or ""):
            assert got[i] == before[i]
        else:
            assert got.get(i) == (t if t.strip() else None)

    single = stages["near"](spark, cut, folder)
    assert set(by_id(single)) == {i for i, _, _, keep in brute.groups(
        [(i, t) for i, t in got.items() if i is not None]) if keep} | ({None} & set(got))

    clean = stages["decontaminate"](spark, single, folder)
    assert set(by_id(clean)) == {r[0] for r in brute.contaminated(by_id(single).items(), items) if not r[-1]}
    for stage in (kept, cut, single, clean):
        assert stage.columns == docs.columns


def test_run(spark, planted):
    folder, _, _ = planted
    first, again = (sorted((r["doc_id"] or -1, r["mix_copy"]) for r in corpus_pipeline.run(spark, folder).collect())
                    for _ in range(2))
    assert first == again and first


def test_empty_corpus(spark, planted, tmp_path):
    folder, _, _ = planted
    docs = spark.createDataFrame([], KIND)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0
