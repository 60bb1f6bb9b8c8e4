"""Rows that share an id and have unlike texts are documents of their own; no text is lost or mixed up."""

from __future__ import annotations

import hashlib

from rollcall.llm import lines, near, substrings

KIND = "doc_id bigint, text string, source string"


def page(name: str, n: int) -> str:
    return " ".join(f"{name}{k}" for k in range(n))


def told(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_lines(spark):
    shared = "one shared line here\nand the next of them"
    rows = [(1, f"{shared}\nfirst", "a"), (2, f"{shared}\nsecond", "b"), (2, "quite another\ntext under this id", "c"),
            (2, "quite another\ntext under this id", "d"), (3, f"third\n{shared}", "e"), (3, None, "f"), (None, "no id\nat all", "g")]
    got = told(lines.dedup(spark.createDataFrame(rows, KIND).repartition(4)).where("doc_id IS NOT NULL"))
    texts = {source: text for _, text, source in got}
    # of the three places of the shared lines one stays, and every other line stays where it was
    assert sum(t.count("one shared line here") for t in texts.values() if t) == 1
    assert "second" in texts["b"] and "first" in texts["a"] and "third" in texts["e"]
    assert texts["c"] == texts["d"] == "quite another\ntext under this id"


def test_substrings(spark):
    shared = page("w", 60)
    rows = [(1, f"{shared} tail", "a"), (2, f"head {shared}", "b"), (2, page("x", 60), "c"), (2, page("x", 60), "d"),
            (3, page("y", 60), "e"), (3, page("z", 70), "f")]
    got = told(substrings.report(spark.createDataFrame(rows, KIND).repartition(4))
               .select("doc_id", "n_words", "n_removed", "kept_sha256"))

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = [(1, 61, 60, sha("tail")), (2, 61, 60, sha("head")), (2, 60, 60, sha("")), (2, 60, 60, sha("")),
            (3, 60, 0, sha(page("y", 60))), (3, 70, 0, sha(page("z", 70)))]
    assert got == sorted(want, key=repr)


def test_near_keeps_unlike_rows_of_a_dropped_id(spark):
    rows = [(1, page("w", 200), "a"), (2, page("w", 200) + " more", "b"), (2, page("v", 90), "c"), (None, page("w", 200), "d"),
            (4, page("u", 80), "e"), (4, page("t", 80), "f")]
    for width in (2, 5):
        left = {r["source"] for r in near.keep_one(spark.createDataFrame(rows, KIND).repartition(3), width=width).collect()}
        assert left - {"a", "b"} == {"c", "d", "e", "f"}
        assert len(left & {"a", "b"}) == 1
