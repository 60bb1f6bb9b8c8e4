"""The whole job where an earlier version did a part of it."""

from __future__ import annotations

import random
import textwrap

import corpus_pipeline
from rollcall.llm import licences, lines, near

KIND = "doc_id bigint, text string"


def numbered(rng, n, tag):
    return [f"{tag} {k} {rng.random()}" for k in range(n)]


def test_exact_copies_are_emptied_whatever_their_length():
    rng = random.Random(31)
    for n in range(2, 40):
        for blanks in (0, 3):
            text = numbered(rng, n, "line")
            for _ in range(blanks):
                text.insert(rng.randrange(len(text)), "  ")
            assert all(full > 1 for _, _, _, full in lines.chunks("\n".join(text).encode()))


def test_repeated_passages_go_as_a_whole(spark):
    """The passage stands among other lines in each document; all of it goes but the first, and no line else."""
    rng = random.Random(32)
    passages = [numbered(rng, 12, f"p{k}") for k in range(20)]
    rows, want = [], {}
    for k in range(60):
        own = numbered(rng, rng.randint(2, 8), f"own{k}")
        at = rng.randint(0, len(own))
        rows.append((k, "\n".join(own[:at] + passages[k % 20] + own[at:])))
        want[k] = "\n".join(own if k >= 20 else own[:at] + passages[k] + own[at:])
    docs = spark.createDataFrame(rows, KIND).repartition(3)
    got = {r["doc_id"]: r["text"] for r in lines.dedup(docs).collect()}
    assert got == want
    counts = {r["doc_id"]: r["n_removed_lines"] for r in lines.report(docs).collect()}
    assert counts == {k: 12 * (k >= 20) for k in range(60)}


def header(name):
    return (f"This program is free software: you can redistribute it and/or modify it under the terms of the {name} as "
            "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
            "version.")


HEADERS = {"GPL": header("GNU General Public License"), "AGPL": header("GNU Affero General Public License"),
           "LGPL": header("GNU Lesser General Public License"),
           "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  "associated documentation files (the \"Software\"), to deal in the Software without restriction.",
           "MPL": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                  "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."}


def test_wrapped_notices(spark):
    rng = random.Random(33)
    pool = [f"w{k}" for k in range(60)]

    def prose(n):
        return "\n".join(" ".join(rng.choices(pool, k=10)) for _ in range(n))

    rows, want = [(k, prose(8) + "\n\n" + prose(5), ) for k in range(40)], {k: "" for k in range(40)}
    for family, text in HEADERS.items():
        for width, mark in ((70, ""), (40, " * "), (24, "# ")):
            notice = "\n".join(mark + x for x in textwrap.wrap(text, width))
            for whole in (notice, prose(3) + "\n\n" + notice + "\n\n" + prose(2), prose(3) + "\n" + notice + "\n" + prose(3)):
                want[len(rows)] = family
                rows.append((len(rows), whole))
    apart = "This program is free software\n\nunder the terms\n\nof the GNU General\n\nPublic License"
    want[len(rows)] = ""
    rows.append((len(rows), apart))
    got = {r["doc_id"]: r for r in licences.report(spark.createDataFrame(rows, KIND).repartition(3)).collect()}
    assert {k: r["families"] for k, r in got.items()} == want
    assert all(r["n_licensed"] == bool(want[k]) for k, r in got.items())


def five_word_groups(rows, least=80):
    """Plain version over five-word shingles: {id: smallest id of its group}."""
    sets = {}
    for i, t in rows:
        w = t.lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets
             if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])]
    while any(label[a] != label[b] for a, b in links):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_near_stage_links_on_five_words(spark):
    """Scattered edits leave 80 % of the word pairs, but not of the runs of five words."""
    rng = random.Random(34)
    rows = []
    for k in range(12):
        base = [f"v{k}x{j}" for j in range(100)]
        for edits in (0, 2, 4, 5):
            w = list(base)
            for at in range(edits):
                w[10 + at * 18] = f"e{rng.random()}"
            rows.append((len(rows), " ".join(w)))
    rows += [(900, "a b c"), (901, "A b c"), (902, "b c"), (903, "one"), (904, "")]
    docs = spark.createDataFrame(rows, KIND).repartition(3)
    want = five_word_groups(rows)
    got = {r["doc_id"]: r["component_id"] for r in near.groups(docs, width=5).collect()}
    assert got == want
    kept = {r["doc_id"] for r in corpus_pipeline.near_stage(spark, docs, "").collect()}
    assert kept == {i for i, c in want.items() if c == i}
    assert kept > {r["doc_id"] for r in near.groups(docs).where("kept").collect()}
