"""Licence scan (operator 7) by a trained classifier of passages, confirmed by templates.

Paragraphs end at blank lines, and a notice may be wrapped over lines or stand between other lines of its
paragraph.  So the passages looked at are all runs of neighbouring lines of a paragraph, joined: single lines
of any length, and longer runs as far as the template's pairs lie within ``WIDEST`` words of the first line's
start.  Features are hashed 1- and 2-grams of words, scaled to length 1.  A multinomial logistic regression
with one class per licence family and a class ``unknown`` is fitted by follow-the-regularised-leader: families
learn from variants of their templates (words dropped or put between, words put around them), ``unknown`` from
a bounded sample of the corpus' own passages of one to four lines in paragraphs that match no template.  The temperature is
calibrated on rows kept out of training, so the probability of ``unknown`` is calibrated too.  A family is
reported when its probability reaches ``threshold`` and at least ``similarity`` of the word 2-grams of one of
its templates stand in the passage.

Both must hold, so the cheaper comparison goes first: passages that hold enough of a template are found in all
paragraphs of all documents, and these are classified, whole.  Of passages that begin alike only those are
taken whose last line adds a word pair of the template.

Defined results: ``n_paragraphs`` counts lines that are not blank; ``n_licensed`` counts notices, where
passages of a family that share a line are one notice; null and empty texts have no paragraphs; of equal
probabilities the first family by name wins; repeated rows each get their own result; an empty table
gives an empty table; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm import ftrl
from rollcall.llm.tasks import as_bytes, by_arrow, lowest, sent
from rollcall.llm.words import U64, hashed, mixed

FEATURES = 1 << 15
UNKNOWN = "unknown"
WIDEST = 200  # words

# fixed values: notices by which works usually name their licence
TEMPLATES = {
    "AGPL": ["licensed under the GNU Affero General Public License, version 3.",
             "This program is free software under the terms of the GNU Affero General Public License."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "You may obtain a copy of the Apache License at http://www.apache.org/licenses/LICENSE-2.0"],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted.",
            "Released under the BSD 3-Clause License.", "Licensed under the BSD 2-Clause License."],
    "CC-BY": ["Licensed under CC BY 4.0.",
              "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.",
                 "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.",
                 "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0": ["Released under CC0 1.0 Universal.", "dedicated to the public domain under CC0 1.0"],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.",
            "This program is free software under the terms of the GNU General Public License."],
    "ISC": ["Released under the ISC License."],
    "LGPL": ["licensed under the GNU Lesser General Public License, version 3.",
             "This program is free software under the terms of the GNU Lesser General Public License."],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
FAMILIES = [UNKNOWN, *sorted(TEMPLATES)]

_WORD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 or b in b"." else 32
              for b in range(256))


def words_of(paragraph: bytes) -> list[bytes]:
    """Lower-case words; a dot stays inside a word only, so version numbers are words."""
    return [w for w in (x.strip(b".") for x in paragraph.translate(_WORD).split()) if w]


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and of neighbouring pairs."""
    h = hashed(words)[:, 0]
    return h, mixed(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + mixed(h[1:] + np.uint64(1)))


def row(words: list[bytes]) -> ftrl.Row:
    at = np.unique((np.concatenate(grams(words)) % np.uint64(FEATURES)).astype(np.int64))
    return at, np.full(len(at), 1 / np.sqrt(max(1, len(at))))


def template_pairs() -> dict[str, list[np.ndarray]]:
    return {f: [np.unique(grams(words_of(t.encode()))[1]) for t in texts] for f, texts in TEMPLATES.items()}


def paragraphs_of(raw: bytes) -> list[list[bytes]]:
    """Lines of each paragraph; blank lines stand between paragraphs."""
    out, open_ = [], False
    for x in raw.split(b"\n"):
        if not x.strip():
            open_ = False
        elif open_:
            out[-1].append(x)
        else:
            out.append([x])
            open_ = True
    return out


def passages(lines: list[list[bytes]], paragraph: np.ndarray, pairs: dict[str, list[np.ndarray]], similarity: float
             ) -> list[tuple[str, int, int, float]]:
    """(family, first line, last line, likeness) of runs of lines that hold enough of a template.

    ``lines`` are words, ``paragraph`` numbers the paragraph of each line.
    """
    sizes = np.array([len(w) for w in lines], np.int64)
    if sizes.sum() < 2:
        return []
    two = grams([x for w in lines for x in w])[1]
    line = np.repeat(np.arange(len(lines)), sizes)
    begin = np.cumsum(sizes) - sizes
    known = np.unique(np.concatenate([p for texts in pairs.values() for p in texts]))
    place = np.minimum(np.searchsorted(known, two), len(known) - 1)
    at = np.flatnonzero((known[place] == two) & (paragraph[line[:-1]] == paragraph[line[1:]]))
    found = []
    fewest = min(similarity * len(p) for texts in pairs.values() for p in texts)
    for part in np.split(at, np.flatnonzero(np.diff(paragraph[line[at]])) + 1):
        if len(part) < fewest:
            continue
        for family, texts in pairs.items():
            for p in texts:
                mine = part[np.isin(two[part], p)]
                if len(np.unique(two[mine])) / len(p) < similarity:
                    continue
                for first in np.unique(line[mine]).tolist():
                    end = begin[first] + max(sizes[first], WIDEST)
                    here = mine[np.searchsorted(mine, begin[first]):np.searchsorted(mine, end)]
                    lasts = np.sort(line[here[np.unique(two[here], return_index=True)[1]] + 1])
                    for last in np.unique(lasts).tolist():
                        alike = float(np.searchsorted(lasts, last, side="right")) / len(p)
                        if alike >= similarity:
                            found.append((family, first, last, alike))
    return found


class Model:
    """Class weights on hashed grams; paragraphs of many documents are classified at once."""

    def __init__(self, weights: np.ndarray, temperature: float):
        self.weights, self.temperature = weights.astype(np.float32), temperature

    def probabilities(self, paragraphs: list[list[bytes]]) -> np.ndarray:
        """Each gram counts as often as it occurs; paragraphs must have words."""
        sizes = np.array([len(p) for p in paragraphs])
        h = hashed([w for p in paragraphs for w in p])[:, 0]
        ends = np.cumsum(sizes)
        two = mixed(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + mixed(h[1:] + np.uint64(1)))
        one, two = ((x % np.uint64(FEATURES)).astype(np.int64) for x in (h, two))
        sums = self.weights[one]
        inside = np.ones(len(two), bool)
        inside[ends[:-1] - 1] = False  # no pair across paragraphs
        sums[:-1][inside] += self.weights[two[inside]]
        raw = np.add.reduceat(sums, ends - sizes, axis=0) / np.sqrt(2 * sizes - 1)[:, None]
        return ftrl.softmax(raw.astype(float) / self.temperature)


def fit(docs: DataFrame, *, text: str = "text", sample: int = 3000, variants: int = 60, seed: int = 1) -> Model:
    """Learn families from templates and ``unknown`` from ``sample`` passages of ``docs``."""
    def units(slices):
        pairs = template_pairs()
        for rows in slices:
            held = [lines for (raw,) in rows for lines in paragraphs_of(raw)]
            paragraph = np.repeat(np.arange(len(held)), [len(lines) for lines in held])
            some = passages([words_of(x) for lines in held for x in lines], paragraph, pairs, 0.5)
            noticed = {paragraph[first] for _, first, _, _ in some}  # their other lines may be parts of a notice, too
            yield {"passage": [b"\n".join(lines[k:k + 1 + xxhash.xxh3_64_intdigest(x) % 4]).decode()
                               for n, lines in enumerate(held) if n not in noticed for k, x in enumerate(lines)]}

    drawn = sorted(lowest(by_arrow(docs.select(as_bytes(text).alias("text")), units, "passage string"), sample,
                          key="passage").select("passage").collect())
    rng = np.random.default_rng(seed)
    others = [w for w in (words_of(r["passage"].encode()) for r in drawn) if w] or [[b"the"]]
    filler = [x for w in others[:300] for x in w]
    rows, labels = [row(w) for w in others], [0] * len(others)
    for label, family in enumerate(FAMILIES[1:], 1):
        for text_ in TEMPLATES[family]:
            base = words_of(text_.encode())
            for k in range(variants):
                words = base if k < variants // 3 else [w for w in base if rng.random() > 0.08] or base
                if k % 3 == 2:
                    around = [filler[j] for j in rng.integers(0, len(filler), int(rng.integers(1, 12)))]
                    cut = int(rng.integers(0, len(around) + 1))
                    words = around[:cut] + words + around[cut:]
                if k % 6 == 5:  # as in longer forms of a notice
                    more = [filler[j] for j in rng.integers(0, len(filler), int(rng.integers(1, 30)))]
                    cut = int(rng.integers(0, len(words) + 1))
                    words = words[:cut] + more + words[cut:]
                rows.append(row(words))
                labels.append(label)
    return Model(*ftrl.fit(rows, labels, FEATURES, len(FAMILIES), seed=seed, epochs=4, alpha=1.0, l1=1e-4, l2=1e-4))


def scan(docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5,
         similarity: float = 0.7) -> DataFrame:
    """doc_id, n_paragraphs, n_licensed, families (names joined by commas), score (of the surest), similarity."""
    shipped = sent(docs.sparkSession, model)

    def work(slices):
        here = cloudpickle.loads(shipped.value)
        pairs = template_pairs()
        for rows in slices:
            out = {"doc_id": [i for i, _ in rows], "n_paragraphs": [], "n_licensed": [0] * len(rows),
                   "families": [], "score": [0.0] * len(rows), "similarity": [0.0] * len(rows)}
            found: list[set[str]] = [set() for _ in rows]
            owner, paragraph, lines = [], [], []
            for n, (_, raw) in enumerate(rows):
                before = len(lines)
                for some in paragraphs_of(raw):
                    number = paragraph[-1] + 1 if paragraph else 0
                    lines += map(words_of, some)
                    owner += [n] * len(some)
                    paragraph += [number] * len(some)
                out["n_paragraphs"].append(len(lines) - before)
            some = passages(lines, np.array(paragraph, np.int64), pairs, similarity)
            spans = sorted({(first, last) for _, first, last, _ in some})
            surest = {}
            for at in range(0, len(spans), 4096):
                part = spans[at:at + 4096]
                p = here.probabilities([[x for w in lines[a:b + 1] for x in w] for a, b in part])
                best = p[:, 1:].argmax(axis=1) + 1
                surest |= {s: (FAMILIES[k], float(v[k])) for s, k, v in zip(part, best, p)}
            taken: dict[str, set[int]] = {}
            for family, first, last, alike in sorted(some, key=lambda x: (x[2] - x[1], x[1], -x[3])):
                likely, score = surest[first, last]
                if likely != family or score < threshold:
                    continue
                n = owner[first]
                found[n].add(family)
                out["score"][n] = max(out["score"][n], score)
                out["similarity"][n] = max(out["similarity"][n], alike)
                held = taken.setdefault(family, set())
                if held.isdisjoint(range(first, last + 1)):
                    held.update(range(first, last + 1))
                    out["n_licensed"][n] += 1
            out["families"] = [",".join(sorted(f)) for f in found]
            yield out

    return by_arrow(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), as_bytes(text).alias("text")), work,
                    f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n_paragraphs bigint, n_licensed bigint, "
                    "families string, score double, similarity double")


def report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    return scan(docs, fit(docs, text=text), doc_id=doc_id, text=text)
