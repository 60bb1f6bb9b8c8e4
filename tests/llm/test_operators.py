"""Each corpus operator against its plain version or a round trip, with the awkward rows every one must bear."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
import oracle
from rollcall.llm import (contextmix, decontaminate, language, licences, lines, mixing, near, quality,
                          queries, substrings, syncmers)
from rollcall.llm import oracle as sql
from rollcall.llm.words import Rolling

SF = "/root/testdata/sf0.001"
KIND = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASH = ", doc string, id int, _doc int, packed string, place int, size int, score string, nth int"


def corpus(seed=1, n=60, vocabulary=40, longest=160):
    """Random texts with copies, near copies, shared passages and the awkward ones."""
    rng = random.Random(seed)
    pool = [f"w{k}" if k % 3 else f"W{k}é" for k in range(vocabulary)]
    passage = " ".join(rng.choices(pool, k=50))
    block = "\n".join(" ".join(rng.choices(pool, k=6)) for _ in range(24))
    texts = []
    for k in range(n):
        t = "\n".join(" ".join(rng.choices(pool, k=rng.randint(1, 12))) for _ in range(rng.randint(1, longest // 12)))
        if k % 5 == 1:
            t = t + " " + passage + "\t" + t[:40]
        if k % 5 == 2 and texts:
            t = rng.choice(texts)
        if k % 5 == 3 and texts:
            w = rng.choice(texts).split(" ")
            w[rng.randrange(len(w))] = "edited"
            t = " ".join(w)
        if k % 7 == 4:
            t = t + "\n" + block + "\n" + t
        texts.append(t)
    texts += ["", " \n\t ", "one", None, "one", "a b", passage * 40]
    return [(k, t, rng.choice(["en", "fr", None]), rng.choice(["a", "b", None]), len(t or "")) for k, t in enumerate(texts)]


def frame(spark, rows):
    """As ``documents`` with columns whose names operators use inside."""
    extra = ("x", 7, 7, "y", 7, 7, "z", 7)
    return spark.createDataFrame([(*r, *extra) for r in rows], KIND + CLASH).repartition(3)


def bag(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("name", sorted(sql.SQL))
def test_query_matches_sql(spark, name):
    assert oracle.compare(queries.QUERIES[name](spark, SF), oracle.connect(SF), sql.SQL[name]) is None


def test_cover_meets_every_shift():
    for shift in range(substrings.PERIOD):
        assert any((c + shift) % substrings.PERIOD in substrings.COVER for c in substrings.COVER)


@pytest.mark.parametrize("length", [22, 35])
def test_substrings(spark, length):
    rows = corpus()
    got = bag(substrings.report(frame(spark, rows), length=length), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute.substrings([r[:2] for r in rows], length), key=repr)


def test_substrings_repeated_rows_and_batches(spark, monkeypatch):
    rows = corpus(2, 20)
    twice = rows + rows[:5]
    got = bag(substrings.report(frame(spark, twice).coalesce(1)), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute.substrings([r[:2] for r in twice], 35), key=repr)


def test_substrings_null_ids(spark):
    rows = [(None, "a " * 40, None, None, 0), (None, None, None, None, 0), (3, "b c", None, None, 3)]
    got = bag(substrings.report(frame(spark, rows)), "doc_id", "n_words", "n_removed")
    assert got == sorted([(None, 40, 40), (None, 0, 0), (3, 2, 0)], key=repr)


def items(rows):
    return [("i2", " ".join(brute.words(rows[1][1])[2:30])), ("i10", "w1 w2"), ("i3", "edited"), (None, "one"), ("i4", ""),
            ("i5", None), ("i2", "w4 w5 w7"), ("i6", "zzz"), ("i7", " ".join(brute.words(rows[4][1])[:13]))]


@pytest.mark.parametrize("block_words", [250_000, 4])
def test_decontamination(spark, monkeypatch, block_words):
    monkeypatch.setattr(decontaminate.automata, "__kwdefaults__",
                        decontaminate.automata.__kwdefaults__ | {"block_words": block_words})
    rows = corpus(3)
    named = [("null" if i is None else i, t) for i, t in items(rows)]
    bench = spark.createDataFrame(items(rows), "item_id string, text string")
    got = bag(decontaminate.report(frame(spark, rows), bench),
              "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == sorted(brute.contaminated([r[:2] for r in rows], named), key=repr)


def test_benchmark_of_long_and_repeated_items(spark):
    """Items cut into pieces and items given many times lose no window and gain none."""
    rng = random.Random(41)
    pool = [f"w{k}" for k in range(30)]
    long = " ".join(rng.choices(pool, k=900))
    items = [(1, long), (2, " ".join(rng.choices(pool, k=13))), (3, "w1 w2"), (4, "w3"), (5, None), (6, " .")]
    items += [(7, " ".join(rng.choices(pool, k=40)))] * 30
    words = long.split(" ")
    rows = [(k, " ".join(rng.choices(pool, k=5) + words[at:at + n]), None, None, 0)
            for k, (at, n) in enumerate((rng.randint(0, 880), rng.randint(10, 40)) for _ in range(80))]
    bench = spark.createDataFrame(items, "item_id int, text string")
    want = {r[0]: r[1:4] for r in brute.contaminated([r[:2] for r in rows], items)}
    for piece_words in (1, 7, 200):
        blocks = decontaminate.automata(bench, block_words=300, piece_words=piece_words)
        got = frame(spark, rows).select("doc_id", decontaminate.judged(F.col("text"), blocks).alias("v")).collect()
        assert {r["doc_id"]: (r["v"]["n_words"], r["v"]["n_hit"], len(r["v"]["items"])) for r in got} == want


def test_decontaminated_corpus(spark):
    rows = corpus(3)
    named = [("null" if i is None else i, t) for i, t in items(rows)]
    bench = spark.createDataFrame(items(rows), "item_id string, text string")
    docs = frame(spark, rows)
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    clean = {r[0] for r in brute.contaminated([r[:2] for r in rows], named) if not r[-1]}
    assert {r["doc_id"] for r in kept.collect()} == clean
    cut = decontaminate.decontaminate(docs, bench, remove="span")
    assert cut.count() == len(rows)
    again = decontaminate.report(cut.where(~F.col("doc_id").isin(list(clean))), bench)
    assert again.agg(F.sum("n_words")).first()[0] < sum(
        r[1] for r in brute.contaminated([r[:2] for r in rows], named) if r[0] not in clean)


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_groups(spark, seed):
    rows = corpus(seed, 80, longest=60)
    got = bag(near.groups(frame(spark, rows)), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(brute.groups([r[:2] for r in rows]), key=repr)


def test_groups_around_a_centre(spark):
    """Copies that each change other words are alike to their source only, and some not even to that."""
    rng = random.Random(7)
    base = [f"v{k}" for k in range(120)]
    rows = []
    for k in range(60):
        w = list(base)
        for at in rng.sample(range(120), rng.choice([0, 3, 6, 9, 14, 20])):
            w[at] = f"x{rng.randrange(30)}"
        rows.append((500 - k, " ".join(w), None, None, 0))
    got = bag(near.groups(frame(spark, rows)), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(brute.groups([r[:2] for r in rows]), key=repr)


def test_bound_never_hides_a_link():
    """What members lack of and add to a centre bounds their overlap from above."""
    rng = np.random.default_rng(8)
    for _ in range(200):
        centre = rng.integers(0, 2 ** 63, 60).astype(np.uint64)
        x, y = (np.unique(np.concatenate([rng.choice(centre, 45), rng.integers(0, 2 ** 63, 10).astype(np.uint64)]))
                for _ in range(2))
        both = len(np.intersect1d(x, y))
        bound = len(np.unique(centre))
        for one, two in ((np.setdiff1d(centre, x), np.setdiff1d(centre, y)), (np.setdiff1d(x, centre), np.setdiff1d(y, centre))):
            a, b = near._bits(one), near._bits(two)
            over = [len(s) - sum(int(v).bit_count() if v >= 0 else (int(v) + 2 ** 64).bit_count() for v in m)
                    for s, m in ((one, a), (two, b))]
            shared = sum((int(p & q) % 2 ** 64).bit_count() for p, q in zip(a, b)) + min(over)
            bound += min(len(one), len(two), shared)
            if one is not None and len(np.intersect1d(one, centre)):
                bound -= len(one) + len(two)
        assert both <= bound


def test_sketch_likelihood_keeps_links():
    rng = np.random.default_rng(9)
    a, b, n = [], [], []
    for _ in range(300):
        shared = rng.integers(0, 2 ** 63, 160).astype(np.uint64)
        x, y = (np.concatenate([shared, rng.integers(0, 2 ** 63, 20).astype(np.uint64)]) for _ in range(2))
        a.append(near.registers(x))
        b.append(near.registers(y))
        n.append(180.0)
    assert near.likely(np.array(a), np.array(b), np.array(n), np.array(n), 0.8).all()
    c = [near.registers(rng.integers(0, 2 ** 63, 180).astype(np.uint64)) for _ in range(300)]
    assert not near.likely(np.array(a), np.array(c), np.array(n), np.array(n), 0.8).any()


def test_sketches_merge():
    rng = np.random.default_rng(10)
    x, y = (rng.integers(0, 2 ** 63, 100).astype(np.uint64) for _ in range(2))
    assert (near.registers(np.concatenate([x, y])) == np.maximum(near.registers(x), near.registers(y))).all()


def test_groups_without_ids_and_keep_one(spark):
    rows = [(None, "a b c", None, None, 0), (2, "a b c", None, None, 0), (1, "a b c", None, None, 0),
            (1, "a b c", None, None, 0), (5, "", None, None, 0), (6, "", None, None, 0)]
    docs = frame(spark, rows)
    assert bag(near.groups(docs), "doc_id", "component_id", "kept") == sorted(
        [(None, None, True), (2, 1, False), (1, 1, True), (1, 1, True), (5, 5, True), (6, 6, True)], key=repr)
    kept = near.keep_one(docs)
    assert kept.columns == docs.columns
    assert bag(kept, "doc_id") == sorted([(None,), (1,), (1,), (5,), (6,)], key=repr)


def test_components_of_chains(spark):
    links = [(k, k + 1) for k in range(10, 60)] + [(100, 101), (103, 101)]
    got = dict(map(tuple, near.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    assert got == {k: 10 for k in range(10, 61)} | {100: 100, 101: 100, 103: 100}


def test_lines(spark):
    rows = corpus(11, 80)
    docs = frame(spark, rows)
    want = brute.repeated_lines_removed([r[:2] for r in rows])
    got = {r["doc_id"]: r for r in lines.report(docs).collect()}
    assert {k: r["kept_sha256"] for k, r in got.items()} == {
        k: hashlib.sha256(t.encode()).hexdigest() for k, t in want.items()}
    assert any(r["n_removed_lines"] for r in got.values())
    kept = lines.dedup(docs)
    assert kept.columns == docs.columns
    texts = {r[0]: r[1] for r in rows}
    after = {r["doc_id"]: r for r in kept.collect()}
    for k, t in want.items():
        if t == (texts[k] or ""):
            assert after[k]["text"] == texts[k]
        elif t.strip():
            assert after[k]["text"] == t and after[k]["n_chars"] == len(t)
        else:
            assert k not in after


def test_lines_with_blanks_ties_and_long_texts(spark):
    """Repeats inside a text, blank lines, runs of equal lines, texts of one line and very long ones."""
    rng = random.Random(15)
    pool = ["alpha", "beta", "gamma", "", "  ", "delta é", "long " * 30]
    rows = [(k, "\n".join(rng.choices(pool, k=rng.randint(0, 14))) + rng.choice(["", "\n", "\n\n"]))
            for k in range(120)]
    rows += [(200, "same\n" * 5), (201, "same\n" * 9), (202, "same"), (203, None), (204, ""), (205, "\n \n")]
    long = "\n".join(f"line {rng.random()}" for _ in range(30_000))
    rows += [(300, long), (301, "head\n" + long[:400_000] + "\ntail of its own")]
    want = brute.repeated_lines_removed(rows)
    removed = lines.removed(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))
    got = {r["doc"]: r["kept"] for r in removed.collect()}

    def filled(text):
        return [x for x in (text or "").split("\n") if x.encode().strip()]

    for k, t in rows:  # a chunk takes blank lines before its first line along, so blank lines may differ
        assert filled(got.get(k, t)) == filled(want[k]), k
        assert k in got or want[k] == (t or "")


def test_line_bytes_are_compared(spark, monkeypatch):
    """With hashes that say everything is equal nothing but equal bytes goes."""
    same = lines.Lines.keys
    monkeypatch.setattr(lines.Lines, "keys", lambda self, units: [k & 1 for k in same(self, units)])
    rows = [(1, "a\nb\nc\nd"), (2, "e\nf\ng\nh"), (3, "i\nj\nk")]
    assert lines.removed(spark.createDataFrame(rows, "doc_id bigint, text string")).count() == 0


def test_line_boundaries_resist_shifts():
    rng = random.Random(12)
    text = "\n".join(f"line {rng.random()}" for _ in range(200))

    def cuts(t):
        return {t[a:b] for a, b, _, _ in lines.chunks(t)}

    one, two = cuts(text.encode()), cuts(("new first line\n" + text).encode())
    assert len(one - two) <= 2


def test_mixing(spark):
    rows = corpus(13, 200) + [(900, "x y", None, "c", 3), (901, None, None, "empty", 0)]
    docs = frame(spark, rows)
    got = mixing.copies(docs).collect()
    want = brute.mix([(r[0], r[1], r[3]) for r in rows])
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["copies"] <= 2
    assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in rows)
    assert bag(mixing.copies(docs.repartition(7)), "doc_id", "copies") == bag(mixing.copies(docs), "doc_id", "copies")
    emitted = mixing.emit(docs)
    assert emitted.columns == [*docs.columns, "mix_copy"]
    assert bag(emitted.groupBy("doc_id").count(), "doc_id", "count") == sorted(
        ((r["doc_id"], r["copies"]) for r in got if r["copies"]), key=repr)


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.report(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang_pred != 'und'")
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right > 0.97
    model = language.fit(docs)
    assert model.predict("1234 !!") == model.predict(None) == model.predict("") == ("und", 0.0)
    assert 0 <= model.predict("the")[1] <= 1


def test_language_sample_is_bounded(spark):
    rows = [(k, f"text number {k} in words of its own", f"l{k % 30}", None, 0) for k in range(300)]
    rows += [(7, "again the same id", "l7", None, 0)] * 50
    docs = frame(spark, rows)
    assert len(language.fit(docs, sample=60).names) == 30
    assert 0 < len(language.fit(docs, sample=10).names) <= 10  # more languages than rows
    assert {r["score"] >= 0 for r in language.report(docs).collect()} == {True}


def test_class_prior_from_the_mixture():
    rng = np.random.default_rng(3)
    for prior in (0.1, 0.3, 0.6, 0.9):
        kinds = rng.random(4000) < prior
        found = quality.mixture_prior(rng.normal(2, 1, 1500), rng.normal(np.where(kinds, 2, -2), 1))
        assert abs(found - prior) < 0.06
    assert quality.mixture_prior(np.zeros(1), np.zeros(1)) == 0.99  # ties


def test_quality(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = quality.report(docs, labels).join(labels, "doc_id").where("held_out")
    right, n = got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert n > 500 and right > 0.95
    prior, share = quality.report(docs, labels).select("class_prior", "labelled_share").first()
    print("prior", prior, "share", share, "right", right)
    assert 0.01 < prior < 0.99 and 0 < share < 1


def test_quality_labels_missing_or_alike(spark):
    docs = frame(spark, corpus(14, 20))
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r["score"] for r in quality.report(docs, none).collect()} == {0.5}
    assert quality.accepted(docs, none).count() == docs.count()
    ones = spark.createDataFrame([(k, 1) for k in range(20)], "doc_id bigint, quality int")
    assert {r["predicted"] for r in quality.report(docs, ones).collect()} == {1}


def test_licences(spark):
    rows = corpus(15, 40)
    rows += [(800 + k, f"w1 w2 w4\n{t[0]}\nw5 w7", None, None, 0) for k, t in enumerate(licences.TEMPLATES.values())]
    rows += [(900, "w1 license w2 free w4 public", None, None, 0)]
    got = {r["doc_id"]: r for r in licences.report(frame(spark, rows)).collect()}
    for k, family in enumerate(licences.TEMPLATES):
        assert got[800 + k]["families"] == family and got[800 + k]["n_paragraphs"] == 3
    assert not any(r["families"] for k, r in got.items() if k < 800 or k == 900)


def test_scores(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    out = [language_fold(r["doc_id"]) for r in rows]
    tokens = {r["doc_id"]: [*brute.words((r["text"] or "").translate(brute.LOWER)), "\0end"] for r in rows}
    counts = brute.Counter(t for r, held in zip(rows, out) if not held for t in tokens[r["doc_id"]])
    n, v = sum(counts.values()), len(counts)
    got = {r["doc_id"]: r for r in contextmix.report(docs).collect()}
    for r, held in zip(rows, out):
        own, mine = tokens[r["doc_id"]], got[r["doc_id"]]
        assert (mine["held_out"], mine["n_tokens"], mine["n_known"], mine["train_tokens"]) == (
            held, len(own), sum(t in counts for t in own), n)
        assert mine["base_score"] == pytest.approx(
            sum(np.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own))
    held = [g for g in got.values() if g["held_out"]]
    assert sum(g["score"] for g in held) > sum(g["base_score"] for g in held)


def language_fold(doc_id, folds=10):
    import zlib
    return zlib.crc32(str(doc_id).encode()) % folds == 0


def test_scores_are_probabilities():
    """Over all tokens that may come next the chances add up to one, whatever came before."""
    mass = np.full(32, 0.1)
    counts = {1: 5, 2: 9, 3: 1, 4: 4}
    for c in counts.values():
        mass[contextmix.class_of(np.array([c]))[0]] += c + (0.1 if mass[contextmix.class_of(np.array([c]))[0]] > 0.1 else 0)
    mass = np.full(32, 0.0)
    mass[0] = 0.1
    for c in counts.values():
        mass[contextmix.class_of(np.array([c]))[0]] += c + 0.1
    rng = np.random.default_rng(16)
    mixer = contextmix.Mixer(rng.integers(0, 9, contextmix.CONTEXTS * contextmix.SLOTS).astype(float),
                             rng.integers(0, 9, contextmix.CONTEXTS * contextmix.SLOTS).astype(float), mass)
    import zstandard

    def chance(seq):
        h = np.array(seq, np.uint64) << np.uint64(48)
        names, ids = np.unique(h, return_inverse=True)
        c = np.array([counts.get(int(x >> np.uint64(48)), 0) for x in names])
        blob = contextmix.packed_text(names, ids, c, zstandard.ZstdCompressor())
        return 10 ** mixer.score(contextmix.Texts([(len(seq), blob)], zstandard.ZstdDecompressor()))[0][0]

    classes_used = {int(contextmix.class_of(np.array([c]))[0]) for c in counts.values()} | {0}
    for past in ([], [1], [2, 2], [1, 9, 3, 2, 9]):
        before = chance(past) if past else 1.0
        total = sum(chance([*past, t]) for t in (1, 2, 3, 4, 9)) / before
        assert 0 < total <= 1 + 1e-4  # what is missing went to classes without tokens
    assert classes_used


def test_starting_weights_see_every_training_document(spark):
    """The fit equals one over all coded texts at once, long ones and those beyond any sample included."""
    import zstandard
    rng = np.random.default_rng(23)
    mass = np.full(32, 40.0)
    zeros, ones = rng.integers(0, 9, (2, contextmix.CONTEXTS * contextmix.SLOTS)).astype(float)
    coded = []
    for size in (6000, *rng.integers(1, 60, 700).tolist()):
        names, ids = np.unique(rng.integers(1, 30, size).astype(np.uint64) << np.uint64(48), return_inverse=True)
        blob = contextmix.packed_text(names, ids, np.bincount(ids) + rng.integers(0, 4, len(names)), zstandard.ZstdCompressor())
        coded.append((size, blob))
    whole = contextmix.Mixer(zeros, ones, mass)
    whole.start_from(whole.moments(contextmix.Texts(coded, zstandard.ZstdDecompressor(), lessons=True)))
    part = contextmix.Mixer(zeros, ones, mass)
    part.start_from(part.moments(contextmix.Texts(coded[1:401], zstandard.ZstdDecompressor(), lessons=True)))
    frame = spark.createDataFrame([(n, bytearray(b)) for n, b in coded], "n_tokens bigint, codes binary")
    for n in (1, 7):
        mixer = contextmix.Mixer(zeros, ones, mass)
        contextmix.fit(mixer, frame.repartition(n))
        assert (mixer.weights == whole.weights).all() and (mixer.weights != part.weights).any()


def test_numbers_of_hashes_are_their_ranks():
    rng = np.random.default_rng(29)
    near = (np.uint64(7) << np.uint64(40)) + rng.integers(0, 5, 300).astype(np.uint64)  # alike in their first bits
    for h in (near, rng.integers(0, 1 << 63, 500).astype(np.uint64)[rng.integers(0, 500, 3000)], near[:1]):
        names, number = contextmix.numbered(h)
        plain, ids = np.unique(h, return_inverse=True)
        assert (names == plain).all() and (number == ids).all()


def test_gates_step_together_and_score_as_one_by_one(monkeypatch):
    """The chances are those of a plain loop over decisions, in one step for the class bits of a token."""
    import zstandard
    rng, unpack = np.random.default_rng(31), zstandard.ZstdDecompressor()
    zeros, ones = rng.integers(0, 9, (2, contextmix.CONTEXTS * contextmix.SLOTS)).astype(float)
    mass = np.full(32, 40.0)
    mixer = contextmix.Mixer(zeros, ones, mass)
    coded = []
    for size in (1, 2, 130, 40, 530):
        names, ids = np.unique(rng.integers(1, 20, size).astype(np.uint64) << np.uint64(48), return_inverse=True)
        coded.append((size, contextmix.packed_text(names, ids, rng.integers(0, 9, len(names)), zstandard.ZstdCompressor())))
    steps, einsum = [], np.einsum
    monkeypatch.setattr(contextmix.np, "einsum", lambda *a, **k: steps.append(1) or einsum(*a, **k))
    got = mixer.score(contextmix.Texts(coded, unpack))[0]
    assert len(steps) == contextmix.LANE // contextmix.BITS + contextmix.LANE

    def mixed(weights, context, node, zero, one):
        x = np.append([mixer.stretched[k][contextmix.slot(context[k:k + 1], np.uint32(node))[0]]
                       for k in range(contextmix.CONTEXTS)], contextmix.OFFSET)
        p = 1 / (1 + np.exp(-np.clip(weights @ x, -12, 12)))
        whole = (1 - p) * zero + p * one
        weights += 0.004 * (p * one / whole - p) * x
        return whole

    for (size, blob), score in zip(coded, got):
        text, total = contextmix.Texts([(size, blob)], unpack), 0.0
        contexts = np.array(text.contexts())
        for t in range(size):
            if t % (contextmix.LANE // contextmix.BITS) == 0:
                bits = mixer.weights.astype(float)
            if (t - 1) % contextmix.LANE == 0:
                source = mixer.weights[0].astype(float)
            c, node = int(text.classes[t]), 1
            drawn = (text.counts[text.ids[t]] + 0.1) / mass[c]
            for b in range(contextmix.BITS):
                bit = c >> (contextmix.BITS - 1 - b) & 1
                at = (1 << b) + (c >> (contextmix.BITS - b)) + 1
                drawn *= mixed(bits[1 + b], contexts[:, t], at, 1 - bit, bit)
            total += np.log10(drawn * (mixed(source, contexts[:, t], 0, 1, text.copied[t] / drawn) if t else 1))
        assert score == pytest.approx(total, rel=1e-4)


def test_weights_are_carried_through_a_text():
    """A text is mixed from its first token to its last; only the next text starts anew."""
    import zstandard
    rng, unpack = np.random.default_rng(37), zstandard.ZstdDecompressor()
    zeros, ones = rng.integers(0, 9, (2, contextmix.CONTEXTS * contextmix.SLOTS)).astype(float)
    mass, coded = np.full(32, 40.0), []
    mixer = contextmix.Mixer(zeros, ones, mass)
    for size in (3, 700, 1, 240):
        names, ids = np.unique(rng.integers(1, 20, size).astype(np.uint64) << np.uint64(48), return_inverse=True)
        coded.append((size, contextmix.packed_text(names, ids, rng.integers(0, 9, len(names)), zstandard.ZstdCompressor())))
    for (size, blob), score in zip(coded, mixer.score(contextmix.Texts(coded, unpack), None)[0]):
        text, total = contextmix.Texts([(size, blob)], unpack), 0.0
        contexts, weights = np.array(text.contexts()), mixer.weights.astype(float)

        def chance(gate, t, node, zero, one):
            x = np.append([mixer.stretched[k][contextmix.slot(contexts[k, t:t + 1], np.uint32(node))[0]]
                           for k in range(contextmix.CONTEXTS)], contextmix.OFFSET)
            p = 1 / (1 + np.exp(-np.clip(weights[gate] @ x, -12, 12)))
            whole = (1 - p) * zero + p * one
            weights[gate] += 0.004 * (p * one / whole - p) * x
            return whole

        for t in range(size):
            c = int(text.classes[t])
            drawn = (text.counts[text.ids[t]] + 0.1) / mass[c]
            for b in range(contextmix.BITS):
                bit = c >> (contextmix.BITS - 1 - b) & 1
                drawn *= chance(1 + b, t, (1 << b) + (c >> (contextmix.BITS - b)) + 1, 1 - bit, bit)
            total += np.log10(drawn * (chance(0, t, 0, 1, text.copied[t] / drawn) if t else 1))
        assert score == pytest.approx(total, rel=1e-4)


def test_counters_are_those_of_all_training_documents(spark, monkeypatch):
    """Each context of one or two tokens has its own counters, in every block, with what all blocks have met."""
    monkeypatch.setattr(contextmix, "BLOCK", 20)
    rng = random.Random(41)
    texts = {k: [f"w{rng.randint(0, 150)}" for _ in range(rng.randint(0, 40))] for k in range(70)}
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in texts.items()], "doc_id bigint, text string").repartition(3)
    words = {k: [*t, "end"] for k, t in texts.items()}
    taught = [k for k in words if not language_fold(k)]
    counts = brute.Counter(w for k in taught for w in words[k])

    def before(k, t):
        return [(words[k][t - 1] if t else None,), (words[k][t - 2] if t > 1 else None, words[k][t - 1] if t else None)]

    met = defaultdict(list)
    for k in taught:
        own, earlier = brute.Counter(words[k]), set()
        for t, w in enumerate(words[k]):
            n = counts[w] - own[w]  # as a lesson
            for c in before(k, t):
                met[c].append((int(contextmix.class_of(np.array([n]))[0]), (w if n else None) in earlier))
            earlier.add(w if n else None)
    table, _, mass = contextmix._coded(docs, "doc_id", "text", 4, 3)
    told = contextmix._told(table, 3).where("block IS NOT NULL")
    mixer = contextmix.Mixer(None, None, mass)
    mixer.known = np.zeros(len(contextmix.FIXED) * contextmix.NODES, np.float32)
    looked = 0
    for block in [r["block"] for r in table.select("block").distinct().collect()]:
        rows = table.where(F.col("block") == block).toArrow()
        here = contextmix.Block(rows, 300, lessons=False)
        here.listen(told.where(F.col("block") == block).toArrow(), mixer)
        for k, batch in enumerate(here.batches):
            spelling, source = here.contexts(k)
            bits, nodes = batch.bits()
            for row, begin in zip(here.rows[k], batch.starts):
                doc = rows["doc_id"][row].as_py()
                for t, w in enumerate(words[doc]):
                    c, at = int(contextmix.class_of(np.array([counts[w]]))[0]), begin + t
                    for context, key in zip((1, 2), before(doc, t)):
                        for b in range(contextmix.BITS):
                            shift = contextmix.BITS - 1 - b
                            there = [x >> shift & 1 for x, _ in met[key] if x >> (shift + 1) == c >> (shift + 1)]
                            got = spelling[context][at:at + 1].inputs(1 + b, nodes[b, at:at + 1], bits[b, at:at + 1])[0]
                            if len(there) < 64:
                                assert got == pytest.approx(np.log((sum(there) + 0.4) / (len(there) - sum(there) + 0.4)), abs=1e-4)
                                looked += len(there) > 1
                        seen = [x for _, x in met[key]]
                        if t and len(seen) < 64:
                            got = source[context][at:at + 1].inputs(0, np.uint32(0), None)[0]
                            assert got == pytest.approx(np.log((sum(seen) + 0.4) / (len(seen) - sum(seen) + 0.4)), abs=1e-4)
    assert looked > 1000


def test_score_does_not_depend_on_company(spark):
    rows = [(k, t, None, None, 0) for k, t in enumerate(["a b a b c", "a b a b c", "", None, "q " * 900, "a b a b c"])]
    got = {r["doc_id"]: r["score"] for r in contextmix.report(frame(spark, rows)).collect()}
    assert got[0] == pytest.approx(got[1]) == pytest.approx(got[5]) and got[2] == got[3]


def plain_anchors(digits):
    place, out = 0, []
    for k in range(0, len(digits), syncmers.DIGITS):
        place += int(digits[k + 7], 16)
        out.append((place, digits[k:k + 7]))
    return out


def test_likeness_by_position():
    rng, rolling = random.Random(19), Rolling()
    passages = [" ".join(f"{rng.random():.6f}" for _ in range(40)) for _ in range(10)]
    whole = syncmers.fingerprint("".join(passages), rolling)
    turned = syncmers.fingerprint("".join(reversed(passages)), rolling)
    assert syncmers.likeness(whole, turned) < 0.2  # the same passages in reversed order
    inside = syncmers.fingerprint("".join(passages[3:5]), rolling)
    assert syncmers.held(whole, inside) > 0.95 > 0.5 > syncmers.likeness(whole, inside) > 0.3
    inserted = syncmers.fingerprint("".join(passages[:5] + ["something new"] + passages[5:]), rolling)
    assert syncmers.likeness(whole, inserted) > 0.97
    long = " ".join(f"{rng.random():.6f}" for _ in range(12_000))
    part = syncmers.fingerprint(long[50_000:52_000], rolling)
    assert syncmers.held(part, syncmers.fingerprint(long, rolling)) > 0.95
    for a, b in [("", ""), ("", "x"), ("short", "short"), ("a" * 5000, "a" * 9000)]:
        p, q = syncmers.fingerprint(a, rolling), syncmers.fingerprint(b, rolling)
        assert syncmers.likeness(p, q) == syncmers.likeness(q, p) and (syncmers.likeness(p, q) == 1) == (a == b)


def test_common_anchors_against_brute_force():
    rng = random.Random(20)
    for n in range(150):
        texts = []
        for _ in range(2):
            # few short words, so anchors repeat and stand in any order
            pool = ["alpha beta gamma delta ", "one two three four five ", "zzzzzzzzzzzzzzzzzzzzzzzzzz", "x "]
            texts.append("".join(rng.choices(pool, k=rng.randint(0, 12))))
        one, two = (syncmers.fingerprint(t, Rolling()) for t in texts)
        want = brute.common_anchors(plain_anchors(one), plain_anchors(two))
        assert syncmers.common(syncmers.Anchors.of(one), syncmers.Anchors.of(two)) == want, texts


def test_fingerprints(spark):
    rows = corpus(17, 50, longest=400) + [(None, "tail 😀 " * 30, None, None, 0), (70, "é" * 3, None, None, 0)]
    assert max(len(r[1] or "") for r in rows) > 8000
    got = syncmers.report(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    mine = {r["doc_id"]: r for r in got}
    rolling = Rolling()
    for k, row in enumerate(order):
        text, after = row[1] or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = mine[row[0]]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), brute.sha(edited))
        assert r["fingerprint"] == syncmers.fingerprint(text, rolling)
        assert r["edited_fingerprint"] == syncmers.fingerprint(edited, rolling)
        assert r["near_edited"] == syncmers.likeness(r["fingerprint"], r["edited_fingerprint"])
        assert r["held_edited"] == syncmers.held(r["fingerprint"], r["edited_fingerprint"])
        other = syncmers.fingerprint(after, rolling)
        assert r["near_next"] == syncmers.likeness(r["fingerprint"], other)
        assert r["held_next"] == syncmers.held(r["fingerprint"], other)
        if len(text) < 1500 and len(after) < 1500:
            a, b = plain_anchors(r["fingerprint"]), plain_anchors(other)
            n = brute.common_anchors(a, b)
            assert r["near_next"] == (2 * n / (len(a) + len(b)) if a and b else float(a == b))


def test_syncmers_against_definition():
    rng = random.Random(18)
    text, rolling = "".join(rng.choices("abcd ", k=300)), Rolling()
    points = np.array([ord(c) for c in text], np.uint64)
    from rollcall.llm.words import mixed
    inner = rolling.hashes(mixed(points + np.uint64(1)), syncmers.S).tolist()
    span = syncmers.K - syncmers.S + 1
    want = [k for k in range(len(text) - syncmers.K + 1)
            if min(inner[k:k + span]) in (inner[k], inner[k + span - 1])]
    places, hashes = syncmers.anchors(text, rolling)
    assert places.tolist() == want
    # context-free: a passage keeps its anchors wherever it stands
    moved, again = syncmers.anchors("xyz" + text, rolling)
    assert set(hashes.tolist()) <= set(again.tolist())
    assert syncmers.likeness(syncmers.fingerprint(text, rolling), syncmers.fingerprint(text, rolling)) == 1.0


EMPTY = {
    "substrings": lambda d, b, q: substrings.report(d), "lines": lambda d, b, q: lines.report(d),
    "dedup": lambda d, b, q: lines.dedup(d), "groups": lambda d, b, q: near.groups(d),
    "keep_one": lambda d, b, q: near.keep_one(d), "decontaminate": lambda d, b, q: decontaminate.report(d, b),
    "mix": lambda d, b, q: mixing.copies(d), "emit": lambda d, b, q: mixing.emit(d),
    "language": lambda d, b, q: language.report(d), "quality": lambda d, b, q: quality.report(d, q),
    "accepted": lambda d, b, q: quality.accepted(d, q), "licences": lambda d, b, q: licences.report(d),
    "scores": lambda d, b, q: contextmix.report(d), "fingerprints": lambda d, b, q: syncmers.report(d)}


@pytest.mark.parametrize("name", sorted(EMPTY))
def test_empty_and_null_tables(spark, name):
    bench = spark.createDataFrame([], "item_id int, text string")
    labels = spark.createDataFrame([(None, None), (3, None)], "doc_id bigint, quality int")
    assert EMPTY[name](frame(spark, []), bench, labels).count() == 0
    nulls = frame(spark, [(None, None, None, None, None)] * 3)
    assert EMPTY[name](nulls, bench, labels).count() == (0 if name == "emit" else 3)
