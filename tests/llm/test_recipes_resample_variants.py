"""Exact dedup by recipes, importance resampling and spelling variants against plain loops."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from brute import LOWER
from rollcall.llm import recipes, resample, variants

KIND = "doc_id bigint, text string, row string, user string, chunk int, n int, rank string, path int, kept int"
EXTRA = ("r", "u", 1, 2, "k", 3, 4)


def frame(spark, rows):
    """Rows (id, text) with further columns that are named like internal ones."""
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], KIND).repartition(3)


def bag(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


# --- exact dedup

def texts(seed, n=50):
    rng = random.Random(seed)
    out = [" ".join(rng.choices(["a", "bb", "é", "w1", "W1"], k=rng.choice([1, 2, 30, 400]))) for _ in range(n)]
    out += [out[0].replace(" ", "\t\n"), out[1] + " ", " " + out[1], out[1], "", None, " ", "\n\n", "a b", "a b"]
    out.append(" ".join(rng.choices("abcdef", k=60_000)))
    return out + rng.choices(out, k=25)


def plain_groups(rows):
    norm = {k: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for k, (_, t) in enumerate(rows)}
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in norm if norm[j] == norm[k]]
        known = [x for x in ids if x is not None]
        out.append((i, min(known) if known else None, len(ids), hashlib.sha256(norm[k].encode()).hexdigest()))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_groups(spark, seed):
    rows = [(100 - k, t) for k, t in enumerate(texts(seed))]
    got = recipes.report(frame(spark, rows))
    want = plain_groups(rows)
    assert bag(got, "doc_id", "keep_id", "group_size", "text_sha256") == sorted(want, key=repr)
    assert bag(got.where("kept"), "doc_id") == sorted({(w[1],) for w in want}, key=repr)


def test_exact_groups_with_hashes_that_clash(spark, monkeypatch):
    """An identifier shared by unlike chunks is noticed and replaced."""
    good, tried = recipes.identifier, []

    def weak(chunk, salt):
        tried.append(salt)
        return good(F.substring(chunk, 1, 1), salt) if salt < 2 else good(chunk, salt)

    monkeypatch.setattr(recipes, "identifier", weak)
    rows = [(k, t) for k, t in enumerate(texts(3))]
    got = bag(recipes.report(frame(spark, rows)), "doc_id", "keep_id", "group_size", "text_sha256")
    assert got == sorted(plain_groups(rows), key=repr)
    assert max(tried) == 2


def test_exact_dedup_of_awkward_rows(spark):
    rows = [(7, "x y"), (7, "x  y"), (7, "x y"), (7, "other"), (None, "x y"), (None, None), (None, ""), (3, "z"), (None, "z")]
    got = recipes.report(frame(spark, rows))
    assert bag(got, "doc_id", "keep_id", "group_size") == sorted(
        [(7, 7, 4)] * 3 + [(None, 7, 4), (7, 7, 1), (None, None, 2), (None, None, 2), (3, 3, 2), (None, 3, 2)], key=repr)
    assert got.where("kept").count() == 4
    docs = frame(spark, rows)
    kept = recipes.dedup(docs)
    assert kept.columns == docs.columns
    assert bag(kept, "doc_id", *KIND.replace(",", "").split()[4::2]) == sorted(
        [(7, *EXTRA), (7, *EXTRA), (None, *EXTRA), (3, *EXTRA)], key=repr)
    assert recipes.report(docs.where("false")).collect() == recipes.dedup(docs.where("false")).collect() == []


def test_chunks_join_to_the_text_and_resist_shifts(spark):
    words = [f"v{random.Random(k).randrange(10 ** 6)}" for k in range(5000)]
    rows = [(1, " ".join(words)), (2, " ".join(["new", "front", *words]))]
    got = {r["doc_id"]: r["chunks"] for r in recipes.chunked(frame(spark, rows)).collect()}
    assert [" ".join(got[k]) for k in (1, 2)] == [t for _, t in rows]
    assert len(got[1]) > 30 and len(set(got[1]) - set(got[2])) <= 1


# --- importance resampling

def plain_resample(rows, target, size=1, buckets=10_000, share=10, least=20, seed=2024):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))

    def feats(t):
        w = words(t)
        return [crc32(" ".join(w[k:k + n]).encode()) % buckets for n in range(1, size + 1) for k in range(len(w) - n + 1)]

    s, t = Counter(), Counter()
    for _, x in rows:
        s.update(feats(x))
    for x in target:
        t.update(feats(x))
    ns, nt = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[k] + 1) * (ns + buckets) / ((s[k] + 1) * (nt + buckets)))) for k in range(buckets)]
    out = []
    for i, x in rows:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        f = feats(x)
        weight = sum(gain[b] for b in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), None, len(words(x))])
    long = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for nth, r in enumerate(long[:share * len(long) // 100], 1):
        r[4] = nth
    return [tuple(r[:5]) for r in out]


def bodies(seed, n=80):
    rng = random.Random(seed)
    pool = [f"w{k}" for k in range(30)] + ["Été", "ÉTÉ", "x_y", "KelvinK", "7", "a b", "日本"]
    out = [rng.choice([" ", "-", "\n"]).join(rng.choices(pool, k=rng.choice([0, 3, 19, 20, 60]))) for _ in range(n)]
    return out + [None, "", " ", "... !", out[3] * 300, out[3]]


@pytest.mark.parametrize("size, share", [(1, 10), (3, 35)])
def test_resampling(spark, size, share):
    rows = list(enumerate(bodies(4)))
    target = bodies(5, 9)
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, row int")
    got = bag(resample.report(frame(spark, rows), goal, size=size, share=share), "doc_id", "n_features", "weight", "score", "rank")
    want = plain_resample(rows, target, size, share=share)
    assert got == sorted(want, key=repr)
    docs = frame(spark, rows)
    drawn = resample.draw(docs, goal, size=size, share=share)
    assert drawn.columns == docs.columns
    assert bag(drawn, "doc_id", "text", "row", "rank") == sorted(
        [(i, t, "r", "k") for (i, t), w in zip(rows, want) if w[4]], key=repr)


def test_resampling_of_awkward_rows(spark):
    long = "w1 w2 " * 20
    rows = [(None, long)] * 30 + [(5, long), (5, long), (5, "w3 " * 25), (6, None)]
    goal = spark.createDataFrame([("w1",), (None,)], "text string")
    got = resample.report(frame(spark, rows), goal, share=50).collect()
    assert len(got) == len(rows)
    ranks = sorted(r["rank"] for r in got if r["rank"] is not None)
    assert ranks == list(range(1, 17))
    by_rank = {r["rank"]: (r["score"], r["doc_id"] is None) for r in got if r["rank"]}
    assert all(by_rank[k][0] >= by_rank[k + 1][0] for k in ranks[:-1])
    empty = frame(spark, rows).where("false")
    assert resample.report(empty, goal).collect() == resample.draw(empty, goal).collect() == []
    assert {r["weight"] for r in resample.report(frame(spark, rows), goal.where("false")).collect()} != set()


def test_places_run_through_partitions(spark):
    rows = spark.range(1000).select((F.col("id") % 7).alias("k"), "id").repartition(5)
    got = {r["id"]: r["nth"] for r in resample.numbered(rows, F.desc("k"), F.asc("id")).collect()}
    order = sorted(range(1000), key=lambda i: (-(i % 7), i))
    assert got == {i: nth for nth, i in enumerate(order, 1)}


# --- spelling variants

def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_variants(rows, shortest=7, least=2, spoil=31, times=10):
    count = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % spoil == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= shortest:
                count[run] += 1
    count = {w: n for w, n in count.items() if n >= least}
    form, links = {}, {}
    for w, n in count.items():
        links[w] = [x for x in count if near(w, x)]
        best = min(links[w], key=lambda x: (-count[x], x), default=None)
        form[w] = best if best and count[best] >= times * n else None
    out = []
    for w, n in count.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(links[w]), count[form[w]] if form[w] else None))
    return out


def spelt(seed):
    rng = random.Random(seed)
    letters = "abcdeéÉàÿ×"
    base = ["".join(rng.choices(letters, k=rng.randint(6, 9))) for _ in range(12)] + ["aaaaaaa", "aaaaaaaa", "abababab", "babababa"]
    rows = []
    for k in range(60):
        words = []
        for _ in range(rng.choice([0, 5, 40])):
            w = base[min(rng.randrange(len(base)), rng.randrange(len(base)))]
            if rng.random() < 0.3:
                at = rng.randrange(len(w) + 1)
                w = rng.choice([w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1:], w[:at] + w[at + 1:]])
            words.append(rng.choice([w, w.upper() if w.isascii() else w]))
        rows.append((k, rng.choice([" ", "-", "ž", "\n", "1"]).join(words)))
    anagrams = ["".join(rng.sample("aekuoxn", 7)) for _ in range(60)]
    return rows + [(900, None), (901, ""), (902, "日本 İstanbulluu ßßßßßßß " * 3), (None, " ".join(base)), (None, " ".join(base)),
                   (3, " ".join(base)), (903, " ".join(anagrams * 2)), (904, "q" * 5000 + " " + "q" * 5000 + " " + "q" * 5001 + " " + "q" * 5001)]


@pytest.mark.parametrize("block, queries", [(20_000, 200_000), (3, 4), (1, 1)])
def test_variants(spark, monkeypatch, block, queries):
    """Also with tries of a few words, so that nodes are opened to the leaves and leaves dealt in parts."""
    monkeypatch.setattr(variants, "BLOCK", block)
    monkeypatch.setattr(variants, "QUERIES", queries)
    monkeypatch.setattr(variants, "HELD", 10 * block)
    rows = spelt(6)
    got = bag(variants.report(frame(spark, rows), times=2), "word", "form", "root", "n", "n_near", "form_n")
    assert got == sorted(plain_variants(rows, times=2), key=repr)


def test_each_pair_of_near_words_is_found_once():
    rng = random.Random(8)
    words = sorted({"".join(rng.choices("abkuxé", k=rng.randint(1, 5))) for _ in range(900)})
    trie = variants.Trie(0)
    for w in words:
        trie.add(w, 1)
    found = Counter(frozenset((w, x)) for w in words for x, _ in trie.near(w, 0))
    assert found == Counter(frozenset((a, b)) for k, a in enumerate(words) for b in words[:k] if near(a, b))


def test_variants_of_nothing(spark):
    docs = frame(spark, [(1, "abc defg")])
    assert variants.report(docs).collect() == variants.report(docs.where("false")).collect() == []


def test_roots_follow_long_chains(spark):
    forms = spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(40)], "word string, form string")
    assert {r["root"] for r in variants.roots(forms).collect()} == {"w40"}
