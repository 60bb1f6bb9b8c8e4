"""Plain versions of the corpus operators for small inputs: loops over words and sets, no hashes."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

SPACE = re.compile(r"[\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def substrings(rows, length):
    """rows: (id, text) -> list of (id, n_words, n_removed, kept hash)."""
    runs = Counter(tuple(w[k:k + length]) for _, t in rows for w in [words(t)] for k in range(len(w) - length + 1))
    out = []
    for i, t in rows:
        w = words(t)
        gone = {j for k in range(len(w) - length + 1) if runs[tuple(w[k:k + length])] > 1 for j in range(k, k + length)}
        out.append((i, len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone))))
    return out


def contaminated(rows, items, window=13):
    def norm(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))

    wins = {}
    for name, t in items:
        w = norm(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[k:k + n]), set()).add(str(name))
    out = []
    for i, t in rows:
        w = norm(t)
        hit, names = set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in wins:
                    hit.update(range(k, k + n))
                    names |= wins[tuple(w[k:k + n])]
        out.append((i, len(w), len(hit), len(names), sha(",".join(sorted(names))),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out


def groups(rows, least=80):
    """(id, set size, component, kept); ids are distinct."""
    sets = {}
    for i, t in rows:
        w = words((t or "").translate(LOWER))
        sets[i] = set(zip(w, w[1:])) if len(w) > 1 else {tuple(w)} if w else set()
    label = {i: i for i in sets}
    ids = sorted(sets)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])]
    while any(label[a] != label[b] for a, b in links):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return [(i, len(sets[i]), label[i], label[i] == i) for i in ids]


def mix(rows, weights=(5, 2, 1), share=1.5, cap=2.0):
    """rows: (id, text, source) -> {source: target}, by resharing the excess round after round."""
    size = Counter()
    for _, t, s in rows:
        size[s] += len(words(t))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    w = {s: weights[n % len(weights)] for n, s in enumerate(names)}
    left, open_, target = share * sum(size.values()), set(names), dict.fromkeys(names, 0.0)
    while open_ and left > 1e-9:
        whole = sum(w[s] for s in open_)
        given = 0.0
        for s in sorted(open_, key=names.index):
            more = min(left * w[s] / whole, cap * size[s] - target[s])
            target[s] += more
            given += more
        left -= given
        open_ = {s for s in open_ if target[s] < cap * size[s] - 1e-9}
    return target


def repeated_lines_removed(rows):
    """rows: (id, text): {id: text without lines in a pair of neighbouring lines that occurs earlier}.

    Neighbours are lines that are not blank; the blank ones between them belong to the pair.
    """
    first, out = {}, {}
    for i, t in sorted(rows):
        parts = (t or "").split("\n")
        if parts[-1] == "":
            parts.pop()
        full = [k for k, x in enumerate(parts) if x.encode().strip()]
        gone = set()
        for a, b in zip(full, full[1:]):
            if first.setdefault(tuple(parts[a:b + 1]), (i, a)) != (i, a):
                gone |= set(range(a, b + 1))
        if gone >= set(full) and gone:
            gone = set(range(len(parts)))
        kept = [x for k, x in enumerate(parts) if k not in gone]
        out[i] = "\n".join(kept) + ("\n" if kept and (t or "").endswith("\n") else "")
    return out


def common_anchors(one, two):
    """one, two: (place, hash) lists -> anchors in common: paired by occurrence, beside a pair of the same offset,
    in the longest sequence that rises in both."""
    if one == two:
        return len(one)
    pairs = []
    for h in {h for _, h in one}:
        pairs += zip([p for p, x in one if x == h], [p for p, x in two if x == h])
    good = set(pairs) if min(len(one), len(two)) <= 1 else set()
    for side in (0, 1):
        row = sorted(pairs, key=lambda x: x[side])
        for a, b in zip(row, row[1:]):
            if a[1] - a[0] == b[1] - b[0]:
                good |= {a, b}
    row, best = sorted(good), []
    for k, (_, b) in enumerate(row):
        best.append(1 + max((n for n, (_, c) in zip(best, row[:k]) if c < b), default=0))
    return max(best, default=0)
