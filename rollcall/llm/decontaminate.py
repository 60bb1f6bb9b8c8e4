"""Benchmark decontamination (operator 3) by a generalised suffix automaton.

The normalised items are built into an automaton over words, block by block, each block holding a bounded
number of item words.  Every document is streamed through it: after each word the automaton knows the
longest match with any item that ends there.  Where that length reaches ``window`` words, the last
``window`` words are an occurrence of an item window; an item of fewer words is one window as a whole.

Repeated items are dropped and long ones cut into pieces that overlap by ``window - 1`` words, so a window lies in a
piece as a whole and no item, however long or frequent, outgrows a block.  A block's automaton is made by one task,
written to the shared folder and broadcast; its size is bounded by ``block_words``.  Documents are never shuffled: every block is applied to each row where it lies.

Defined results: null or empty texts have no words, no hits and are clean; items without words are never
found; an empty benchmark leaves everything clean; a null item id reads ``null``; repeated item ids count
once; texts are read whole, however long; rows are judged one by one, so ties, repeated rows and further
columns do not matter.
"""

from __future__ import annotations


from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.lineage import settle
from rollcall.llm.tasks import by_arrow, whole_row

# words after A-Z are lowered: digits, a-z and every byte of a character beyond ASCII
_KEPT = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))

RESULT = "n_words bigint, n_hit bigint, items array<string>, cut string"


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_KEPT).split()


class Automaton:
    """Generalised suffix automaton of word sequences, with the windows each state stands for."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window, self.ids = window, sorted({i for i, _ in items})
        self.vocab: dict[bytes, int] = {}
        coded = []
        nth = {name: k for k, name in enumerate(self.ids)}
        for name, words in items:
            if words:
                coded.append((nth[name], [self.vocab.setdefault(w, len(self.vocab)) for w in words]))
        self.length, self.link, self.step = [0], [-1], {}
        self._out: list[dict[int, int]] = [{}]
        for _, ids in coded:
            last = 0
            for w in ids:
                last = self._extend(last, w)
        self.step = {s * len(self.vocab) + w: t for s, row in enumerate(self._out) for w, t in row.items()}
        del self._out
        self._mark(coded)

    def _state(self, length: int, link: int, out: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self._out.append(out)
        return len(self.length) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """A state for the strings of q that are no longer than those reached from p."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self._out[q]))
        self.link[q] = clone
        while p >= 0 and self._out[p].get(w) == q:
            self._out[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: int) -> int:
        q = self._out[last].get(w)
        if q is not None:  # another item has been here
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in self._out[p]:
            self._out[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self._out[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new

    def _mark(self, coded: list[tuple[int, list[int]]]) -> None:
        n = len(self.length)
        order = sorted(range(1, n), key=self.length.__getitem__)
        # the state of the last ``window`` words of a longer match
        self.at_window = [-1] * n
        for s in order:
            if self.length[s] >= self.window:
                up = self.link[s]
                self.at_window[s] = s if self.length[up] < self.window else self.at_window[up]
        held: dict[int, set[int]] = {}
        self.short: dict[int, set[int]] = {}
        for item, ids in coded:
            state = 0
            for k, w in enumerate(ids, 1):
                state = self.step[state * len(self.vocab) + w]
                if k >= self.window:
                    held.setdefault(self.at_window[state], set()).add(item)
            if len(ids) < self.window:
                self.short.setdefault(state, set()).add(item)
        self.held = {s: sorted(x) for s, x in held.items()}
        # nearest shorter suffix that is a whole short item
        self.next_short = [-1] * n
        for s in order:
            up = self.link[s]
            self.next_short[s] = up if up in self.short else self.next_short[up] if up >= 0 else -1

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans (first word, one past the last) of window occurrences, and the ids of their items."""
        spans, found, shorts = [], set(), bool(self.short)
        step, link, length, window, n = self.step, self.link, self.length, self.window, len(self.vocab)
        at_window, states = self.at_window, set()
        state = matched = 0
        for t, w in enumerate(map(self.vocab.get, words), 1):
            if w is None:
                state = matched = 0
                continue
            to = step.get(state * n + w)
            if to is None:
                while state and to is None:
                    state = link[state]
                    matched = length[state]
                    to = step.get(state * n + w)
                if to is None:
                    continue
            state = to
            matched += 1
            if matched >= window:
                spans.append((t - window, t))
                states.add(at_window[state])
            if shorts:
                s = state if state in self.short and matched == length[state] else self.next_short[state]
                while s > 0:
                    spans.append((t - length[s], t))
                    found |= self.short[s]
                    s = self.next_short[s]
        for s in states:
            found.update(self.held[s])
        return spans, {self.ids[i] for i in found}


def pieces(benchmark: DataFrame, *, item_id: str, text: str, window: int, piece_words: int) -> DataFrame:
    """(item, words, n): the items' words joined by spaces, distinct, cut where there are more than ``piece_words``
    windows."""
    items = benchmark.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("null")).alias("item"),
                             F.col(f"`{text}`").cast("string").alias("text")).where("text is not null").distinct()

    def cut(slices):
        for rows in slices:
            out = {"item": [], "words": [], "n": []}
            for item, whole in rows:
                words = normal_words(whole.encode())
                for at in range(0, max(1, len(words) - window + 1), piece_words):
                    some = words[at:at + piece_words + window - 1]
                    for name, x in zip(out, (item, b" ".join(some), len(some))):
                        out[name].append(x)
            yield out

    return by_arrow(items, cut, "item string, words binary, n bigint").where("n > 0").distinct()


def automata(benchmark: DataFrame, *, item_id: str = "item_id", text: str = "text", window: int = 13,
             block_words: int = 250_000, piece_words: int = 10_000) -> list:
    """Broadcast automata of the benchmark, one for each block of about ``block_words`` words."""
    items = settle(pieces(benchmark, item_id=item_id, text=text, window=window, piece_words=piece_words))
    total = items.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-total // block_words))
    kind = "block int, automaton binary"

    def build(group: pd.DataFrame) -> pd.DataFrame:
        found = Automaton([(i, x.split()) for i, x in zip(group["item"], group["words"])], window)
        return pd.DataFrame({"block": group["block"][:1], "automaton": [cloudpickle.dumps(found)]})

    made = settle(items.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(blocks)).cast("int"))
                  .groupBy("block").applyInPandas(build, kind))
    sc = benchmark.sparkSession.sparkContext
    numbers = sorted(r["block"] for r in made.select("block").collect())
    return [sc.broadcast(bytes(made.where(F.col("block") == b).first()["automaton"])) for b in numbers]


def _pieces(text: str, spans: list[tuple[int, int]], n: int) -> str:
    """The text without the characters from the first to the last word of each span."""
    hit = np.zeros(n, bool)
    for a, b in spans:
        hit[a:b] = True
    raw, out, at, k, inside = text.encode(), [], 0, -1, False
    plain = raw.translate(_KEPT)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], (np.frombuffer(plain, np.uint8) != 32).view(np.int8), [0]])))
    for k in range(n):
        a, b = int(edges[2 * k]), int(edges[2 * k + 1])
        if hit[k]:
            if not (k and hit[k - 1]):
                out.append(raw[at:a])
            at = b
    out.append(raw[at:])
    return b"".join(out).decode()


def judged(text: Column, blocks: list, *, cut: bool = False) -> Column:
    """Struct of n_words, n_hit, items (sorted ids) and, if wanted, ``cut``: the text without its hits."""

    @F.pandas_udf(RESULT)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        loaded: dict[int, Automaton] = {}
        for texts in batches:
            words = [normal_words((x or "").encode()) for x in texts]
            spans: list[list] = [[] for _ in words]
            items: list[set] = [set() for _ in words]
            for k, block in enumerate(blocks):
                if k not in loaded:  # one automaton in memory at a time
                    loaded = {k: cloudpickle.loads(block.value)}
                for row, w in enumerate(words):
                    s, found = loaded[k].scan(w)
                    spans[row] += s
                    items[row] |= found
            hits = []
            for w, s in zip(words, spans):
                hit = np.zeros(len(w), bool)
                for a, b in s:
                    hit[a:b] = True
                hits.append(int(hit.sum()))
            yield pd.DataFrame({
                "n_words": [len(w) for w in words], "n_hit": hits, "items": [sorted(x) for x in items],
                "cut": [_pieces(x, s, len(w)) if cut and s else None for x, s, w in zip(texts, spans, words)]})

    return judge(text)


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id",
                  window: int = 13, coverage: float = 0.05, remove: str = "document") -> DataFrame:
    """``docs`` without contamination, same columns.

    A document is contaminated when it has hits and they cover at least ``coverage`` of its words.
    ``remove="document"`` drops such documents; ``remove="span"`` keeps them without the matched spans.
    """
    blocks = automata(benchmark, item_id=item_id, window=window)
    verdict = F.struct(judged(F.col(f"`{text}`"), blocks, cut=remove == "span").alias("v"))
    bad = (F.col("judged.v.n_hit") > 0) & (F.col("judged.v.n_hit") >= coverage * F.col("judged.v.n_words"))
    out = docs.select(whole_row(docs), verdict.alias("judged"))
    if remove == "document":
        return out.where(~bad).select("user.*")
    return out.select(*[F.when(bad, F.col("judged.v.cut")).otherwise(F.col(f"user.`{c}`")).alias(c)
                        if c == text else F.col(f"user.`{c}`").alias(c) for c in docs.columns])


def report(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
           window: int = 13) -> DataFrame:
    """Per document: words, hit words, items with occurring windows and the verdict at 5 % coverage."""
    blocks = automata(benchmark, window=window)
    out = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), judged(F.col(f"`{text}`"), blocks).alias("v"))
    return out.select("doc_id", "v.n_words", "v.n_hit", F.size("v.items").cast("bigint").alias("n_items"),
                      F.sha2(F.array_join("v.items", ","), 256).alias("items_sha256"),
                      ((F.col("v.n_hit") > 0) & (20 * F.col("v.n_hit") >= F.col("v.n_words"))).alias("contaminated"))
