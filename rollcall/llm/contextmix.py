"""Language-model scoring (operator 9) by online logistic context mixing.

A text is its words and one end token; all tokens that training has not seen are one token, as in the base
score.  Each token comes from one of two sources, and a binary decision says from which:

* copied: one of the text's earlier tokens, by how often each occurred;
* drawn: its class (the size of its training count, in powers of two) is spelt in five bits, and within the
  class a token has the share (count + 0.1) / (sum of that over the class).

Every bit is predicted by six contexts (earlier bits of its kind, classes and hashes of the tokens before it,
place), each a counter learnt from all training documents.  The six predictions are mixed in the logistic
domain with weights chosen by a gate (the kind of bit), updated after every bit from the text's first token to
its last, and refined by an adaptive offset of that gate.  Which source a token came from is not known when both
could have given it, so that bit's update uses its expected value.  The total is the text's log10 probability;
``bits_per_byte`` is that over its bytes.

Token counts cover all training documents, and so do the counters, of which there are as many as contexts occur.
Counters learn from each training document as it looks when its own tokens are not counted, so they have met
unknown tokens.  Documents are handled in blocks of neighbouring ids.  A block asks for the counts of its tokens and
for the counters of its contexts by hash; what blocks ask is dealt by hash, summed, and told to those that asked, so
no task sees the whole vocabulary or all counters.  Only the counters of contexts of few values are broadcast.
Starting weights are one Newton step from 0.25 over the decisions of all training documents, none of which is
predicted from itself; gradient and curvature are summed in whole numbers, so they do not depend on the partitioning.

Defined results: null and empty texts are just the end token; with no training documents every token is
unknown; a null id counts as a training document and falls in a block by its text; equal texts get equal
scores; repeated rows count as often as they occur; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.lineage import scope, settle, shuffles_removed
from rollcall.llm.language import held_out
from rollcall.llm.tasks import as_bytes, by_arrow, doc_key, pack, sent
from rollcall.llm.words import U64, hashed, mixed

BLOCK = 1500  # ids to a block
END = np.uint64(0xE17D_0000_0000_0001)
BITS = 5  # of a class
CONTEXTS = 6
NOUGHT = np.zeros(1, np.int64)
SLOTS = 1 << 16  # counters to a context in tables of hashed contexts, which the report does not use
LANE = 500  # decisions mixed in a row where lanes are asked for; a multiple of BITS
GATES = BITS + 1  # gate 0 decides the source
NODES = 33  # of the class tree, from 2 on; node 0 is the source
SYMBOLS = 64  # classes, each new to the text or not
ASKED = "part int, block bigint, asked binary"
TOLD, SIZES = "block bigint, part int, told binary", ", k int, n bigint, v bigint"
KINDS = {"part": pa.int32(), "k": pa.int32(), "asked": pa.binary(), "told": pa.binary()}
FINE = (64, 1024, 4096)  # steps to one of inputs, errors and variances when weights are fitted
RIDGE = 20.0  # pull of the starting weights towards 0.25, in curvature
TOGETHER = 120_000  # tokens whose inputs are held while lanes are mixed
OFFSET = 0.95  # the input beside the contexts; its weight is the gate's offset


def tokens(text: bytes) -> np.ndarray:
    return np.append(hashed(text.lower().split())[:, 0], END)


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and the same with the end."""
    begun = np.flatnonzero(np.concatenate([np.ones(min(len(x), 1), bool), x[1:] != x[:-1]]))
    return begun, np.append(begun, len(x))


def numbered(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes in order, and each hash's number among them."""
    bits = np.uint64(max(len(h) - 1, 1).bit_length())
    # first bits of the hash, then the place: plain sorting is faster than an order
    order = np.sort(h >> bits << bits | np.arange(len(h), dtype=U64)) & ((np.uint64(1) << bits) - np.uint64(1))
    ranked = h[order]
    if (ranked[1:] < ranked[:-1]).any():  # unlike hashes with like first bits
        order = np.argsort(h)
        ranked = h[order]
    first, _ = _runs(ranked)
    number = np.empty(len(h), np.int64)
    number[order] = np.repeat(np.arange(len(first)), np.diff(first, append=len(h)))
    return ranked[first], number


def class_of(count: np.ndarray) -> np.ndarray:
    """0 for unknown tokens, else 1 + floor(log2(count)), at most 31."""
    return np.where(count > 0, np.minimum(31, 1 + np.floor(np.log2(np.maximum(count, 1)))), 0).astype(np.uint8)


def _vocabulary(docs: DataFrame, bits: int) -> DataFrame:
    """What blocks ask of the vocabulary: a key for each token, with how often its training documents have it; docs
    (block, out, text)."""
    def work(slices):
        squeeze = zstandard.ZstdCompressor(level=1)
        held, size = {}, 0  # a block's hashes, of training documents and of others

        def flush():
            out = {"part": [], "block": [], "asked": []}
            for block in sorted(held):  # neighbours share a block, so there are few
                train, others = (np.concatenate([np.empty(0, U64), *x]) for x in held[block])
                keys, number = numbered(np.concatenate([train, others]))
                c = np.bincount(number[:len(train)], minlength=len(keys))
                for part, asked in parcels(keys, (c > 0).astype(np.int64), np.zeros(np.count_nonzero(c), np.int64), c[c > 0],
                                           bits, squeeze):
                    out["part"].append(part)
                    out["block"].append(block)
                    out["asked"].append(asked)
            return out

        for rows in slices:
            for block, out, text in rows:
                h = tokens(text)
                held.setdefault(block, ([], []))[bool(out)].append(h)
                size += len(h)
            if size >= 1_500_000:
                yield flush()
                held, size = {}, 0
        if held:
            yield flush()

    return by_arrow(docs, work, ASKED)


def planes(x: np.ndarray) -> bytes:
    """Whole numbers in as few bytes as the largest needs, first bytes first, which compresses better; the
    width stands before them."""
    top = int(x.max()) if len(x) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
    if width == 1:
        return b"\x01" + x.astype(np.uint8).tobytes()
    return bytes([width]) + x.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()


def from_planes(raw: bytes, at: int, n: int) -> tuple[np.ndarray, int]:
    """The n numbers that stand at a place, and the place after them."""
    width = raw[at]
    if width == 1:
        return np.frombuffer(raw, np.uint8, n, at + 1).astype(np.int64), at + 1 + n
    x = np.frombuffer(raw, np.uint8, n * width, at + 1).reshape(width, n).T.copy().view(f"<u{width}").ravel()
    return x.astype(np.int64), at + 1 + n * width


def as_table(columns: dict[str, list]) -> pa.Table:
    return pa.table({name: pa.array(x, KINDS.get(name, pa.int64())) for name, x in columns.items()})


def parcels(keys: np.ndarray, lens: np.ndarray, symbols: np.ndarray, counts: np.ndarray, bits: int, squeeze):
    """(part, packed) of sorted keys with ``lens`` symbols each and their counts, cut by the first bits of the key."""
    firsts = np.arange(1 << bits, dtype=U64) << np.uint64(64 - bits)
    edges = np.append(np.searchsorted(keys, firsts), len(keys)).tolist()
    ends = np.append(0, np.cumsum(lens))
    for part, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        if a < b:
            steps = np.diff(keys[a:b], prepend=firsts[part])
            i, j = ends[a], ends[b]
            yield part, squeeze.compress(np.array([b - a, j - i], np.uint32).tobytes() + planes(steps.view(np.int64))
                                         + planes(lens[a:b]) + planes(symbols[i:j]) + planes(counts[i:j]))


def _opened(asked: pa.Table, bits: int) -> tuple[np.ndarray, ...]:
    """What a part was asked, rows by block: the distinct keys without their first bits, the number of each row's keys
    among them, all symbols, with the number of their key before them, their counts, and where each row's keys and
    symbols begin."""
    unpack = zstandard.ZstdDecompressor()
    keys, lens, symbols, counts = [], [], [], []
    for blob in asked["asked"].to_pylist():
        raw = unpack.decompress(blob)
        n, m = np.frombuffer(raw, np.uint32, 2).tolist()
        steps, at = from_planes(raw, 8, n)
        own, at = from_planes(raw, at, n)
        some, at = from_planes(raw, at, m)
        keys.append(np.cumsum(steps.astype(U64)))
        lens.append(own)
        symbols.append(some)
        counts.append(from_planes(raw, at, m)[0])
    begin, start = (np.append(0, np.cumsum([len(x) for x in xs])).tolist() for xs in (keys, symbols))
    # a part's keys share their first bits
    names, number = numbered(np.concatenate(keys) << np.uint64(bits))
    record = np.repeat(number, np.concatenate(lens)) * SYMBOLS + np.concatenate(symbols)
    return names, number, record, np.concatenate(counts), begin, start


def _ordered(code: np.ndarray) -> np.ndarray:
    """An order of whole numbers; sorted numbers with their places are faster than one."""
    width = len(code).bit_length()
    return np.sort(code << width | np.arange(len(code))) & ((1 << width) - 1)


def tell_counts(bits: int):
    """Sums what blocks counted of a part's tokens and tells each block the counts of its own, in order of their hashes.

    Rows without a block say how many tokens of a class (``k``) there are (``v``) and how often all of them occur (``n``).
    """
    def tell(asked: pa.Table) -> pa.Table:
        squeeze, asked = zstandard.ZstdCompressor(level=1), asked.sort_by("block")
        names, number, code, counts, ends, _ = _opened(asked, bits)
        total = np.bincount(code // SYMBOLS, counts, len(names)).astype(np.int64)
        blocks = asked["block"].to_numpy()
        _, edges = _runs(blocks)
        told = []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            ids = number[ends[a]:ends[b]]
            if b - a > 1:  # a block seen by several tasks
                ids = np.unique(ids)
            told.append(squeeze.compress(np.uint32(len(ids)).tobytes() + planes(total[ids])))
        of = class_of(total[total > 0])
        kinds = np.unique(of).tolist()
        more, none = [None] * len(kinds), [None] * len(told)
        return as_table({"block": blocks[edges[:-1]].tolist() + more, "part": asked["part"].to_pylist()[:1] * (len(told) + len(more)),
                         "told": told + more, "k": none + kinds, "v": none + [int((of == k).sum()) for k in kinds],
                         "n": none + [int(total[total > 0][of == k].sum()) for k in kinds]})

    return tell


def tell_paths(bits: int):
    """Sums what blocks counted in a part's contexts and tells each block, for each class it asked for in a context, how
    often the class occurred there and how often another way was taken at each node above it, and of each context how
    many tokens were not new to their text.  Numbers from 64 on are told in eight steps to each doubling (``narrow``).

    The row without a block has the sums of FIXED: places among all their symbols, then numbers.
    """
    def tell(asked: pa.Table) -> pa.Table:
        squeeze, asked = zstandard.ZstdCompressor(level=1), asked.sort_by("block")
        part = asked["part"][0].as_py()
        names, _, record, counts, _, start = _opened(asked, bits)
        order = _ordered(record)
        code, n = record[order], counts[order]
        first, _ = _runs(code // 2)
        pair, seen = code[first] // 2, np.zeros(len(names), np.uint8)
        asks, paths = np.empty(len(record), np.int64), np.empty((BITS + 1, len(pair)), np.uint8)
        asks[order] = np.repeat(np.arange(len(first)), np.diff(first, append=len(code)))
        for lo in range(0, len(names), 1 << 14):
            hi = min(lo + (1 << 14), len(names))
            a, b = np.searchsorted(code, [lo * SYMBOLS, hi * SYMBOLS])
            tree = np.bincount(code[a:b] // 2 - lo * 32, n[a:b], (hi - lo) * 32).reshape(-1, 32)
            seen[lo:hi] = narrow(np.bincount(code[a:b] // SYMBOLS - lo, n[a:b] * (code[a:b] % 2), hi - lo))
            a, b = np.searchsorted(pair, [lo * 32, hi * 32])
            row, node = pair[a:b] // 32 - lo, pair[a:b] % 32
            paths[0, a:b] = narrow(tree[row, node])
            for k in range(1, BITS + 1):  # from the class up
                paths[k, a:b] = narrow(tree[row, node ^ 1])
                tree, node = tree[:, ::2] + tree[:, 1::2], node >> 1
        # FIXED are counted, but not told to each block
        here = np.flatnonzero(FIXED >> np.uint64(64 - bits) == part)
        at = np.minimum(np.searchsorted(names, FIXED[here] << np.uint64(bits)), len(names) - 1)
        asked_for = names[at] == FIXED[here] << np.uint64(bits)
        here, at = here[asked_for], at[asked_for]
        which = np.full(len(names), -1)
        which[at] = here
        mine = which[code // SYMBOLS] >= 0
        sums = np.bincount(which[code[mine] // SYMBOLS] * SYMBOLS + code[mine] % SYMBOLS, n[mine], 0).astype(np.int64)
        there = np.flatnonzero(sums)
        blocks, told = asked["block"].to_pylist(), []
        for a, b in zip(start[:-1], start[1:]):
            some = np.arange(a, b)
            keep = np.append(True, asks[some[1:]] != asks[some[:-1]]) & (which[record[some] // SYMBOLS] < 0)
            some = some[keep]
            key = record[some] // SYMBOLS
            key = key[_runs(key)[0]]
            told.append(squeeze.compress(np.array([len(some), len(key)], np.uint32).tobytes()
                                         + paths[:, asks[some]].tobytes() + seen[key].tobytes()))
        return as_table({"block": [*blocks, None], "part": [part] * (len(blocks) + 1),
                         "told": [*told, np.concatenate([there, sums[there]]).tobytes()]})

    return tell


_WIDE = np.append(np.arange(64.0), 64 * 2 ** (np.arange(192) / 8)).astype(np.float32)


def narrow(n: np.ndarray) -> np.ndarray:
    """Numbers in a byte: as they are below 64, then in eight steps to each doubling (_WIDE)."""
    many = 64 + np.rint(8 * np.log2(np.maximum(n, 64) / 64))
    return np.where(n < 64, n, np.minimum(many, 255)).astype(np.uint8)


def packed_text(names: np.ndarray, ids: np.ndarray, counts: np.ndarray, squeeze) -> bytes:
    """A text's tokens by number, with the count and a 40-bit hash of each number; ``names`` are in order, so
    the hashes are kept as steps."""
    steps = (names >> np.uint64(24)).astype(np.int64)
    steps[1:] -= steps[:-1].copy()
    return squeeze.compress(np.uint32(len(names)).tobytes() + planes(ids) + planes(counts) + planes(steps))


class Texts:
    """Several texts laid end to end: per token its number, count and hash."""

    def __init__(self, rows: list[tuple[int, bytes]], unpack, *, lessons: bool = False):
        """``rows`` are (tokens, packed text); as lessons, texts look as if their own tokens were not counted."""
        ids, counts, steps = [], [], []
        for n, blob in rows:
            raw = unpack.decompress(blob)
            m = int(np.frombuffer(raw, np.uint32, 1)[0])
            own, at = from_planes(raw, 4, n)
            c, at = from_planes(raw, at, m)
            ids.append(own)
            counts += [c, NOUGHT]  # one number more for a text's unknown tokens
            steps += [from_planes(raw, at, m)[0], NOUGHT]
        self.sizes = np.array([n for n, _ in rows])
        self.starts = np.cumsum(self.sizes) - self.sizes
        place = np.arange(self.sizes.sum()) - np.repeat(self.starts, self.sizes)
        numbers = np.array([len(c) for c in counts[::2]]) + 1
        ends = np.cumsum(numbers)
        self.counts = np.concatenate(counts)
        ids = np.concatenate(ids) + np.repeat(ends - numbers, self.sizes)
        names = np.cumsum(np.concatenate(steps))
        names -= np.repeat(np.append(0, names[ends[:-1] - 1]), numbers)
        self.words, self.word = names.astype(U64) << np.uint64(24), ids.astype(np.int32)  # known or not
        self.mark = names >> 24
        self.mark[ends - 1] = 1
        others = np.maximum(self.counts - np.bincount(ids, minlength=len(self.counts)), 0)
        self.asked = class_of(self.counts)[ids], class_of(others)[ids]  # as it is, and as a lesson
        if lessons:
            self.counts = others
        ids = np.where(self.counts[ids] > 0, ids, np.repeat(ends - 1, self.sizes))
        self.classes = class_of(self.counts)[ids]
        # sorted numbers with their places are faster than a stable order of the numbers
        order = np.sort(ids << 32 | np.arange(len(ids))) & 0xFFFFFFFF
        first = np.flatnonzero(np.diff(ids[order], prepend=-1))
        earlier = np.empty(len(order), np.int64)
        earlier[order] = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
        self.copied = earlier / np.maximum(place, 1)  # chance as a copy of an earlier token
        self.ids, self.place = ids.astype(np.int32), place.astype(np.int32)

    def before(self, x: np.ndarray, k: int, none: int) -> np.ndarray:
        """What stands k tokens earlier in the text."""
        out = np.empty(len(x), np.int64)
        out[k:] = x[:-k]
        out[self.place < k] = none
        return out

    def past(self) -> dict[int, np.ndarray]:
        """The contexts of few values: place and whether the last tokens were new, both with classes, and place."""
        early = np.flatnonzero(self.place < 6)
        begun = self.place[early]
        seen, flags = (self.copied > 0).astype(np.uint8), np.zeros(len(self.place), np.uint8)
        for k in range(1, 7):
            flags[k:] |= seen[:-k] << np.uint8(k - 1)
        flags[early] &= ((1 << begun) - 1).astype(np.uint8)
        flags = flags.astype(np.int64)
        depth = np.floor(np.log2(np.arange(1, self.sizes.max() + 1))).astype(np.int64)[self.place]
        c1, c2 = self.before(self.classes, 1, 32), self.before(self.classes, 2, 32)
        return {0: depth * 8 + flags % 8, 3: flags * 40 + c1, 4: c1 * 33 + c2, 5: depth}

    def contexts(self) -> list[np.ndarray]:
        """Hashed contexts, for counters in tables of SLOTS."""
        past, marks = self.past(), self.mark[self.ids]
        m1, m2 = self.before(marks, 1, 1 << 17), self.before(marks, 2, 1 << 17)
        return [_PAST[0][past[0]], _context(1, m1), _context(2, m2 * 70_001 + m1),
                _PAST[3][past[3]], _PAST[4][past[4]], _PAST[5][past[5]]]

    def symbols(self) -> np.ndarray:
        """What counters are told of each token: its class, and whether the text has had it."""
        return self.classes.astype(np.int64) * 2 + (self.copied > 0)

    def bits(self) -> tuple[np.ndarray, np.ndarray]:
        """Class bits (BITS, tokens) and the node of the class tree each is taken at."""
        shift = np.arange(BITS - 1, -1, -1, dtype=np.uint8)[:, None]
        classes = self.classes
        first = np.uint32(1) << np.arange(BITS, dtype=np.uint32)[:, None]
        return classes >> shift & 1, first + (classes >> (shift + 1)) + np.uint32(1)


def _context(k: int, x: np.ndarray) -> np.ndarray:
    return mixed((x + (k << 40)).astype(U64)).astype(np.uint32)


_CLASS = np.append(np.arange(32), 1 << 17)  # 32: before the text
_PAST = {0: _context(0, np.arange(64 * 8)), 3: _context(3, np.arange(64 * 40)),
         4: _context(4, (_CLASS[:, None] * 1000 + _CLASS).ravel()), 5: _context(5, np.arange(64))}  # contexts of few values
_SPREAD = np.uint32(0x9E3779B1)


def slot(context: np.ndarray, node: np.ndarray | np.uint32) -> np.ndarray:
    """Counter of a context, among its SLOTS, at a node; node 0 is the source decision."""
    out = context + node
    out *= _SPREAD
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x85EBCA6B)
    out >>= np.uint32(16)
    return out


# values of contexts of few values, of which every block asks all, and where those of a context begin
_VALUES = {0: 64 * 8, 3: 64 * 40, 4: 33 * 33, 5: 64}
_BEGIN = dict(zip(_VALUES, np.append(0, np.cumsum(list(_VALUES.values())))[:-1].tolist()))
FIXED = mixed(np.arange(sum(_VALUES.values()), dtype=U64) + np.uint64(1 << 50)) >> np.uint64(20) << np.uint64(20)


def keyed(batches: list[Texts]) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The keys of all contexts that tokens of some texts may have, in order; the numbers of FIXED among them; per
    batch those of each token's context of one and of two tokens before."""
    place = np.concatenate([t.place for t in batches])
    names, number = numbered(np.concatenate([t.words for t in batches]))
    ends = np.append(0, np.cumsum([len(t.words) for t in batches]))
    number = np.concatenate([number[a:][t.word] for a, t in zip(ends.tolist(), batches)])
    none = len(names)  # before the text
    one = np.append(none, number[:-1])
    one[place == 0] = none
    two = np.append(none, one[:-1])
    two[place == 0] = none
    shift = np.uint64(64 - ((none + 1) ** 2).bit_length())
    pairs, at = numbered((two * (none + 1) + one).astype(U64) << shift)
    del two, number
    pairs = (pairs >> shift).astype(np.int64)
    names = np.append(names, np.uint64(1))
    single = mixed(names + np.uint64(2))
    double = mixed(single[pairs // (none + 1)] + names[pairs % (none + 1)])
    keys, rank = numbered(np.concatenate([FIXED, single, double]) >> np.uint64(20) << np.uint64(20))
    del pairs, single, double
    rank = rank.astype(np.int32)
    one, two = rank[len(FIXED):len(FIXED) + none + 1][one], rank[len(FIXED) + none + 1:][at]
    edges = np.append(0, np.cumsum([len(t.place) for t in batches])).tolist()
    return keys, rank[:len(FIXED)], [(one[a:b], two[a:b]) for a, b in zip(edges[:-1], edges[1:])]


def node_rows(counts: np.ndarray) -> np.ndarray:
    """Predictions at all nodes, a row for each row of counts of symbols."""
    counts = counts.reshape(-1, 32, 2)
    out, tree = np.zeros((len(counts), NODES), np.float32), counts.sum(axis=2)
    seen = np.log(counts.sum(axis=1) + 0.4)
    out[:, 0] = seen[:, 1] - seen[:, 0]
    for b in reversed(range(BITS)):
        logs = np.log(tree + 0.4)
        out[:, (1 << b) + 1:(2 << b) + 1] = logs[:, 1::2] - logs[:, ::2]
        tree = tree[:, ::2] + tree[:, 1::2]
    return out


class Rows:
    """A context whose predictions are rows of a table, by node: ``base`` is where the row of each token begins."""

    def __init__(self, table: np.ndarray, base: np.ndarray):
        self.table, self.base = table, base

    def __getitem__(self, at) -> Rows:
        return type(self)(self.table, self.base[at])

    def inputs(self, gate: int, node, bit) -> np.ndarray:
        return self.table.take(self.base + node)


class Paths(Rows):
    """A context whose rows are predictions of what happened, by bits of the class."""

    def inputs(self, gate: int, node, bit) -> np.ndarray:
        return self.table.take(self.base + (gate - 1)) * (2 * bit.astype(np.float32) - 1)


class Block:
    """The documents of a block in batches, short ones first (a batch takes as many steps as its longest text has
    tokens), and the keys of their contexts.  With ``lessons`` training documents are apart and look as lessons."""

    def __init__(self, docs: pa.Table, size: int, *, lessons: bool):
        unpack, self.lessons = zstandard.ZstdDecompressor(), lessons
        sizes, out, codes = docs["n_tokens"].to_numpy(), np.array(docs["out"].to_pylist(), bool), docs["codes"].to_pylist()
        self.rows, self.taught, self.batches = [], [], []
        for chosen in (~out, out) if lessons else (np.ones(len(out), bool),):
            by_length = sorted(np.flatnonzero(chosen).tolist(), key=sizes.__getitem__)
            for some in batches_of([(k, int(sizes[k]), codes[k]) for k in by_length], size):
                self.rows.append([k for k, *_ in some])
                self.taught.append(lessons and not out[some[0][0]])
                self.batches.append(Texts([r[1:] for r in some], unpack, lessons=self.taught[-1]))
        self.keys, self.fixed, self.ranks = keyed(self.batches)

    def listen(self, told: pa.Table, mixer: Mixer) -> None:
        """Take in what all parts told, for contexts of one and two tokens; ``mixer`` has the others."""
        self.mask = np.zeros(len(self.keys), np.uint32)  # classes asked for, by context
        for texts, ranks in zip(self.batches, self.ranks):
            for classes in texts.asked:
                for x in ranks:
                    np.bitwise_or.at(self.mask, x, np.uint32(1) << classes.astype(np.uint32))
        each = np.bitwise_count(self.mask).astype(np.int32)
        self.begin, some = np.cumsum(each, dtype=np.int32) - each, each > 0
        self.row = np.cumsum(some, dtype=np.int32) - 1
        unpack, paths, seen = zstandard.ZstdDecompressor(), [], []
        for blob in told.sort_by("part")["told"].to_pylist():
            raw = unpack.decompress(blob)
            n, m = np.frombuffer(raw, np.uint32, 2).tolist()
            paths.append(np.frombuffer(raw, np.uint8, (BITS + 1) * n, 8).reshape(BITS + 1, n))
            seen.append(np.frombuffer(raw, np.uint8, m, 8 + (BITS + 1) * n))
        paths, seen = np.concatenate(paths, axis=1), _WIDE[np.concatenate(seen)]
        if paths.shape[1] != each.sum() or len(seen) != some.sum():
            raise RuntimeError("the documents were not the same when they were read again")
        less = np.float32(self.lessons)  # a lesson is not to be predicted from itself
        own, steps = _WIDE[paths[0]], np.empty((paths.shape[1], BITS), np.float32)
        for k in range(1, BITS + 1):
            other = _WIDE[paths[k]]
            steps[:, BITS - k] = np.log(np.maximum(own - less, 0) + np.float32(0.4)) - np.log(other + np.float32(0.4))
            own += other
        del paths, other
        new = np.maximum(own[self.begin[some]] - seen, 0)
        source = np.log(np.stack([seen, np.maximum(seen - less, 0)], axis=1) + np.float32(0.4))
        source -= np.log(np.stack([np.maximum(new - less, 0), new], axis=1) + np.float32(0.4))
        self.steps, self.source, self.known = steps.ravel(), source.ravel(), mixer.known
        if self.lessons:
            for x in (self.steps, self.source):
                np.rint(x * FINE[0], out=x)
            self.known = np.rint(mixer.known * FINE[0])

    def contexts(self, k: int) -> tuple[list[Rows], list[Rows]]:
        """The contexts of batch k, for classes and for the source."""
        texts = self.batches[k]
        past = {c: Rows(self.known, ((_BEGIN[c] + x) * NODES).astype(np.int32)) for c, x in texts.past().items()}
        below, seen = (np.uint32(1) << texts.classes.astype(np.uint32)) - np.uint32(1), texts.copied > 0
        path = [Paths(self.steps, (self.begin[x] + np.bitwise_count(self.mask[x] & below)) * BITS) for x in self.ranks[k]]
        source = [Rows(self.source, self.row[x] * 2 + seen) for x in self.ranks[k]]
        return tuple([past[0], *x, past[3], past[4], past[5]] for x in (path, source))


def asker(bits: int):
    """What a block asks of the counters: a key for each context, with the symbols its training documents have there and
    the classes whose paths it needs."""
    def ask(docs: pa.Table) -> pa.Table:
        block, squeeze = Block(docs, 240_000, lessons=True), zstandard.ZstdCompressor(level=1)
        codes, wanted, past = [NOUGHT[:0]], [NOUGHT[:0]], np.zeros(len(FIXED) * SYMBOLS, np.int64)
        for taught, texts, ranks in zip(block.taught, block.batches, block.ranks):
            symbols, (full, lesson) = texts.symbols(), texts.asked
            if taught:
                codes += [x * np.int64(SYMBOLS) + symbols for x in ranks]
                for c, x in texts.past().items():
                    past += np.bincount((_BEGIN[c] + x) * SYMBOLS + symbols, minlength=len(past))
            else:
                wanted += [x * np.int64(SYMBOLS) + lesson * np.int64(2) for x in ranks]
            more = np.flatnonzero(full != lesson) if taught else slice(None)
            wanted += [x[more] * np.int64(SYMBOLS) + full[more] * np.int64(2) for x in ranks]
        codes, wanted = np.sort(np.concatenate(codes)), np.sort(np.concatenate(wanted))
        first, edges = _runs(codes)
        wanted, at = wanted[_runs(wanted)[0]], np.flatnonzero(past)
        fixed = block.fixed[at // SYMBOLS] * np.int64(SYMBOLS) + at % SYMBOLS
        code = np.concatenate([codes[first], wanted, fixed])
        counts = np.concatenate([np.diff(edges), np.zeros(len(wanted), np.int64), past[at]])
        order = np.argsort(code, kind="stable")
        code, counts = code[order], counts[order]
        lens = np.bincount(code // SYMBOLS, minlength=len(block.keys))
        parts = list(parcels(block.keys, lens, code % SYMBOLS, counts, bits, squeeze))
        return as_table({"part": [p for p, _ in parts], "block": docs["block"].to_pylist()[:1] * len(parts),
                         "asked": [x for _, x in parts]})

    return ask


def stretch(p: np.ndarray) -> np.ndarray:
    return np.log(p) - np.log1p(-p)


class Mixer:
    """The weights mixing starts from, and the mass of each class.

    Predictions come with the contexts (``Rows``), or from tables of SLOTS counters for each context, of hashed contexts.
    """

    def __init__(self, zeros: np.ndarray | None, ones: np.ndarray | None, mass: np.ndarray):
        if zeros is not None:
            self.stretched = stretch((ones + 0.4) / (zeros + ones + 0.8)).astype(np.float32).reshape(CONTEXTS, SLOTS)
            self.rounded = np.rint(self.stretched * np.float32(FINE[0])).astype(float)
        self.weights = np.full((GATES, CONTEXTS + 1), 0.25, np.float32)
        self.weights[:, -1] = 0.0
        self.mass = mass
        self.known = None  # predictions of FIXED

    def run(self, sizes: np.ndarray, gates: list[int], contexts: list[np.ndarray], nodes: np.ndarray, odds: np.ndarray,
            known: bool, lane: int | None = LANE) -> tuple[np.ndarray, list]:
        """Chance of what happened at each decision (gates, tokens), and the mean of the last weights by gate.

        ``sizes`` are the tokens of each text, each with a decision of every gate at its node.  A text is one lane, or
        cut into lanes of ``lane`` decisions; lanes are mixed side by side, and every lane begins with the starting
        weights, so a text's chances do not depend on its company.  If the bits are ``known``, ``odds`` are they; else they are
        the chances of what happened if a bit is one, against those if it is zero.  Long lanes come first, so those
        that still run at a step are the first ones, and the tokens of a step lie side by side.  A gate's weights
        are its own, so the gates of a token take their step together.
        """
        per = max(int(sizes.max()), 1) if lane is None else lane // len(gates)  # tokens of a lane
        own = -(-sizes // per)
        lanes = int(own.sum())
        nth = np.arange(lanes) - np.repeat(np.cumsum(own) - own, own)  # lane of its text
        long = np.minimum(np.repeat(sizes, own) - nth * per, per)
        order = np.argsort(-long, kind="stable")
        rank = np.empty(lanes, np.int64)
        rank[order] = np.arange(lanes)
        running = np.searchsorted(-long[order], -np.arange(per), "left")  # lanes with more than t tokens
        starts = np.cumsum(running) - running
        n_all = int(long.sum())
        step = np.arange(n_all) - np.repeat(np.cumsum(long) - long, long)
        at = starts[step] + np.repeat(rank, long)
        turn = np.empty(n_all, np.int64)
        turn[at] = np.arange(n_all)
        ends = starts + running
        # weights with the sign turned, as the exponential wants them
        weights = np.repeat(-self.weights[gates].T[:, :, None], lanes, axis=2)
        change, out = np.empty_like(weights), np.empty((len(gates), n_all), np.float32)
        at = 0
        while at < per and running[at]:  # steps of about TOGETHER tokens have their inputs together
            until = max(at + 1, int(np.searchsorted(ends, starts[at] + TOGETHER, "right")))
            some = turn[starts[at]:ends[until - 1]]
            inputs = np.empty((CONTEXTS + 1, len(gates), len(some)), np.float32)
            node, bits = nodes[:, some], odds[:, some].astype(np.float32)
            for k in range(CONTEXTS):
                context = contexts[k][some]
                for g in range(len(gates)):
                    if isinstance(context, Rows):
                        inputs[k, g] = context.inputs(gates[g], node[g], bits[g])
                    else:
                        np.take(self.stretched[k], slot(context, node[g]), out=inputs[k, g], mode="clip")
            inputs[-1] = OFFSET  # so it adapts faster
            for a, n in zip((starts[at:until] - starts[at]).tolist(), running[at:until].tolist()):
                if n == 0:
                    break
                w, x, bit = weights[:, :, :n], inputs[:, :, a:a + n], bits[:, a:a + n]
                p = np.einsum("kgl,kgl->gl", w, x)
                np.minimum(np.maximum(p, -12, out=p), 12, out=p)
                np.exp(p, out=p)
                p += 1
                np.reciprocal(p, out=p)
                whole = out[:, starts[at] + a:starts[at] + a + n]
                if known:  # p where the bit is one, else 1 - p
                    np.subtract(p, 1 - bit, out=whole)
                    p -= bit
                else:
                    yes = p * bit
                    np.subtract(1, p, out=whole)
                    whole += yes
                    yes /= whole
                    p -= yes
                p *= np.float32(0.004)
                w += np.multiply(p, x, out=change[:, :, :n])
            at = until
        chances = np.empty((len(gates), n_all))
        chances[:, turn] = np.abs(out)
        return chances, [(g, w) for g, w in zip(gates, -weights.mean(axis=2).T)]

    def score(self, texts: Texts, lane: int | None = LANE, contexts: tuple[list, list] | None = None) -> tuple[np.ndarray, list]:
        """log10 probability of each text, and the weights at the end of the lanes; ``contexts`` are those for classes
        and for the source."""
        contexts, source = contexts or [texts.contexts()] * 2
        bits, nodes = texts.bits()
        spelt, last = self.run(texts.sizes, list(range(1, GATES)), contexts, nodes, bits, True, lane)
        whole = spelt.prod(axis=0) * ((texts.counts + 0.1) / self.mass[class_of(texts.counts)])[texts.ids]
        at = np.flatnonzero(texts.place > 0)  # the first token cannot be a copy
        if len(at):
            # chances are relative to the drawn one, which may be tiny
            ratio, more = self.run(texts.sizes - 1, [0], [c[at] for c in source], np.zeros((1, len(at)), np.uint32),
                                   (texts.copied[at] / whole[at])[None], False, lane)
            whole[at] *= ratio[0]
            last = last + more
        return np.add.reduceat(np.log10(whole), texts.starts), last

    def moments(self, texts: Texts, contexts: tuple[list, list] | None = None) -> np.ndarray:
        """Per gate, at the weights 0.25: (curvature, gradient) of the texts' decisions, CONTEXTS + 1 rows of one
        more column, in the whole numbers of FINE."""
        contexts, source = contexts or [texts.contexts()] * 2
        bits, nodes = texts.bits()
        out = np.zeros((GATES, CONTEXTS + 1, CONTEXTS + 2))

        def gate(g: int, contexts: list, node, bit, target) -> np.ndarray:
            x = np.empty((CONTEXTS + 1, len(bit)))
            for k, context in enumerate(contexts):
                if isinstance(context, Rows):
                    x[k] = context.inputs(g, node, bit)
                else:
                    np.take(self.rounded[k], slot(context, node), out=x[k], mode="clip")
            x[-1] = np.rint(OFFSET * FINE[0])
            p = np.clip(-0.25 / FINE[0] * x[:-1].sum(axis=0), -12, 12)
            p = 1 / (1 + np.exp(p, out=p))
            out[g, :, :-1] = (x * np.rint(p * (1 - p) * FINE[2])) @ x.T
            out[g, :, -1] = x @ np.rint((target(p) - p) * FINE[1])
            return p

        drawn = ((texts.counts + 0.1) / self.mass[class_of(texts.counts)])[texts.ids]
        for b in range(BITS):
            bit = bits[b]
            p = gate(1 + b, contexts, nodes[b], bit, lambda p: bit)
            drawn *= np.where(bit, p, 1 - p)
        at = np.flatnonzero(texts.place > 0)
        odds = texts.copied[at] / drawn[at]  # of a copy; which source it was is not known
        gate(0, [c[at] for c in contexts], np.uint32(0), (odds > 0).astype(np.uint8), lambda p: p * odds / (p * odds + 1 - p))
        return out.astype(np.int64)

    def start_from(self, moments: np.ndarray) -> None:
        """Take as starting weights one Newton step from 0.25 with the summed moments."""
        for g in range(GATES):
            curvature = moments[g, :, :-1].astype(float) / (FINE[0] ** 2 * FINE[2])
            step = np.linalg.solve(curvature + RIDGE * np.eye(CONTEXTS + 1), moments[g, :, -1].astype(float) / (FINE[0] * FINE[1]))
            self.weights[g] += step.astype(np.float32)


def fit(mixer: Mixer, lessons: DataFrame, told: DataFrame | None = None) -> None:
    """Fit the starting weights on all rows (n_tokens, codes); a task returns a few hundred sums.

    With ``told`` rows also have ``block`` and ``out``, those that are ``out`` are not learnt from, and counters are
    what blocks were told.
    """
    shipped = sent(lessons.sparkSession, mixer)
    kind = "place int, n bigint"

    def work(slices):
        here, unpack = cloudpickle.loads(shipped.value), zstandard.ZstdDecompressor()
        total = np.zeros((GATES, CONTEXTS + 1, CONTEXTS + 2), np.int64)
        for rows in slices:
            for some in batches_of(rows):
                total += here.moments(Texts(some, unpack, lessons=True))
        yield {"place": np.arange(total.size), "n": total.ravel()}

    def block_work(docs: pa.Table, told: pa.Table) -> pa.Table:
        here, block = cloudpickle.loads(shipped.value), Block(docs, 80_000, lessons=True)
        block.listen(told, here)
        total = np.zeros((GATES, CONTEXTS + 1, CONTEXTS + 2), np.int64)
        for k, texts in enumerate(block.batches):
            if block.taught[k]:
                total += here.moments(texts, block.contexts(k))
        return pa.table({"place": np.arange(total.size, dtype=np.int32), "n": total.ravel()})

    if told is None:
        sums = by_arrow(lessons.select("n_tokens", "codes"), work, kind)
    else:
        sums = lessons.select("block", "out", "n_tokens", "codes").groupBy("block").cogroup(
            told.groupBy("block")).applyInArrow(block_work, kind)
    summed = sums.groupBy("place").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))
    moments = np.zeros(GATES * (CONTEXTS + 1) * (CONTEXTS + 2))
    for r in summed.collect():
        moments[r["place"]] = float(r["n"])
    mixer.start_from(moments.reshape(GATES, CONTEXTS + 1, CONTEXTS + 2))


def batches_of(rows: list[tuple], size: int = 80_000):
    """Cut rows (last: tokens, packed text) where about ``size`` tokens are together."""
    held, n = [], 0
    for row in rows:
        held.append(row)
        n += row[-2]
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    blocks = max(1, -(-docs.count() // BLOCK))
    bits = max(3, (blocks // 2).bit_length())  # of a key's hash, which choose its part
    # the vocabulary is not needed once texts have their counts, nor what was shuffled for a table once it is written
    with scope(docs.sparkSession), shuffles_removed(docs.sparkSession):
        table, n_all, mass = _coded(docs, doc_id, text, blocks, bits)
        told = settle(_told(table, bits), lasting=True)
        mixer = Mixer(None, None, mass)
        sums = np.zeros(len(FIXED) * SYMBOLS)
        for r in told.where("block IS NULL").select("told").collect():  # some for each of FIXED
            place, n = np.frombuffer(r["told"], np.int64).reshape(2, -1)
            sums[place] = n
        mixer.known = node_rows(sums).ravel()
        told = told.where("block IS NOT NULL")
        fit(mixer, table, told)
    return _scored(docs, table, told, n_all, mixer)


def _coded(docs: DataFrame, doc_id: str, text: str, blocks: int, bits: int) -> tuple[DataFrame, int, np.ndarray]:
    """The table of coded texts with their base scores, the number of training tokens and the mass of each class."""
    out = held_out(doc_id, 10, 0)
    base = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), doc_key(doc_id, text).alias("doc"),
                       out.alias("out"), as_bytes(text).alias("text")).withColumn(
        "block", F.when(F.col("doc_id").isNull(), -1 - F.pmod("doc", F.lit(blocks))).otherwise(F.floor(F.col("doc") / BLOCK)))
    counts = settle(_vocabulary(base.select("block", "out", "text"), bits).groupBy("part").applyInArrow(
        tell_counts(bits), TOLD + SIZES))
    by_class = counts.where("k IS NOT NULL").groupBy("k").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    n_all, v_all = sum(r["n"] for r in by_class), sum(r["v"] for r in by_class)
    mass = np.full(32, 0.1)  # class 0: the one unknown token
    for r in by_class:
        mass[r["k"]] = r["n"] + 0.1 * r["v"]
    whole = np.log10(n_all + 0.1 * (v_all + 1))
    packed = pack(base.select(F.struct("doc_id", "out", "block").alias("doc"), "text"),
                  "struct<doc_id: bigint, out: boolean, block: bigint>").select("doc.*", "packed")

    def encode(texts: pa.Table, told: pa.Table) -> pa.Table:
        unpack, squeeze = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        sizes, held = [], []
        for raw in texts["packed"]:
            plain = unpack.decompress(raw.as_py())
            sizes.append(len(plain))
            held.append(tokens(plain))
        names, number = numbered(np.concatenate(held))
        counts = []
        for blob in told.sort_by("part")["told"].to_pylist():
            raw = unpack.decompress(blob)
            counts.append(from_planes(raw, 4, int(np.frombuffer(raw, np.uint32, 1)[0]))[0])
        counts = np.concatenate(counts)
        if len(counts) != len(names):
            raise RuntimeError("the documents were not the same when they were read again")
        logs, place, begin = np.log10(counts + 0.1) - whole, np.empty(len(names), np.int64), 0
        rows = []
        for own in held:
            all_of = number[begin:begin + len(own)]
            begin += len(own)
            used = np.sort(all_of)
            used = used[_runs(used)[0]]
            place[used] = np.arange(len(used))
            rows.append((len(own), int(np.count_nonzero(counts[all_of])), float(logs[all_of].sum()),
                         packed_text(names[used], place[all_of], counts[used], squeeze)))
        n_tokens, n_known, base_score, codes = map(list, zip(*rows))
        return pa.table({"block": texts["block"], "doc_id": texts["doc_id"], "out": texts["out"], "n_tokens": n_tokens,
                         "n_known": n_known, "n_bytes": sizes, "base_score": base_score, "codes": codes})

    table = settle(packed.groupBy("block").cogroup(counts.where("block IS NOT NULL").select("block", "part", "told").groupBy("block"))
                   .applyInArrow(encode, "block bigint, doc_id bigint, out boolean, n_tokens bigint, n_known bigint, "
                                         "n_bytes bigint, base_score double, codes binary"),
                   lasting=True, deal=("block", 2 * blocks))
    return table, int(n_all), mass


def _told(table: DataFrame, bits: int) -> DataFrame:
    """What each block is told of the counters of its contexts."""
    return (table.select("block", "out", "n_tokens", "codes").groupBy("block").applyInArrow(asker(bits), ASKED)
            .groupBy("part").applyInArrow(tell_paths(bits), TOLD))


def _scored(docs: DataFrame, table: DataFrame, told: DataFrame, n_all: int, mixer: Mixer) -> DataFrame:
    shipped = sent(docs.sparkSession, mixer)

    def score(docs: pa.Table, told: pa.Table) -> pa.Table:
        here, block = cloudpickle.loads(shipped.value), Block(docs, 320_000, lessons=False)
        block.listen(told, here)
        scores = np.empty(len(docs))
        for k, texts in enumerate(block.batches):
            scores[block.rows[k]] = here.score(texts, None, block.contexts(k))[0]
        return docs.drop_columns(["block", "codes"]).append_column("score", pa.array(scores))

    got = table.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        score, "doc_id bigint, out boolean, n_tokens bigint, n_known bigint, n_bytes bigint, base_score double, score double")
    return got.select("doc_id", F.col("out").alias("held_out"), "n_tokens", "n_known", F.lit(n_all).cast("bigint").alias("train_tokens"),
                      "base_score", "score",
                      (-F.col("score") / float(np.log10(2)) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"))
