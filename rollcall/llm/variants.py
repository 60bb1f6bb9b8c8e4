"""Spelling variant grouping (operator 11) by a trie of frequency vectors.

A word's vector counts its letters by group (code point modulo the number of levels).  The trie has one level
for each group and a branch for each count, so words with equal vectors share a leaf.  One inserted letter
raises one count by 1; a replaced letter raises one and lowers another, or stays within its group.  The
depth-first search for a word's near words therefore walks down with a budget of one surplus and one deficit,
the surplus first: of each pair of near words exactly one side finds the other this way (for equal vectors the
smaller word).  Words of a leaf that share the first or second half with the searcher are verified letter by letter.

The upper levels are walked in Spark and the lower ones in tasks: rows are words with the path of a node and
what has been spent so far.  A node of more than BLOCK words is opened by one more level, and only there; paths
to nodes that do not exist are dropped.  Nodes small enough are built as tries in tasks, one at a time, and
searchers stream past.  A node whose searchers exceed QUERIES, or that can't be opened further, is dealt to
several tasks, each with a part of both.

Defined results: null and empty texts have no words; a null id reads as no characters in the hash that spoils
runs; repeated rows count as often as they occur; of near words with equal counts the first in code-point order
is the form; a word without near words is its own root; empty tables give empty tables; further columns are
not read.
"""

from __future__ import annotations

from collections import Counter
from operator import ne
from zlib import crc32

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.lineage import settle
from rollcall.llm.tasks import by_arrow

# groups in the order of the trie's levels, those with more frequent letters first; 10 levels
ORDER = (1, 7, 0, 5, 4, 6, 8, 9, 2, 3)
LEVELS = len(ORDER)
START = 2  # levels walked before nodes are counted
BLOCK = 20_000  # words of a trie in a task
QUERIES = 200_000  # searchers that stream past one trie
HELD = 200_000  # distinct words a task counts before it passes them on

LETTERS = [c for c in range(256) if 0x61 <= c <= 0x7A or c >= 0xC0]
# of Latin-1 bytes: letters, A-Z as a-z; all others separate runs
RUNS = bytes(c if c in LETTERS else 0x20 for c in bytes(range(256)).lower())
GROUPS = bytes(ORDER.index(c % LEVELS) if c in LETTERS else 0xFF for c in range(256))


def tally(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", spoil: int = 31, shortest: int = 7,
          least: int = 2) -> DataFrame:
    """(word, n): runs of letters, some spoilt by a deletion that a hash of id and run decides, and their counts."""
    def work(slices):
        held = Counter()

        def flush():
            return {"word": [w.decode("latin-1") for w in held], "n": list(held.values())}

        for rows in slices:
            for name, whole in rows:
                seed = crc32(f"{name}:".encode())
                # all letters of a run are Latin-1, so whatever is not becomes a separator
                for run, n in Counter(whole.encode("latin-1", "replace").translate(RUNS).split()).items():
                    h = crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
                    if h % spoil == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1:]
                    if len(run) >= shortest:
                        held[run] += n
            if len(held) >= HELD:
                yield flush()
                held.clear()
        yield flush()

    texts = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")),
                        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    return by_arrow(texts, work, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(
        F.col("n") >= least)


def vector(word: str) -> list[int]:
    groups = word.encode("latin-1").translate(GROUPS)
    return [groups.count(level) for level in range(LEVELS)]


def at_level(level: int):
    """Count of a word's letters in the group of a level."""
    letters = "".join(chr(c) for c in LETTERS if GROUPS[c] == level)
    return F.char_length("word") - F.char_length(F.translate("word", letters, ""))


def deeper(members: DataFrame, level: int) -> DataFrame:
    return members.withColumn("path", F.concat("path", F.lit("."), at_level(level).cast("string")))


def walked(seekers: DataFrame, level: int) -> DataFrame:
    """One level down by all ways that are left: state 0 has spent nothing, 1 the surplus, 2 both."""
    c, state = F.col("c"), F.col("state")

    def way(change, after):
        return F.struct(F.concat("path", F.lit("."), (c + change).cast("string")).alias("path"), after.cast("int").alias("state"))

    spent = F.when(state == 0, way(1, F.lit(1))).when((state == 1) & (c > 0), way(-1, F.lit(2)))
    ways = seekers.withColumn("c", at_level(level)).select("word", "n", F.explode(F.array(way(0, state), spent)).alias("way"))
    return ways.where("way IS NOT NULL").select("word", "n", "way.path", "way.state")


def blocks(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (word, n, path) and seekers (word, n, path, state) of the nodes whose tries tasks build."""
    members = words.withColumn("path", F.lit(""))
    seekers = words.withColumns({"path": F.lit(""), "state": F.lit(0)})
    for level in range(START):
        members, seekers = deeper(members, level), walked(seekers, level)
    done = []
    for level in range(START, LEVELS + 1):
        members = settle(members)
        sizes = members.groupBy("path").agg(F.count(F.lit(1)).alias("size"))
        fits = F.lit(True) if level == LEVELS else F.col("size") <= BLOCK
        members, seekers = (settle(x.join(sizes, "path").withColumn("fits", fits)) for x in (members, seekers))
        done.append((members.where("fits").select("word", "n", "path"),
                     seekers.where("fits").select("word", "n", "path", "state")))
        members, seekers = members.where("NOT fits").drop("size", "fits"), seekers.where("NOT fits").drop("size", "fits")
        if level == LEVELS or members.isEmpty():
            break
        members, seekers = deeper(members, level), walked(seekers, level)
    first, *rest = done
    for more in rest:
        first = tuple(a.unionByName(b) for a, b in zip(first, more))
    return first


def dealt(members: DataFrame, seekers: DataFrame) -> DataFrame:
    """Both kinds of rows (role 0 and 1) by node, members first; crowded nodes in several parts."""
    parts = (members.groupBy("path").agg(F.count(F.lit(1)).alias("m"))
             .join(seekers.groupBy("path").agg(F.count(F.lit(1)).alias("q")), "path")
             .select("path", F.ceil(F.col("m") / BLOCK).cast("int").alias("own"),
                     F.ceil(F.col("q") / QUERIES).cast("int").alias("asked")))
    crowded = settle(parts.where("own > 1 OR asked > 1"))
    split = not crowded.isEmpty()

    def part(n):
        return F.pmod(F.xxhash64("word", F.lit("part")), F.coalesce(F.col(n), F.lit(1))).cast("int")

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.coalesce(F.col(n), F.lit(1)) - 1))

    both = []
    for role, rows in enumerate((members.withColumn("state", F.lit(0)), seekers)):
        rows = rows.select("path", "state", "word", "n", F.lit(role).alias("role"))
        if split:  # each part of the members meets each part of the seekers
            own, asked = (part("own"), every("asked")) if role == 0 else (every("own"), part("asked"))
            rows = rows.join(crowded, "path", "left").withColumn("mine", own).withColumn("theirs", asked).drop("own", "asked")
        else:
            rows = rows.withColumns({"mine": F.lit(0), "theirs": F.lit(0)})
        both.append(rows)
    node = ("path", "mine", "theirs")
    return both[0].unionByName(both[1]).repartition(*node).sortWithinPartitions(*node, "role")


class Trie:
    """Words below one node, by their remaining counts and, in the leaves, by halves."""

    def __init__(self, depth: int):
        self.depth, self.root = depth, {}

    def add(self, word: str, n: int) -> None:
        node = self.root
        for c in vector(word)[self.depth:]:
            node = node.setdefault(c, {})
        size = len(word)
        half, less = size // 2, (size - 1) // 2
        # keys by which a word of the same length, or one that is a letter shorter, finds it
        for key in ("=<" + word[:half], "=>" + word[half:], "+<" + word[:less], "+>" + word[less + 1:]):
            node.setdefault(key, []).append((word, n))

    def near(self, word: str, state: int):
        """Words that differ from ``word`` by one code point and lie on the ways left in ``state``."""
        counts, half = vector(word), len(word) // 2
        head, tail = word[:half], word[half:]
        ways = [(self.root, self.depth, state)]
        while ways:
            node, depth, spent = ways.pop()
            while depth < LEVELS:
                c = counts[depth]
                depth += 1
                if spent < 2:
                    other = node.get(c + 1 if spent == 0 else c - 1)
                    if other is not None:
                        ways.append((other, depth, spent + 1))
                node = node.get(c)
                if node is None:
                    break
            else:
                if spent == 1:
                    for found in node.get("+<" + head, ()):
                        if longer(word, found[0]):
                            yield found
                    for found in node.get("+>" + tail, ()):
                        if not found[0].startswith(head) and longer(word, found[0]):
                            yield found
                else:
                    for key in ("=<" + head, "=>" + tail):
                        for found in node.get(key, ()):
                            # equal vectors are met from both sides
                            if (spent == 2 or word < found[0]) and sum(map(ne, word, found[0])) == 1:
                                yield found


def longer(word: str, other: str) -> bool:
    """Whether ``other`` is ``word`` with one more code point somewhere."""
    at = next((k for k, (a, b) in enumerate(zip(word, other)) if a != b), len(word))
    return len(other) == len(word) + 1 and word[at:] == other[at + 1:]


def links(words: DataFrame) -> DataFrame:
    """(word, near, near_n), each pair of near words in both directions."""
    def work(slices):
        node = trie = None
        for rows in slices:
            out = {"word": [], "near": [], "near_n": []}
            for path, mine, theirs, role, state, word, n in rows:
                if (path, mine, theirs) != node:
                    node, trie = (path, mine, theirs), Trie(path.count("."))
                if role == 0:
                    trie.add(word, n)
                    continue
                for other, other_n in trie.near(word, state):
                    out["word"] += (word, other)
                    out["near"] += (other, word)
                    out["near_n"] += (other_n, n)
            if out["word"]:
                yield out

    rows = dealt(*blocks(words)).select("path", "mine", "theirs", "role", "state", "word", "n")
    return by_arrow(rows, work, "word string, near string, near_n bigint")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): chains of forms are halved until none is left."""
    jumps = settle(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = jumps.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        further = settle(jumps.join(ahead, "root", "left"))
        if further.where("ahead IS NOT NULL").isEmpty():
            return jumps
        jumps = further.select("word", F.coalesce("ahead", "root").alias("root"))


def report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", spoil: int = 31, shortest: int = 7,
           least: int = 2, times: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n: a word's form is its most frequent near word, if ``times`` as frequent."""
    words = settle(tally(docs, doc_id=doc_id, text=text, spoil=spoil, shortest=shortest, least=least))
    near = links(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("top"))
    most = -F.col("top.less")
    form = most >= times * F.col("n")
    found = settle(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(form, F.col("top.near")).alias("form"), F.when(form, most).alias("form_n")))
    return found.join(roots(found.where("form IS NOT NULL")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
