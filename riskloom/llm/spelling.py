"""Spelling variants by a trie over letter-group counts.

The letters of the alphabet fall into groups; a word is the vector of its counts per group.
Words one edit apart have vectors that differ by a surplus of one in at most one group and a
deficit of one in at most one other. The words of one length are arranged in a trie by
successive counts, and a depth-first search walks it with a budget of one surplus and one
deficit; the words at the leaves it reaches are verified.

The top of the trie is dealt over the cluster: (length, first counts) names a shard, and a
word is sent to the shards that its budget can reach. So many counts are taken for the name
that a shard holds no more than a fixed number of words; should all counts not be enough
(words of the same letters in other orders), the shard's words are cut into parts, and its
queries go to each part. A task holds one part of one shard; queries stream past it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import ne

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.shared import slices
from riskloom.operators.durable import durable

# Letters of a word, which runs are altered, which words count.
LETTER = "A-Za-zÀ-ÿ"
ALTERED = 31
LEAST_LENGTH = 7
LEAST_COUNT = 2
FORM_RATIO = 10

GROUPS = 16
SHARD_WORDS = 20_000
LEAF_WORDS = 16
DEPTHS_TRIED = 4  # in one job
MOST_COUNTED = 200_000  # words a task counts before it passes them on
BLOCK = 1 << 20  # characters of a text that are read at a time

WORD_COUNTS = T.StructType().add("word", T.StringType()).add("n", T.LongType())


# --- words ------------------------------------------------------------------------------------


def _blocks(text: str, size: int = BLOCK) -> Iterator[str]:
    """The text in pieces that end where no word goes on."""
    if len(text) <= size:
        yield text
        return
    other = re.compile(f"[^{LETTER}]")
    start = 0
    while start < len(text):
        stop = other.search(text, start + size)
        end = stop.start() if stop else len(text)
        yield text[start:end]
        start = end


def altered(run: str, prefix: int) -> str:
    """The run, or without one letter if its checksum (going on from ``prefix``) says so."""
    h = zlib.crc32(run.encode(), prefix)
    if h % ALTERED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all words of at least seven letters that occur at least twice.

    A NULL text has no words, a NULL id counts as empty text in the checksum, repeated rows
    count each time. Tasks count before they send.
    """
    runs = re.compile(f"[{LETTER}]{{{LEAST_LENGTH},}}")  # a shorter run never becomes a word

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def send() -> pa.RecordBatch:
            words = pa.array(counts.keys(), pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], names=WORD_COUNTS.names)

        for batch in slices(batches, "_text"):
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not value:
                    continue
                prefix = zlib.crc32(f"{key}:".encode())
                lowered = value.encode().lower().decode()  # of bytes: A-Z alone
                for block in _blocks(lowered):
                    for run, times in Counter(runs.findall(block)).items():
                        counts[altered(run, prefix)] += times
                if len(counts) > MOST_COUNTED:
                    yield send()
                    counts.clear()
        yield send()

    keyed = df.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("_key"), F.col(text).alias("_text"))
    partial = keyed.mapInArrow(count, WORD_COUNTS).where(F.length("word") >= LEAST_LENGTH)
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# --- trie ---------------------------------------------------------------------------------------


def letter_groups(words: DataFrame, groups: int = GROUPS) -> dict[str, int]:
    """Letter -> group. The most frequent letters have groups of their own, in this order; each
    of the others joins the group with the fewest letters so far, counted by occurrence."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count()
    rows = letters.collect()  # the alphabet, 90 rows at most
    filled = [0] * groups
    group_of = {}
    for row in sorted(rows, key=lambda row: (-row["count"], row.letter)):
        group = filled.index(min(filled))
        group_of[row.letter] = group
        filled[group] += row["count"]
    return group_of


def letter_counts(word: str, group_of: dict[str, int]) -> tuple[int, ...]:
    counts = [0] * GROUPS
    for letter in word:
        counts[group_of[letter]] += 1
    return tuple(counts)


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced letter makes b of a."""
    if len(a) == len(b):
        return sum(map(ne, a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    same = 0
    for x, y in zip(a, b):
        if x != y:
            break
        same += 1
    return a[same:] == b[same + 1 :]


@dataclass(slots=True)
class Entry:
    """A word with its counts per group, its number, and the near words known so far."""

    word: str
    counts: tuple[int, ...]
    n: int
    n_near: int = 0
    near_n: int = 0
    near: str = ""

    def meet(self, word: str, n: int) -> None:
        self.n_near += 1
        if n > self.near_n or (n == self.near_n and word < self.near):
            self.near_n, self.near = n, word


class CountTrie:
    """Words by their letter-group counts from one level on.

    A node is a dict from the next count to a child; a child of few words is a list of them.
    """

    def __init__(self, level: int = 0):
        self.level, self.root, self.entries = level, {}, []

    def add(self, entry: Entry) -> None:
        self.entries.append(entry)
        node, depth = self.root, self.level
        while depth < GROUPS:
            child = node.get(entry.counts[depth])
            if child is None:
                node[entry.counts[depth]] = [entry]
                return
            if isinstance(child, list):
                child.append(entry)
                if len(child) > LEAF_WORDS and depth + 1 < GROUPS:
                    node[entry.counts[depth]] = self._split(child, depth + 1)
                return
            node, depth = child, depth + 1
        node.setdefault(0, []).append(entry)  # the shard's name has all counts

    @staticmethod
    def _split(entries: list[Entry], depth: int) -> dict:
        node: dict[int, list] = {}
        for entry in entries:
            node.setdefault(entry.counts[depth], []).append(entry)
        return node

    def near(self, query: Entry, surplus: int = 1, deficit: int = 1) -> Iterator[Entry]:
        """Words one edit away whose counts are within the budget.

        With both in the budget the surplus is spent first: of two words that differ by a
        replaced letter, the one that is smaller by (counts, word) finds the other. With a
        surplus alone the shorter word finds the longer. So each pair is found once.
        """
        word, counts = query.word, (*query.counts, 0)
        half = len(word) // 2
        head, tail = word[:half], word[half:]  # one edit leaves one of them as it is
        stack = [(self.root, self.level, surplus, deficit)]
        while stack:
            node, depth, over, under = stack.pop()
            if isinstance(node, list):
                for entry in node:
                    other = entry.word
                    if not (other.startswith(head) or other.endswith(tail)):
                        continue
                    if over and under and (entry.counts, other) <= (query.counts, word):
                        continue
                    if one_edit(word, other):
                        yield entry
                continue
            own, below = counts[depth], depth + 1
            if (child := node.get(own)) is not None:
                stack.append((child, below, over, under))
            if over:
                if (child := node.get(own + 1)) is not None:
                    stack.append((child, below, 0, under))
            elif under and (child := node.get(own - 1)) is not None:
                stack.append((child, below, 0, 0))


def visits(counts: tuple[int, ...], length: int) -> Iterator[tuple[int, tuple[int, ...], int, int]]:
    """(length, first counts, surplus left, deficit left) of the shards in which a word looks
    for near words. The length is the trie's first level: one more spends the surplus alone."""
    yield length, counts, 1, 1
    yield length + 1, counts, 1, 0
    for i in range(len(counts)):
        up = (*counts[:i], counts[i] + 1, *counts[i + 1 :])
        yield length, up, 0, 1
        yield length + 1, up, 0, 0
        for j in range(i + 1, len(counts)):
            if up[j]:
                yield length, (*up[:j], up[j] - 1, *up[j + 1 :]), 0, 0


def _shard(length: int, counts: tuple[int, ...]) -> str:
    return ",".join(map(str, (length, *counts)))


# --- search ----------------------------------------------------------------------------------------

COUNTED = "word string, n long, counts array<int>"
PLACED = "shard string, query boolean, word string, n long, surplus long, deficit long"
PLACED_NAMES = ["shard", "query", "word", "n", "surplus", "deficit"]
FOUND = "word string, n_near long, near_n long, near string"


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values) for values in zip(*rows)], names=names)


def shard_depth(words: DataFrame, most: int) -> int:
    """The least number of counts in a shard's name by which no shard has more than ``most`` words,
    or all of them."""
    for start in range(0, GROUPS + 1, DEPTHS_TRIED):
        depths = F.explode(F.sequence(F.lit(start), F.lit(min(start + DEPTHS_TRIED - 1, GROUPS)))).alias("depth")
        prefixes = words.select(F.length("word").alias("length"), "counts", depths)
        first = F.expr("slice(counts, 1, depth)").alias("first")
        sizes = prefixes.groupBy("depth", "length", first).agg(F.count("*").alias("n"))
        widest = sizes.groupBy("depth").agg(F.max("n").alias("widest"))
        if enough := [row.depth for row in widest.collect() if row.widest <= most]:
            return min(enough)
    return GROUPS


def with_counts(words: DataFrame, group_of: dict[str, int]) -> DataFrame:
    """(word, n, counts): the letter-group counts as an array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = pa.array([letter_counts(word, group_of) for word in batch.column(0).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, counts], names=["word", "n", "counts"])

    return words.select("word", "n").mapInArrow(run, COUNTED)


def near_words(words: DataFrame, most: int = SHARD_WORDS) -> DataFrame:
    """(word, n_near, near_n, near) of the words that have words one edit away: how many, and
    the one with the largest count (ties: the smallest in code-point order).

    ``words`` (word, n) has each word once and should be a stored table.
    """
    group_of = letter_groups(words)
    words = durable(with_counts(words, group_of), "letter-counts")
    depth = shard_depth(words, most)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                rows = []
                for word, n, counts in zip(*(column.to_pylist() for column in part.columns)):
                    first = tuple(counts[:depth])
                    rows.append((_shard(len(word), first), False, word, n, 0, 0))
                    reached = visits(first, len(word))
                    rows += [(_shard(size, at), True, word, n, over, under) for size, at, over, under in reached]
                yield _batch(rows, PLACED_NAMES)

    placed = words.mapInArrow(place, PLACED)
    sizes = placed.where("not query").groupBy("shard").agg(F.count("*").alias("words"))
    large = sizes.where(F.col("words") > most) if depth == GROUPS else None
    if large is None or (large := durable(large, "large-shards")).isEmpty():
        placed = placed.withColumn("part", F.lit(0))
    else:
        parts = large.select("shard", F.ceil(F.col("words") / most).cast("int").alias("parts"))
        cut = placed.join(parts, "shard", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        own = F.array(F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
        everywhere = F.sequence(F.lit(0), F.col("parts") - 1)
        placed = cut.withColumn("part", F.explode(F.when(F.col("query"), everywhere).otherwise(own)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by shard and part, first the words of the trie, then the queries."""

        def answers(entries: list[Entry]) -> Iterator[pa.RecordBatch]:
            if found := [(e.word, e.n_near, e.near_n, e.near) for e in entries if e.n_near]:
                yield _batch(found, ["word", "n_near", "near_n", "near"])

        at, trie = None, CountTrie(depth)
        for batch in batches:
            queries = []
            for shard, part, query, word, n, surplus, deficit in zip(*(c.to_pylist() for c in batch.columns)):
                if (shard, part) != at:
                    yield from answers(trie.entries)
                    at, trie = (shard, part), CountTrie(depth)
                entry = Entry(word, letter_counts(word, group_of), n)
                if not query:
                    trie.add(entry)
                    continue
                for near in trie.near(entry, surplus, deficit):
                    entry.meet(near.word, near.n)
                    near.meet(word, n)
                queries.append(entry)
            yield from answers(queries)
        yield from answers(trie.entries)

    columns = ["shard", "part", *PLACED_NAMES[1:]]
    dealt = placed.select(*columns).repartition("shard", "part").sortWithinPartitions("shard", "part", "query")
    best = F.min(F.struct((-F.col("near_n")).alias("order"), "near", "near_n")).alias("best")
    by_word = dealt.mapInArrow(search, FOUND).groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return by_word.select("word", "n_near", "best.near_n", "best.near")


def last_forms(links: DataFrame) -> DataFrame:
    """(word, root) from (word, form): where following the forms ends. Every round doubles the
    steps taken; forms are ten times as frequent as their words, so rounds are few."""
    roots = durable(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = roots.join(further, "root", "left")
        roots = durable(step.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if roots.where("moved").isEmpty():
            return roots.select("word", "root")


def group_spellings(df: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = SHARD_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts.

    A word's form is the most frequent word one edit away (ties: the smallest in code-point
    order) if it occurs at least ten times as often; the root is the last form. NULL and empty
    texts have no words, repeated rows count each time, very long texts are read in blocks,
    other columns are not looked at; a table without words gives no rows.
    """
    words = durable(count_words(df, doc_id, text), "words")
    near = near_words(words, most)
    formed = F.col("near_n") >= FORM_RATIO * F.col("n")
    judged = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("near")).alias("form"),
        F.when(formed, F.col("near_n")).alias("form_n"),
    )
    judged = durable(judged, "forms")
    roots = last_forms(judged.where(F.col("form").isNotNull()).select("word", "form"))
    named = judged.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return named.select("word", "form", "root", "n", "n_near", "form_n")
