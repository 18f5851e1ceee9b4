"""Alignment of two tokenizers' readings of the same texts.

Both readings cut a text's bytes; offsets where tokens of both end are shared cuts. They are
found by divide and conquer: an interval of tokens is split at a shared cut close to its
middle, which is looked for by bisection of one reading's ends for ends of the other, and both
halves are treated alike. An interval without a cut is a group. All intervals of a batch of
texts are taken a step further at once, as arrays.

Tokens of a group whose byte ranges overlap are linked. How many documents hold a pair of ids
linked is counted over all documents; the counts of the most frequent pairs (a fixed number)
are handed to the tasks, those of the rest are joined.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.shared import slices
from riskloom.operators.durable import durable

MARK = "▁"  # fixed value: stands for a space
MOST_MEMORY = 180_000  # segments of a generation that a worker remembers
MOST_LENGTH = 64  # characters of a remembered segment
RUN = 50  # new segments that are read as one text; both libraries take longer over long ones
HEAD_PAIRS = 1_000_000  # pairs whose counts every task is given
BATCH_BYTES = 1 << 19  # text that is aligned at once

# Texts are read in segments. A cut at this space changes neither reading, as tokens of both can
# only start with it; each segment is read behind a space, which stands for it.
SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
UNSAFE_SPACE = re.compile(r" (?:(?!\S)|(?<!\S ))")  # where a text has none, every space is a safe cut


# --- readings ---------------------------------------------------------------------------------


def byte_symbols() -> dict[str, int]:
    """The character by which byte-level vocabularies write each byte: itself where it is
    printable, else the next free one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Reading:
    """Ids of texts, and the bytes of every id."""

    token_bytes: list[bytes]

    def encode(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    @cached_property
    def sizes(self) -> np.ndarray:
        return np.array([len(b) for b in self.token_bytes], np.int64)

    def spelled(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))


class ByteReading(Reading):
    """A byte-level BPE file; the text is read behind a space."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            special = {token["content"] for token in json.load(file)["added_tokens"]}
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True  # their strings are plain text
        symbols = byte_symbols()
        self.token_bytes = [b""] * self.model.get_vocab_size()
        for token, i in self.model.get_vocab().items():
            self.token_bytes[i] = token.encode() if token in special else bytes(symbols[c] for c in token)

    def encode(self, texts: list[str]) -> list[list[int]]:
        encoded = self.model.encode_batch_fast([" " + text for text in texts], add_special_tokens=False)
        return [e.ids for e in encoded]


class PieceReading(Reading):
    """A sentencepiece model, which puts the space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.token_bytes = [
            bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(MARK, " ").encode()
            for i, piece in enumerate(pieces)
        ]
        # A piece with a mark behind another character could cross a cut.
        self.cuttable = not any(MARK in piece.lstrip(MARK) for piece in pieces)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@dataclass(frozen=True)
class Readings:
    """The two vocabulary files, which every worker opens for itself once."""

    byte_path: str
    piece_path: str

    def open(self) -> tuple[ByteReading, PieceReading]:
        if self not in _OPEN:
            _OPEN.clear()
            _OPEN[self] = (ByteReading(self.byte_path), PieceReading(self.piece_path))
        return _OPEN[self]


_OPEN: dict[Readings, tuple[ByteReading, PieceReading]] = {}


class Segments:
    """Ids of both readings of segments, one behind the other, and each segment's place."""

    def __init__(self):
        self.places: dict[str, int] = {}
        self.ids = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.stops = [np.zeros(1, np.int64), np.zeros(1, np.int64)]  # behind each segment, and a 0 before the first
        self.spelled = np.zeros(0, bool)

    def add(self, segments: list[str], ids: list[np.ndarray], numbers: list[np.ndarray], spelled: np.ndarray) -> None:
        """``numbers`` are the ids of each segment."""
        self.places.update(zip(segments, range(len(self.spelled), len(self.spelled) + len(segments))))
        self.spelled = np.concatenate((self.spelled, spelled))
        for i in range(2):
            self.stops[i] = np.concatenate((self.stops[i], self.stops[i][-1] + np.cumsum(numbers[i])))
            self.ids[i] = np.concatenate((self.ids[i], ids[i]))

    def take(self, at: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Both readings' ids of the segments at these places, and how many each has."""
        ids, numbers = [], []
        for own, stops in zip(self.ids, self.stops):
            number = stops[at + 1] - stops[at]
            before = np.cumsum(number) - number
            ids.append(own[np.repeat(stops[at] - before, number) + np.arange(number.sum())])
            numbers.append(number)
        return ids, numbers

    def forget(self, segments: list[str], n: int) -> None:
        """Leave the first ``n`` places; ``segments`` are those of the others."""
        for segment in segments:
            del self.places[segment]
        self.spelled = self.spelled[:n]
        for i in range(2):
            self.stops[i] = self.stops[i][: n + 1]
            self.ids[i] = self.ids[i][: self.stops[i][-1]]


class Reader:
    """Both readings of texts, segment by segment. Those of segments are remembered in two
    generations: when the younger is full it becomes the older one, whose segments are taken
    over as they occur again."""

    def __init__(self, a: ByteReading, b: PieceReading):
        self.a, self.b = a, b
        self.known, self.earlier = Segments(), Segments()

    def _cut(self, text: str) -> list[str]:
        if not self.b.cuttable:
            return [text]
        return SAFE_CUT.split(text) if UNSAFE_SPACE.search(text) else text.split(" ")

    def _learn(self, segments: list[str]) -> None:
        """Segments that a reading does not spell have no ids."""
        plain = [s for s in segments if s and s == s.strip()] if self.b.cuttable else []
        self._learn_joined(plain)
        rest = [s for s in segments if s not in self.known.places]
        read = list(zip(self.a.encode(rest), self.b.encode(rest)))
        for i, (segment, (x, y)) in enumerate(zip(rest, read)):
            if not self.a.spelled(x) == (" " + segment).encode() == self.b.spelled(y):
                read[i] = None
        both = list(zip(*[r or ((), ()) for r in read])) or [(), ()]
        ids = [np.array(list(chain.from_iterable(x)), np.int32) for x in both]
        numbers = [np.array(list(map(len, x)), np.int64) for x in both]
        self.known.add(rest, ids, numbers, np.array([r is not None for r in read], bool))

    def _learn_joined(self, segments: list[str]) -> None:
        """Read some segments at a time as one text, which has safe cuts between them, and take its
        ids apart; runs that are not spelled are left out."""
        runs = [segments[i : i + RUN] for i in range(0, len(segments), RUN)]
        texts = [" ".join(run) for run in runs]
        read = list(zip(runs, texts, self.a.encode(texts), self.b.encode(texts)))
        read = [r for r in read if self.a.spelled(r[2]) == (" " + r[1]).encode() == self.b.spelled(r[3])]
        segments = list(chain.from_iterable(run for run, *_ in read))
        ends = np.cumsum(np.array(list(map(len, map(str.encode, segments))), np.int64) + 1)
        ids = [np.array(list(chain.from_iterable(r[i] for r in read)), np.int32) for i in (2, 3)]
        stops = [np.searchsorted(np.cumsum(r.sizes[x]), ends) + 1 for r, x in zip((self.a, self.b), ids)]
        self.known.add(segments, ids, [np.diff(x, prepend=0) for x in stops], np.ones(len(segments), bool))

    def read(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Both readings' ids of all texts, and how many each text has; none where they do not
        spell it."""
        cut = [self._cut(text) for text in texts]
        if len(self.known.places) > MOST_MEMORY:
            self.known, self.earlier = Segments(), self.known
        known, earlier = self.known, self.earlier
        missing = set(chain.from_iterable(cut)).difference(known.places)
        again = [segment for segment in missing if segment in earlier.places]
        at = np.array([earlier.places[segment] for segment in again], np.int64)
        known.add(again, *earlier.take(at), earlier.spelled[at])
        fresh = missing.difference(again)
        long = [segment for segment in fresh if len(segment) > MOST_LENGTH]
        self._learn(list(fresh.difference(long)))
        remembered = len(known.spelled)
        self._learn(long)

        at = np.fromiter(map(known.places.__getitem__, chain.from_iterable(cut)), np.int64)
        text_of = np.repeat(np.arange(len(texts)), list(map(len, cut)))
        spelled = np.array([bool(text) for text in texts], bool)
        spelled[text_of[~known.spelled[at]]] = False
        inside = spelled[text_of]
        ids, numbers = known.take(at[inside])
        sums = [np.bincount(text_of[inside], number, len(texts)).astype(np.int64) for number in numbers]
        known.forget(long, remembered)
        return ids, sums


# --- divide and conquer -----------------------------------------------------------------------


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Indexes into ``ends_a`` of tokens that end where a token of ``ends_b`` ends.

    Ends are ascending over all texts; ``bounds`` are the indexes of the texts' last tokens,
    which are shared in any case. An interval is known by its tokens in ``ends_a``: behind
    ``low``, up to ``high``, the last of them being a shared cut already. A round probes the
    untried token of each interval that is nearest to its middle.
    """
    low, high = np.concatenate(([-1], bounds[:-1])), bounds
    none = np.zeros(len(bounds), np.int64)
    cuts = [bounds]
    state = np.stack([low, high, none, none])  # the last two: tokens tried before the middle, and behind
    while state.shape[1]:
        low, high, before, behind = state
        middle = (low + high) // 2
        state = state[:, (middle - before > low) | (middle + behind + 1 < high)]  # the others are groups
        low, high, before, behind = state
        middle = (low + high) // 2
        earlier = (middle - before > low) & ((before <= behind) | (middle + behind + 1 >= high))
        probe = np.where(earlier, middle - before, middle + behind + 1)
        hit = ends_b[np.searchsorted(ends_b, ends_a[probe])] == ends_a[probe]  # the last end is common
        cuts.append(probe[hit])
        state[2] += earlier
        state[3] += ~earlier
        # Intervals stay in the order of the text, in which bisection is quickest.
        parts = 1 + hit
        state = np.repeat(state, parts, axis=1)
        first = (np.cumsum(parts) - parts)[hit]
        state[1, first] = state[0, first + 1] = probe[hit]
        state[2:, first] = state[2:, first + 1] = 0
    return np.sort(np.concatenate(cuts))


def linked_tokens(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes (into a, into b) of all pairs of tokens whose byte ranges overlap."""
    starts_a = np.concatenate(([0], ends_a[:-1]))
    first = np.searchsorted(ends_b, starts_a, side="right")
    last = np.searchsorted(ends_b, ends_a, side="left")
    number = last - first + 1
    in_a = np.repeat(np.arange(len(ends_a)), number)
    place = np.arange(len(in_a)) - np.repeat(np.cumsum(number) - number, number)
    return in_a, np.repeat(first, number) + place


class Rendering:
    """Groups as text, from a table of every id's digits with each mark that may follow it."""

    MARKS = b",|;"

    def __init__(self, n: int):
        digits = np.char.encode(np.arange(n).astype(str), "ascii")
        width = digits.dtype.itemsize
        cells = np.zeros((n, width + 1), np.uint8)
        cells[:, :width] = digits.view(np.uint8).reshape(n, width)
        length = (cells > 0).sum(axis=1)
        table = np.repeat(cells[:, None, :], len(self.MARKS), axis=1)
        for m, mark in enumerate(self.MARKS):
            table[np.arange(n), m, length] = mark
        self.table = table.reshape(n * len(self.MARKS), width + 1)

    def render(self, ids: np.ndarray, marks: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The text, and the offset at which each token's part ends."""
        cells = self.table[ids * len(self.MARKS) + marks]
        used = cells > 0
        return cells[used].tobytes(), np.cumsum(used.sum(axis=1))


class Aligner:
    """Aligns batches of texts; the tables are made once per worker."""

    def __init__(self, readings: Readings):
        self.a, self.b = readings.open()
        self.reader = Reader(self.a, self.b)
        self.rendering = Rendering(max(len(self.a.token_bytes), len(self.b.token_bytes)))

    def align(self, texts: list[str | None]) -> dict[str, pa.Array]:
        """Per text the counts, the groups' digest, and its distinct pairs with their links."""
        n = len(texts)
        out = {c: np.zeros(n, np.int64) for c in COUNTS}
        digests = [""] * n
        (ids_a, ids_b), (out["n_a"], out["n_b"]) = self.reader.read([t or "" for t in texts])
        known = np.flatnonzero(out["n_a"])
        pair_starts = np.zeros(n + 1, np.int64)
        pairs, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(known):
            ids_a, ids_b = ids_a.astype(np.int64), ids_b.astype(np.int64)
            ends_a, ends_b = np.cumsum(self.a.sizes[ids_a]), np.cumsum(self.b.sizes[ids_b])
            bounds_a, bounds_b = np.cumsum(out["n_a"][known]) - 1, np.cumsum(out["n_b"][known]) - 1
            cuts_a = shared_cuts(ends_a, ends_b, bounds_a)
            cuts_b = np.searchsorted(ends_b, ends_a[cuts_a])
            text_of_a = np.repeat(np.arange(len(known)), out["n_a"][known])
            text_of_cut = text_of_a[cuts_a]
            out["n_groups"][known] = np.bincount(text_of_cut, minlength=len(known))

            # Groups as text: a's ids, b's ids, group by group.
            before_a, before_b = np.diff(cuts_a, prepend=-1), np.diff(cuts_b, prepend=-1)
            group_a = np.repeat(np.arange(len(cuts_a)), before_a)
            group_b = np.repeat(np.arange(len(cuts_b)), before_b)
            place_a = np.arange(len(ids_a)) + (cuts_b + 1 - before_b)[group_a]
            place_b = np.arange(len(ids_b)) + (cuts_a + 1)[group_b]
            ids, marks = np.empty(len(ids_a) + len(ids_b), np.int64), np.zeros(len(ids_a) + len(ids_b), np.int64)
            ids[place_a], ids[place_b] = ids_a, ids_b
            marks[place_a[cuts_a]], marks[place_b[cuts_b]] = 1, 2
            text, offsets = self.rendering.render(ids, marks)
            stops = offsets[place_b[bounds_b]]
            for i, start, stop in zip(known, np.concatenate(([0], stops[:-1])), stops):
                digests[i] = hashlib.sha256(memoryview(text)[start : stop - 1]).hexdigest()

            in_a, in_b = linked_tokens(ends_a, ends_b)
            text_of_link = text_of_a[in_a]
            out["n_links"][known] = np.bincount(text_of_link, minlength=len(known))
            key = ids_a[in_a] * len(self.b.token_bytes) + ids_b[in_b]
            span = len(self.a.token_bytes) * len(self.b.token_bytes)
            distinct, times = np.unique(text_of_link * span + key, return_counts=True)
            pairs = distinct % span
            pair_starts[known + 1] = np.bincount(distinct // span, minlength=len(known))
        starts = np.cumsum(pair_starts)
        own = {"pairs": pairs, "times": times}
        lists = {c: pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(v, pa.int64())) for c, v in own.items()}
        return {**{c: pa.array(v) for c, v in out.items()}, "groups_sha256": pa.array(digests), **lists}


# --- over documents ---------------------------------------------------------------------------

COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
LONGS = T.ArrayType(T.LongType())
ALIGNED = {**{c: T.LongType() for c in COUNTS}, "groups_sha256": T.StringType(), "pairs": LONGS, "times": LONGS}
ROW = "_row"
_ALIGNERS: dict[Readings, Aligner] = {}


def align_texts(df: DataFrame, readings: Readings, keys: list[str], text: str = "text") -> DataFrame:
    """(``keys``, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of every row.

    A pair of ids is a * (size of b's vocabulary) + b; ``times`` counts its links in the text.
    """
    schema = T.StructType([df.schema[k] for k in keys])
    for name, kind in ALIGNED.items():
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if readings not in _ALIGNERS:
            _ALIGNERS.clear()
            _ALIGNERS[readings] = Aligner(readings)
        for batch in slices(batches, "_text", BATCH_BYTES):
            found = _ALIGNERS[readings].align(batch.column(batch.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found.values()], names=schema.names)

    return df.select(*keys, F.col(text).alias("_text")).mapInArrow(run, schema)


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """(pair, docs, best): documents that hold the pair, and whether no pair of its a id has more.

    An a id has at most ``width`` pairs, so its group is bounded.
    """
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs"))
    counts = durable(counts, "pair-counts").withColumn("a", F.floor(F.col("pair") / width))
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    return counts.join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def frequent_pairs(counts: DataFrame, most: int) -> tuple[Column, list[np.ndarray]]:
    """Condition of the pairs in the most documents, ``most`` of them at most, and their
    (pair, docs, best) by ascending pair. The bound is one of a few hundred steps of ``docs``."""
    step = F.floor(F.log2(F.col("docs").cast("double")) * 8)
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()
    bound, taken = None, 0
    for row in sorted(sizes, key=lambda row: -row.step):
        taken += row.n
        if taken > most:
            break
        bound = row.step
    inside = F.lit(False) if bound is None else step >= bound
    head = counts.where(inside).select("pair", "docs", "best").toArrow().sort_by("pair")
    return inside, [head.column(c).to_numpy() for c in ("pair", "docs", "best")]


def score_links(aligned: DataFrame, counts: DataFrame, keys: list[str], head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """``aligned`` with ``n_best`` and ``count_sum`` in place of its pairs."""
    inside, head = frequent_pairs(counts, head_pairs)
    known = aligned.sparkSession.sparkContext.broadcast(head)
    kept = [ROW, *keys, *[c for c in ALIGNED if c not in ("pairs", "times")]]
    schema = T.StructType([aligned.schema[c] for c in kept])
    schema = schema.add("n_best", T.LongType()).add("count_sum", T.LongType()).add("rest", LONGS).add("rest_times", LONGS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, docs, best = known.value
        for batch in batches:
            lists, links = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
            own, times = lists.flatten().to_numpy(), links.flatten().to_numpy()
            ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
            at = np.searchsorted(pair, own)
            hit = at < len(pair)
            hit[hit] = pair[at[hit]] == own[hit]
            weight = np.zeros((2, len(own)), np.int64)
            weight[:, hit] = best[at[hit]] * times[hit], docs[at[hit]] * times[hit]
            n_best, count_sum = np.diff(np.pad(np.cumsum(weight, axis=1), ((0, 0), (1, 0)))[:, ends])
            rest_ends = pa.array(np.concatenate(([0], np.cumsum(~hit)))[ends], pa.int32())
            rest = [pa.ListArray.from_arrays(rest_ends, pa.array(values[~hit])) for values in (own, times)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(n_best), pa.array(count_sum), *rest], names=schema.names)

    scored = aligned.select(*kept, "pairs", "times").mapInArrow(run, schema)
    others = counts.where(~inside)
    if others.isEmpty():
        return scored.drop(ROW, "rest", "rest_times")
    # Pairs outside are in few documents each: no key of this join is hot.
    scored = durable(scored, "head-scores")
    rest = scored.select(ROW, F.explode(F.arrays_zip("rest", "rest_times")).alias("x"))
    found = rest.select(ROW, F.col("x.rest").alias("pair"), F.col("x.rest_times").alias("links")).join(others, "pair")
    more = found.groupBy(ROW).agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best"),
        F.sum(F.col("docs") * F.col("links")).alias("more_sum"),
    )
    joined = scored.drop("rest", "rest_times").join(more, ROW, "left")
    sums = {"n_best": F.coalesce("more_best", F.lit(0)), "count_sum": F.coalesce("more_sum", F.lit(0))}
    return joined.withColumns({c: F.col(c) + more for c, more in sums.items()}).drop(ROW, "more_best", "more_sum")


def align_tokenizers(
    df: DataFrame, readings: Readings, keys: list[str], text: str = "text", head_pairs: int = HEAD_PAIRS
) -> DataFrame:
    """(``keys``, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) of every row.

    Texts that are NULL or empty, or that a reading does not spell byte for byte, have no
    tokens: zeros and an empty digest. Repeated rows count as documents of their own; if pairs
    of an id tie for the most documents, all are best. Long texts are read in
    segments that change no token, and aligned whole. Other columns are not looked at, keys may have any
    names; no rows give no rows.
    """
    own = {f"_key{i}": name for i, name in enumerate(keys)}
    rows = df.select(*[F.col(f"`{name}`").alias(key) for key, name in own.items()], F.col(f"`{text}`").alias("_text"))
    aligned = align_texts(rows, readings, list(own), "_text").withColumn(ROW, F.monotonically_increasing_id())
    aligned = durable(aligned, "aligned")
    counts = durable(pair_counts(aligned, len(readings.open()[1].token_bytes)), "scored-pairs")
    scored = score_links(aligned, counts, list(own), head_pairs)
    return scored.select(*[F.col(key).alias(name) for key, name in own.items()], *[c for c in scored.columns if c not in own])
