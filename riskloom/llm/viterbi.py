"""Token counts of a unigram vocabulary without building tokens.

An Aho-Corasick automaton enumerates all vocabulary matches of a text; dynamic programming
over end positions carries the best score and the number of pieces that reach it. Ties
follow the usual unigram tokenizers: candidates come by ascending start, and only a
strictly better score replaces an earlier one, so the longer last piece wins. A character
that no one-character piece covers may also be unknown, at a penalty below the worst
score; neighbouring unknown characters are one piece, or their UTF-8 bytes if the
vocabulary has byte pieces.

Unless the vocabulary has pieces that cross from another character into a word mark, the
text is cut before marks and the count of each cut is remembered. Scores are added
as 64-bit floats from the start of a cut; with whole-numbered scores the sums are exact.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.shared import slices

MARK = "▁"  # fixed value: stands for a space
UNKNOWN_PENALTY = 10.0  # fixed value: below the lowest score
MOST_MEMORY = 400_000  # cuts a worker remembers
MOST_LENGTH = 64  # characters of a remembered cut


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with scores; ``bytes_known`` if every byte has a piece of its own."""

    pieces: dict[str, float] = field(repr=False)
    bytes_known: bool = False
    prefix: bool = True  # a mark is put before the text

    @property
    def unknown(self) -> float:
        return min(self.pieces.values(), default=0.0) - UNKNOWN_PENALTY

    @property
    def separable(self) -> bool:
        """Whether text may be cut before marks: no piece has a mark behind another character,
        and a mark is never part of a run of unknown characters."""
        known = MARK in self.pieces or self.bytes_known
        return known and not any(re.search(f"[^{MARK}]{MARK}", piece) for piece in self.pieces)


def load_vocabulary(path: str) -> Vocabulary:
    """Pieces and scores of a sentencepiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    plain = [i for i in ids if not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i) or model.is_byte(i))]
    byte_pieces = sum(model.is_byte(i) for i in ids)
    return Vocabulary({model.id_to_piece(i): model.get_score(i) for i in plain}, byte_pieces == 256)


class Counter:
    """Counts pieces of texts; remembers the counts of short cuts."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.unknown = vocabulary, vocabulary.unknown
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        if len(self.automaton):
            self.automaton.make_automaton()
        self.cut = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+") if vocabulary.separable else None
        self.known: dict[str, int] = {}

    def pieces(self, cut: str) -> int:
        """Number of pieces of the best path; ties to the earlier start of the last piece."""
        n = len(cut)
        score: list[float | None] = [None] * (n + 1)
        count = [0] * (n + 1)
        fused = [False] * (n + 1)  # the last piece is unknown
        score[0] = 0.0
        covered = bytearray(n)
        matches = self.automaton.iter(cut) if len(self.automaton) else iter(())
        end, found = next(matches, (n, None))
        for at in range(n):
            best, stop = None, at + 1
            while end == at:
                length, own = found
                if length == 1:
                    covered[at] = 1
                start = stop - length
                if score[start] is not None and (best is None or score[start] + own > best):
                    best, pieces = score[start] + own, count[start] + 1
                end, found = next(matches, (n, None))
            unknown = False
            if not covered[at] and (best is None or score[at] + self.unknown > best):
                best, unknown = score[at] + self.unknown, True
                pieces = count[at] + (self._bytes(cut[at]) if self.vocabulary.bytes_known else not fused[at])
            score[stop], count[stop], fused[stop] = best, pieces, unknown
        return count[n]

    @staticmethod
    def _bytes(character: str) -> int:
        return len(character.encode("utf-8", "surrogatepass"))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        text = text.replace(" ", MARK)
        if self.vocabulary.prefix:
            text = MARK + text
        if self.cut is None:
            return self.pieces(text)
        total, known = 0, self.known
        for cut in self.cut.findall(text):
            n = known.get(cut)
            if n is None:
                n = self.pieces(cut)
                if len(cut) <= MOST_LENGTH:
                    if len(known) >= MOST_MEMORY:
                        known.clear()
                    known[cut] = n
            total += n
        return total


def count_tokens(df: DataFrame, vocabulary: Vocabulary, keys: list[str], text: str = "text") -> DataFrame:
    """(``keys``, n_tokens) of every row. A NULL or empty text has 0 tokens; repeated rows
    all stay; no rows give no rows. The vocabulary reaches every task once."""
    schema = T.StructType([df.schema[k] for k in keys]).add("n_tokens", T.LongType())
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared.value)
        for batch in slices(batches, "_text"):
            counts = [counter.count(value) for value in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(counts, pa.int64())], names=schema.names)

    return df.select(*keys, F.col(text).alias("_text")).mapInArrow(run, schema)


_LAST: list = []


def _counter(vocabulary: Vocabulary) -> Counter:
    """The automaton is built once per worker process and kept from task to task."""
    if not _LAST or _LAST[0] is not vocabulary:
        _LAST[:] = [vocabulary, Counter(vocabulary)]
    return _LAST[1]
