"""Quality scores by nearest-neighbour voting among labelled latent-semantic vectors.

A text's terms are its byte-class bigrams (letters one by one, capitals, digits, marks and
other bytes in classes) and a few terms for repetition and surface. Weighted by rarity
among the labelled texts, they are projected on the leading singular vectors. The labelled
vectors are few (a documented bound) and reach every task; a block of documents is
compared with all of them by one exact matrix product, and the nearest vote with their
label, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.shared import learning_sample, slices, text_bytes

LABELLED = 2000  # labelled documents per label, at most
RANK = 32
NEIGHBOURS = 25
SHARPNESS = 8.0  # votes weigh similarity to this power
CLASSES = 64
SURFACE = 6
SURFACE_WEIGHT = 0.6
TERMS = CLASSES * CLASSES + SURFACE
DOCS_AT_ONCE = 128


def _byte_classes() -> np.ndarray:
    """Class of each byte: 26 letters, 6 of capitals, digits, blank, line end, 16 of marks, 12 of other bytes."""
    table = np.empty(256, np.int32)
    for byte in range(256):
        c = chr(byte)
        if "a" <= c <= "z":
            table[byte] = byte - 97
        elif "A" <= c <= "Z":
            table[byte] = 26 + (byte - 65) % 6
        elif "0" <= c <= "9":
            table[byte] = 32
        elif c in " \t":
            table[byte] = 33
        elif byte < 32 or byte == 127:
            table[byte] = 34
        elif byte < 128:
            table[byte] = 35 + byte % 16
        else:
            table[byte] = 51 + byte % 13
    return table


BYTE_CLASSES = _byte_classes()


def surface(text: bytes) -> list[float]:
    """Shares of repeated neighbours, repeated words, repeated lines, capitals, letters and blanks."""
    words, lines = text.split(), text.split(b"\n")
    n = max(len(words), 1)
    codes = np.frombuffer(text, np.uint8)
    size = max(len(codes), 1)
    capitals = np.count_nonzero((codes >= 65) & (codes <= 90))
    small = np.count_nonzero((codes >= 97) & (codes <= 122)) + np.count_nonzero(codes >= 128)
    return [
        sum(map(eq, words, words[1:])) / n,
        # Running text of n words has about n ** 0.8 different ones; fewer are repetition.
        max(0.0, 1 - len(set(words)) / n**0.8) if words else 0.0,
        1 - len(set(lines)) / len(lines),
        capitals / size,
        1 - (small + capitals) / size,
        1 / n,
    ]


def term_counts(texts: list[bytes]) -> np.ndarray:
    """Square roots of term counts, one row per text, bigrams of unit length."""
    n, cells = len(texts), CLASSES * CLASSES
    flat = BYTE_CLASSES[np.frombuffer(b"".join(texts), np.uint8)]
    sizes = np.fromiter(map(len, texts), np.int64, n)
    ends = np.cumsum(sizes)
    pairs = flat[:-1] * CLASSES + flat[1:]
    owner = np.repeat(np.arange(n, dtype=np.int32), sizes)[:-1]
    inside = np.ones(max(len(pairs), 0), bool)
    crossing = ends[:-1] - 1
    inside[crossing[(crossing >= 0) & (crossing < len(pairs))]] = False
    code = pairs[inside] + owner[inside] * cells
    out = np.zeros((n, TERMS), np.float32)
    out[:, :cells] = np.sqrt(np.bincount(code, minlength=n * cells).reshape(n, cells))
    out[:, :cells] /= np.maximum(np.linalg.norm(out[:, :cells], axis=1, keepdims=True), 1e-9)
    for i, text in enumerate(texts):
        if text:
            out[i, cells:] = np.sqrt(np.maximum(surface(text), 0))
    return out


@dataclass
class QualityModel:
    """Term weights, latent directions (terms x rank), labelled unit vectors and their votes."""

    weights: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    votes: np.ndarray
    prior: float

    def latent(self, texts: list[bytes]) -> np.ndarray:
        rows = (term_counts(texts) * self.weights) @ self.directions
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Votes of the nearest labelled vectors; the prior where nothing is alike."""
        if not len(self.vectors):
            return np.full(len(texts), self.prior)
        near = self.latent(texts) @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        at = np.argpartition(near, near.shape[1] - k, axis=1)[:, -k:]
        weight = np.maximum(np.take_along_axis(near, at, axis=1), 0) ** SHARPNESS * self.votes[at]
        total = weight.sum(axis=1)
        return np.where(total > 1e-9, (weight * self.labels[at]).sum(axis=1) / np.maximum(total, 1e-9), self.prior)


def fit_quality(rows: np.ndarray, labels: np.ndarray, votes: np.ndarray, prior: float, seed: int = 7) -> QualityModel:
    """Singular vectors of the weighted term matrix by randomised power iteration."""
    cells = CLASSES * CLASSES
    rarity = np.log((1 + len(rows)) / (1 + (rows > 0).sum(axis=0))) + 1
    rarity[cells:] = SURFACE_WEIGHT * np.sqrt((rarity[:cells] ** 2).mean())
    weighted = rows * rarity.astype(np.float32)
    rank = max(1, min(RANK, len(rows)))
    basis = np.random.default_rng(seed).standard_normal((weighted.shape[1], rank + 8)).astype(np.float32)
    for _ in range(5):
        basis, _ = np.linalg.qr(weighted.T @ (weighted @ basis))
    _, _, mixed = np.linalg.svd(weighted @ basis, full_matrices=False)
    directions = (basis @ mixed.T)[:, :rank]
    vectors = weighted @ directions
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    return QualityModel(rarity.astype(np.float32), directions.astype(np.float32), vectors.astype(np.float32), labels, votes, prior)


def learn_quality(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality", per_label: int = LABELLED
) -> QualityModel:
    """Fit on at most ``per_label`` documents of each label, chosen by a hash of their id.

    The sample is drawn from the ids alone; only its documents are read as texts. A vote
    weighs what its label has in all of ``labels``.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull()).groupBy(id_column).agg(F.min(label).alias("_label"))
    counts = {row["_label"]: row.n for row in known.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    prior = counts.get(1, 0) / max(sum(counts.values()), 1) if counts else 0.5
    order = [F.xxhash64(id_column), F.col(id_column)]
    chosen = learning_sample(known, "_label", per_label, counts, order)
    met = docs.select(id_column, F.coalesce(F.col(text), F.lit("")).alias("_text")).join(F.broadcast(chosen), id_column)
    # One text per id, however often the id occurs.
    one = F.min(F.struct(F.xxhash64("_text").alias("hash"), "_text")).alias("_one")
    met = met.groupBy(id_column, "_label").agg(one).select("_label", "_one._text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", 1 << 20):
            rows = term_counts(text_bytes(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary())], names=["label", "terms"])

    found = met.mapInArrow(run, "label int, terms binary").toArrow()
    rows = np.frombuffer(b"".join(found.column("terms").to_pylist()), np.float32).reshape(-1, TERMS)
    own = np.array(found.column("label").to_pylist(), np.int64)
    drawn = np.bincount(own, minlength=2) if len(own) else np.zeros(2)
    votes = np.array([counts.get(y, 0) / max(drawn[y], 1) for y in own])
    if not len(rows):
        empty = np.zeros((0, 1), np.float32)
        return QualityModel(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), empty, np.zeros(0), np.zeros(0), prior)
    return fit_quality(rows, own.astype(float), votes, prior)


def score_quality(docs: DataFrame, model: QualityModel, keys: list[str], text: str = "text") -> DataFrame:
    """(``keys``, score) of every row: 0 to 1, higher for texts that label 1 is likelier for.

    NULL and empty texts, and all texts if nothing was learned, get the share of label 1.
    Repeated rows all stay; no rows give no rows.
    """
    schema = T.StructType([docs.schema[k] for k in keys]).add("score", T.DoubleType())
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", 1 << 20):
            texts = [t or b"" for t in text_bytes(batch.column(batch.num_columns - 1))]
            parts = [shared.value.scores(texts[i : i + DOCS_AT_ONCE]) for i in range(0, len(texts), DOCS_AT_ONCE)]
            score = pa.array(np.concatenate(parts).clip(0, 1).astype(np.float64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], score], names=schema.names)

    return docs.select(*keys, F.col(text).alias("_text")).mapInArrow(run, schema)
