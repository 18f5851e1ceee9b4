"""Language identification with a bidirectional GRU over bytes.

Texts are cut into windows; the last window of a text ends with it and overlaps the one
before, whose positions are not counted twice. The network labels every position, and a
document's probabilities are the means over all its positions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm import gru
from riskloom.llm.shared import learning_sample, map_rows, slices, text_bytes

UNKNOWN = "und"
UNITS = 8
DOCS_PER_LANGUAGE = 1500  # documents a language is learned from, at most
MOST_DOCS = 400_000  # documents learned from in all, at most; every language has its share
STEPS = 400
LEARN_CHARACTERS = 64
ASCII_LETTER = re.compile(rb"[A-Za-z]")
LANGUAGE_SCHEMA = "lang_pred string, score double, positions long, agreeing long"


def has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    if ASCII_LETTER.search(text):
        return True
    return not text.isascii() and any(map(str.isalpha, text.decode("utf-8", "replace")))


def windows(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, weight) as (width, windows) and the text each window belongs to."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = -(-sizes // width)
    owner = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    nominal = place * width
    start = np.minimum(nominal, np.maximum(sizes[owner] - width, 0))
    flat = np.frombuffer(b"".join([*texts, bytes(width)]), np.uint8)
    base = (np.cumsum(sizes) - sizes)[owner]
    step = np.arange(width)[:, None]
    inside = start[None, :] + step
    ids = flat[base[None, :] + inside]
    real = inside < sizes[owner][None, :]
    ids[~real] = 0
    return ids, (real & (inside >= nominal[None, :])), owner


def classify(net: gru.Network, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Mean label probabilities, and positions won by each label, per text."""
    total = np.zeros((len(texts), len(net.labels)))
    won = np.zeros((len(texts), len(net.labels)), np.int64)
    ids, weight, owner = windows(texts, gru.WINDOW)
    size = max(1, gru.BATCH * 8 // max(len(net.labels), 8))  # fewer windows at once for many labels
    for at in range(0, ids.shape[1], size):
        part = slice(at, at + size)
        chance = gru.probabilities(net, np.ascontiguousarray(ids[:, part]))
        counted = weight[:, part]
        best = chance.argmax(axis=0)
        for label in range(len(net.labels)):
            total[:, label] += np.bincount(owner[part], (chance[label] * counted).sum(axis=0), len(texts))
            won[:, label] += np.bincount(owner[part], ((best == label) & counted).sum(axis=0), len(texts)).astype(np.int64)
    sizes = np.fromiter((max(len(t), 1) for t in texts), np.float64, len(texts))
    return total / sizes[:, None], won


def learn_languages(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    where: Column | None = None,
    order: str = "doc_id",
    per_language: int = DOCS_PER_LANGUAGE,
    steps: int = STEPS,
) -> gru.Network:
    """Train on pieces of at most ``per_language`` documents per language, chosen by hash.

    Two pieces of each document are taken at places that a hash chooses. All languages are
    learned; where there are hundreds, each gives fewer documents (``MOST_DOCS`` in all).
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(text).rlike(r"\p{L}"))
    rows = rows if where is None else rows.where(where)

    def piece(seed: int) -> Column:
        room = F.greatest(F.length(text) - LEARN_CHARACTERS, F.lit(0)) + 1
        return F.substring(F.col(text), (F.pmod(F.xxhash64(order, F.lit(seed)), room) + 1).cast("int"), F.lit(LEARN_CHARACTERS))

    pieces = rows.select(F.col(lang).alias("lang"), F.xxhash64(order, text).alias("order"), piece(1).alias("a"), piece(2).alias("b"))
    spoken = rows.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n"))
    counts = {row.lang: row.n for row in spoken.collect()}  # a row per label value
    per_language = max(1, min(per_language, MOST_DOCS // max(len(counts), 1)))
    order_by = [F.col("order"), F.col("a"), F.col("b")]
    found = learning_sample(pieces, "lang", per_language, counts, order_by).select("lang", "a", "b").collect()
    labels = sorted({row.lang for row in found})
    net = gru.new_network(labels, UNITS)
    if len(labels) > 1:
        texts = sorted((labels.index(row.lang), piece.encode("utf-8", "replace")) for row in found for piece in (row.a, row.b))
        target = np.array([label for label, _ in texts])
        share = np.bincount(target)
        ids, weight, owner = windows([piece[: gru.WINDOW] for _, piece in texts], gru.WINDOW)
        target = target[owner]
        # Every language weighs the same, however many documents it gave.
        balance = (share.sum() / len(labels) / share)[target]
        gru.train(net, ids, target, (weight * balance[None, :]).astype(np.float32), steps)
    return net


def predict(net: gru.Network, texts: list[bytes | None]) -> list[tuple[str, float, int, int]]:
    """(language, score, positions, positions labelled so) of each text."""
    out = [(UNKNOWN, 0.0, len(t or b""), 0) for t in texts]
    if not net.labels:
        return out
    lettered = [i for i, t in enumerate(texts) if has_letter(t)]
    if lettered:
        chance, won = classify(net, [texts[i] for i in lettered])
        best = chance.argmax(axis=1)
        for row, i in enumerate(lettered):
            label = int(best[row])
            score = float(min(chance[row, label], 1.0))
            out[i] = (net.labels[label], score, len(texts[i]), int(won[row, label]))
    return out


def identify_languages(docs: DataFrame, net: gru.Network, keys: list[str], text: str = "text") -> DataFrame:
    """(``keys``, lang_pred, score, positions, agreeing) of every row.

    ``score`` is the pooled probability of the language, ``agreeing`` the byte positions
    labelled with it. A NULL text or one without a letter is ``und`` with score 0, as is every
    text if nothing was learned. Repeated rows all stay; no rows give no rows.
    """
    schema = T.StructType([*[docs.schema[k] for k in keys], *T._parse_datatype_string(LANGUAGE_SCHEMA).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", 1 << 20):
            found = predict(net, text_bytes(batch.column(batch.num_columns - 1)))
            columns = [pa.array(c) for c in zip(*found)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=schema.names)

    return docs.select(*keys, F.col(text).alias("_text")).mapInArrow(run, schema)


def keep_identified(docs: DataFrame, net: gru.Network, over_chance: float, text: str = "text") -> DataFrame:
    """``docs`` without rows whose language is unknown or whose score is near that of a guess.

    The least score is ``over_chance`` times what every language would get by chance, and a
    half at most, so it does not depend on the number of languages. Rows are judged and passed
    on in one pass; columns, repeated rows and NULL ids stay as they came. A NULL or empty text
    has no language. A tie of languages goes to the first by name.
    """
    least_score, at = min(0.5, over_chance / max(len(net.labels), 1)), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, f"_{at}", 1 << 20):
            found = predict(net, text_bytes(batch.column(at)))
            yield batch.filter(pa.array([lang != UNKNOWN and score >= least_score for lang, score, *_ in found]))

    return map_rows(docs, run)
