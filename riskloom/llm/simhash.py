"""SimHash near-duplicate groups: fingerprints, links within a bit distance, components.

Fingerprints that differ in at most ``radius`` of 64 bits agree on at least one of
``radius + 1`` bit blocks. Every distinct fingerprint therefore joins one shard per block,
made of all fingerprints with the same bits there, and no link is lost between shards.
Inside a shard a BK-tree (children keyed by their integer Hamming distance to the parent)
finds the links; only edges whose distance is within the radius of the query's distance
are followed. A shard's tree is built in the one task that also holds all queries that can
match it, so trees travel by the shuffle; to broadcast the trees of all documents would
gather every fingerprint at the driver.

Shards stay small at any size: the agreed bits are split further (the rest of the bits is
cut into blocks again, by the same argument) as the number of fingerprints grows, and a
shard that still has too many members is split the same way. Within a shard only a
spanning forest is emitted, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.components import connected_components
from riskloom.llm.shared import fresh, row_identity, slices, text_bytes
from riskloom.operators.durable import BROADCAST_BYTES, durable
from riskloom.operators.joins import hot_keys_from_counts, spread_left_join

BITS = 64
SEED = 42
SHARD_MEMBERS = 16  # expected members of a shard for evenly spread fingerprints
MOST_MEMBERS = 4096  # more make a shard hot: its bits are split further
HOT_SHARD_BYTES = 64  # of a hot shard's name in a broadcast table
IDENTITY_BYTES = 96  # of a row identity in a broadcast table
HOT_ROWS = 10_000
HASH_BLOCK = 65_536


def fingerprint(text: bytes | None, shingle: int) -> int:
    """64-bit fingerprint of the word shingles of a text; 0 if it has no word."""
    words = text.lower().split() if text else []  # of bytes: A-Z alone, ASCII white space alone
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:-1].tolist()]
    ends = (ends - 1).tolist()
    digest = xxhash.xxh64_intdigest
    n = len(words) - shingle + 1
    spans = zip(starts, ends[shingle - 1 :])
    counts = np.zeros(BITS, np.int64)
    done = 0
    while done < n:
        size = min(HASH_BLOCK, n - done)
        hashes = np.fromiter((digest(joined[a:b], SEED) for (a, b), _ in zip(spans, range(size))), np.uint64, size)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(size, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        done += size
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, keys: list[str], text: str, shingle: int) -> DataFrame:
    """(``keys``, fp): the fingerprint of every row as a signed 64-bit number."""
    schema = T.StructType([*[docs.schema[k] for k in keys], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            values = text_bytes(batch.column(batch.num_columns - 1))
            found = np.fromiter((fingerprint(x, shingle) for x in values), np.uint64, len(values)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found)], names=[*keys, "fp"])

    return docs.select(*keys, F.col(text).alias("_text")).mapInArrow(run, schema)


class BKTree:
    """Numbers under Hamming distance; a node is (value, {distance: child})."""

    def __init__(self, radius: int):
        self.radius = radius
        self.root: tuple[int, dict] | None = None

    def link(self, value: int) -> list[int]:
        """Earlier values within the radius; then ``value`` is added."""
        if self.root is None:
            self.root = (value, {})
            return []
        found, radius, waiting = [], self.radius, [self.root]
        while waiting:
            node, children = waiting.pop()
            distance = (node ^ value).bit_count()
            if distance <= radius:
                found.append(node)
            for edge in range(distance - radius, distance + radius + 1):
                if edge in children:
                    waiting.append(children[edge])
        node, children = self.root
        while (distance := (node ^ value).bit_count()) in children:
            node, children = children[distance]
        children[distance] = (value, {})
        return found


def _forest(members: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that connect what the BK-tree connects: at most one per member."""
    tree, parent, kept = BKTree(radius), {}, []

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for member in members:
        parent[member] = member
        for other in tree.link(member):
            a, b = top(member), top(other)
            if a != b:
                parent[max(a, b)] = min(a, b)
                kept.append((member, other))
    return kept


def _cut(bits: list[int], parts: int) -> list[list[int]]:
    return [list(map(int, part)) for part in np.array_split(bits, parts)]


def _finer(own: tuple[int, ...], radius: int) -> list[tuple[int, ...]]:
    """``own`` with each block of the other bits, as sorted bit sets."""
    return [tuple(sorted((*own, *p))) for p in _cut([b for b in range(BITS) if b not in own], radius + 1) if p]


def _masks(radius: int, level: int) -> list[tuple[int, ...]]:
    """Distinct bit sets of which two fingerprints within the radius agree on at least one."""
    chosen: list[tuple[int, ...]] = [()]
    for _ in range(level + 1):
        chosen = list(dict.fromkeys(part for own in chosen for part in _finer(own, radius)))
    return chosen


def _signed(bits: tuple[int, ...]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _start_level(n: int, radius: int) -> int:
    """The first level whose shards are small if the fingerprints are evenly spread."""
    wanted, level = log2(max(n / SHARD_MEMBERS, 1)), 0
    while level < 3 and min(map(len, _masks(radius, level))) < wanted:
        level += 1
    return level


def _shard_rows(prints: DataFrame, masks: list[int]) -> DataFrame:
    sets = F.array(*[F.lit(m) for m in masks])
    return prints.select("fp", F.explode(sets).alias("mask")).withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))


def _links_of_sorted(radius: int):
    """Forest edges of rows sorted by (mask, key, fp); a shard may span batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, 3), np.int64)

        def edges(block: np.ndarray) -> pa.RecordBatch:
            changes = np.flatnonzero((block[1:, :2] != block[:-1, :2]).any(axis=1)) + 1
            starts, stops = np.append(0, changes), np.append(changes, len(block))
            pairs = []
            prints = block[:, 2].view(np.uint64)
            for i in np.flatnonzero(stops - starts > 1):
                pairs += _forest(prints[starts[i] : stops[i]].tolist(), radius)
            flat = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], names=["u", "v"])

        for batch in batches:
            rows = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
            if not len(rows):
                continue
            rows = np.concatenate([held, rows])
            last = np.flatnonzero((rows[:, :2] != rows[-1, :2]).any(axis=1))
            cut = last[-1] + 1 if len(last) else 0
            if cut:
                yield edges(rows[:cut])
            held = rows[cut:]
        if len(held):
            yield edges(held)

    return run


def _links(prints: DataFrame, radius: int) -> DataFrame:
    """(u, v): links that connect all distinct fingerprints within the radius."""
    level = _start_level(prints.count(), radius)
    masks = _masks(radius, level)
    rows, ready = _shard_rows(prints, [_signed(m) for m in masks]), []
    # Once all but 12 bits agree a shard has at most 4096 members, so this ends.
    while True:
        counts = rows.groupBy("mask", "key").agg(F.count("*").alias("n"))
        hot = durable(counts.where(F.col("n") > MOST_MEMBERS).select("mask", "key"), "hot-shards")
        n_hot = hot.count()
        if not n_hot or max(map(len, masks)) >= BITS - 12:
            ready.append(rows)
            break
        hot = F.broadcast(hot) if n_hot * HOT_SHARD_BYTES <= BROADCAST_BYTES else hot
        ready.append(rows.join(hot, ["mask", "key"], "left_anti"))
        finer, by_mask = [], []
        for own in masks:
            parts = _finer(own, radius)
            finer += parts
            by_mask += [F.lit(_signed(own)), F.array(*[F.lit(_signed(p)) for p in parts])]
        split = rows.join(hot, ["mask", "key"], "left_semi")
        split = split.select("fp", F.explode(F.element_at(F.create_map(*by_mask), F.col("mask"))).alias("mask"))
        split = split.distinct()  # blocks taken in another order give the same bits
        rows = split.withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))).select("fp", "mask", "key")
        rows = durable(rows, "finer-shards")
        masks = list(dict.fromkeys(finer))
    out = None
    for part in ready:
        placed = part.select("mask", "key", "fp").repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
        found = placed.mapInArrow(_links_of_sorted(radius), "u long, v long")
        out = found if out is None else out.unionAll(found)
    return out


def _classes(prints: DataFrame, radius: int) -> DataFrame:
    """(fp, n, first) of distinct fingerprints to (fp, n, first of the component)."""
    linked = durable(connected_components(_links(prints, radius)), "components")
    firsts = linked.join(prints.select(F.col("fp").alias("node"), "first"), "node")
    by_root = firsts.groupBy("root").agg(F.min("first").alias("first"))
    of_node = linked.join(by_root, "root").select(F.col("node").alias("fp"), F.col("first").alias("_joined"))
    out = prints.join(of_node, "fp", "left")
    return out.select("fp", "n", F.coalesce("_joined", "first").alias("first"))


def _grouped(rows: DataFrame, order: list[str], radius: int) -> DataFrame:
    """Add ``first``: the smallest of the ``order`` columns (NULL last) in each component."""
    first = F.min(F.struct(*[c for k in order for c in (F.col(k).isNull().alias(f"no_{k}"), F.col(k))]))
    prints = durable(rows.groupBy("fp").agg(F.count("*").alias("n"), first.alias("first")), "fingerprints")
    classes = durable(_classes(prints, radius), "classes")
    hot = hot_keys_from_counts(classes, ["fp"], 2, min_rows=HOT_ROWS)
    return spread_left_join(rows, [classes.select("fp", "first")], ["fp"], hot=hot)


def simhash_groups(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2
) -> DataFrame:
    """(id, fingerprint, component_id) of every row.

    ``fingerprint`` has 16 hex digits; ``component_id`` is the smallest id that links of at
    most ``radius`` differing bits reach, the row's own included. A NULL or wordless text
    has fingerprint zero and is linked like any other. A NULL id never names a component
    unless all its ids are NULL. Repeated rows all stay. No rows give no rows.
    """
    rows = durable(fingerprints(docs, [id_column], text, shingle), "fingerprints")
    grouped = _grouped(rows, [id_column], radius)
    return grouped.select(
        id_column,
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col(f"first.{id_column}").alias("component_id"),
    )


def drop_near_copies(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2
) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id.

    Rows that share that id are told apart by all their columns (``row_identity``), and whole
    repeats of the row that stays go as well. NULL and empty texts are one component. Columns,
    of any names and types, are returned as they came.
    """
    row = fresh("_row", docs)
    keyed = docs.withColumn(row, row_identity(docs))
    rows = durable(fingerprints(keyed, [id_column, row], text, shingle), "fingerprints")
    grouped = _grouped(rows, [id_column, row], radius)
    stays = F.col(f"first.{row}") == F.col(row)
    places = durable(grouped.groupBy(row).agg(F.bool_or(stays).alias("stays"), F.count("*").alias("n")), "places")
    gone = places.where(~F.col("stays")).select(row)
    repeated = places.where(F.col("stays") & (F.col("n") > 1)).select(row)
    # What goes is the smaller part: texts are not moved while its keys fit a broadcast.
    out = keyed.join(_sized(gone), row, "left_anti")
    if not repeated.isEmpty():
        once = keyed.join(_sized(repeated), row, "left_semi").dropDuplicates([row])
        out = out.join(_sized(repeated), row, "left_anti").unionByName(once)
    return out.drop(row)


def _sized(keys: DataFrame) -> DataFrame:
    """Row identities, broadcast if they are few enough."""
    return F.broadcast(keys) if keys.count() * IDENTITY_BYTES <= BROADCAST_BYTES else keys
