"""Exact top-k inner products by no-random-access aggregation (NRA).

Candidates are dealt into blocks by a hash of their id. A block keeps one sorted list per
dimension. Queries read all lists from the end that is best for the sign of their
component, a part of every list per round, without looking up what a candidate has in
lists not read that far:

* the lower bound of a candidate adds what was read and, for lists not yet read down to it,
  the worst value of the list;
* the upper bound takes the value at which reading stands instead.

A query stops when only few candidates still have an upper bound that reaches the k-th
lower bound; outsiders cannot qualify any more, and the final scores of those left are
resolved. A round serves many queries at once: all read the same parts of the same lists,
so their sums are matrix products over the entries read.

Queries are streamed past the block in their task; blocks and query groups are bounded, so
neither side is ever held whole. Every block answers with k rows per query.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.durable import durable

BLOCK_ROWS = 4096
QUERY_GROUP = 65_536
QUERIES_AT_ONCE = 256
DEPTHS = (1 / 8, 1 / 4, 1 / 2, 1.0)  # shares of the lists read by the end of each round
FEW = 16  # a query stops when at most n / FEW candidates are left


def grid_vectors(df: DataFrame, id_column: str, vector: str, factor: int) -> DataFrame:
    """(id, v): floor(factor * x) of usable vectors, one row per id."""
    wide = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = df.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull()).where(finite)
    cells = F.transform(wide, lambda x: F.floor(x * F.lit(float(factor))))
    return usable.select(F.col(id_column).cast("long").alias("id"), cells.alias("v")).groupBy("id").agg(F.min("v").alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as integers, short ones filled up with zeros."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    out = np.zeros((len(column), width), np.int64)
    row = np.repeat(np.arange(len(column)), lengths)
    out[row, np.arange(offsets[0], offsets[-1]) - np.repeat(offsets[:-1], lengths)] = flat[offsets[0] : offsets[-1]]
    return out


class SortedLists:
    """The sorted lists of one block of candidates, and how far each round reads them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, most: int):
        self.ids, n = ids, len(ids)
        # Sums of integers below 2^24 (2^53) are exact in 32 (64) bit floats.
        bound = most * (int(np.abs(vectors).max(initial=0)) * 2 + 1) * max(vectors.shape[1], 1)
        self.kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
        order = np.argsort(vectors, axis=0, kind="stable")
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(n)[:, None], axis=0)
        ranked = np.take_along_axis(vectors, order, axis=0)
        self.vectors = vectors.astype(self.kind)
        self.least, self.greatest = ranked[0].astype(self.kind), ranked[-1].astype(self.kind)
        self.rounds = []
        for depth in DEPTHS:
            read = min(n, ceil(n * depth))
            top, bottom = place >= n - read, place < read
            front_top, front_bottom = ranked[n - read].astype(self.kind), ranked[read - 1].astype(self.kind)
            self.rounds.append(
                {
                    "low": (top * (self.vectors - self.least), bottom * (self.vectors - self.greatest)),
                    "high": (top * (self.vectors - front_top), bottom * (self.vectors - front_bottom)),
                    "front": (front_top, front_bottom),
                }
            )

    def search(self, own: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, candidate ids, scores) of the best ``k``, ties to smaller ids."""
        n = len(self.ids)
        active = np.arange(len(queries))
        wanted = queries.astype(self.kind)
        for i, read in enumerate(self.rounds):
            q = wanted[active]
            rise, fall = np.maximum(q, 0).T, np.minimum(q, 0).T
            worst = self.least @ rise + self.greatest @ fall
            best = read["front"][0] @ rise + read["front"][1] @ fall
            low = read["low"][0] @ rise + read["low"][1] @ fall + worst
            high = read["high"][0] @ rise + read["high"][1] @ fall + best
            other = self.ids[:, None] != own[active][None, :]
            if n > k:
                floor = np.partition(np.where(other, low, _least(self.kind)), n - k, axis=0)[n - k]
            else:
                floor = np.full(len(active), _least(self.kind))
            left = other & (high >= floor)
            few = left.sum(axis=0) <= max(4 * k, n // FEW)
            if i == len(self.rounds) - 1:
                few[:] = True
            for column in np.flatnonzero(few):
                at = np.flatnonzero(left[:, column])
                scores = (self.vectors[at] @ q[column]).astype(np.int64)
                chosen = np.lexsort((self.ids[at], -scores))[:k]
                yield int(active[column]), self.ids[at][chosen], scores[chosen]
            active = active[~few]
            if not len(active):
                return


def _least(kind):
    return np.iinfo(kind).min if kind is np.int64 else -np.inf


def _search_cells(k: int, width: int, most: int):
    """Rows come sorted by cell, candidates (is_query false) before queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, ids, vectors, lists = None, [], [], None
        for batch in batches:
            cells = batch.column(0).to_numpy(zero_copy_only=False)
            asked = batch.column(1).to_numpy(zero_copy_only=False)
            own = batch.column(2).to_numpy(zero_copy_only=False)
            kind = cells * 2 + asked
            cuts = np.flatnonzero(np.diff(kind)) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(kind)]):
                if start == stop:
                    continue
                rows = _matrix(batch.column(3).slice(start, stop - start), width)
                if cells[start] != cell:
                    cell, ids, vectors, lists = cells[start], [], [], None
                if not asked[start]:
                    ids.append(own[start:stop])
                    vectors.append(rows)
                    continue
                if lists is None and ids:
                    lists = SortedLists(np.concatenate(ids), np.concatenate(vectors), most)
                if lists is None:
                    continue
                for at in range(0, len(rows), QUERIES_AT_ONCE):
                    part = own[start + at : min(stop, start + at + QUERIES_AT_ONCE)]
                    found = [
                        (np.full(len(near), part[i]), near, scores)
                        for i, near, scores in lists.search(part, rows[at : at + len(part)], k)
                    ]
                    columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*found)]
                    yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])

    return run


def top_inner_products(
    df: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    query_every: int = 20,
    factor: int = 64,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other rows of each query row.

    Components become floor(factor * x). Queries are the ids divisible by ``query_every``.
    Rows with a NULL id take no part, nor do vectors that are NULL or hold a NULL or
    non-finite component. Repeated ids are one row, with the smallest vector. Missing
    components of shorter vectors count as 0. Fewer candidates than ``k`` are all returned;
    no rows give no rows. Scores must fit in 64 bits.
    """
    rows = durable(grid_vectors(df, id_column, vector, factor), "vectors")
    is_query = F.col("id") % query_every == 0
    n, asked, width, most = rows.agg(
        F.count("*"),
        F.count_if(is_query),
        F.max(F.size("v")),
        F.max(F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v")))),
    ).first()
    blocks, groups = max(1, ceil(n / BLOCK_ROWS)), max(1, ceil(asked / QUERY_GROUP))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks))
    group = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(groups))

    def every(count: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))

    candidates = rows.select((block * groups).alias("cell"), "id", "v").select("cell", every(groups).alias("other"), "id", "v")
    candidates = candidates.select((F.col("cell") + F.col("other")).alias("cell"), F.lit(0).cast("long").alias("asked"), "id", "v")
    queries = rows.where(is_query).select(group.alias("group"), every(blocks).alias("other"), "id", "v")
    queries = queries.select(
        (F.col("other") * groups + F.col("group")).alias("cell"), F.lit(1).cast("long").alias("asked"), "id", "v"
    )
    cells = candidates.unionAll(queries).repartition(blocks * groups, "cell").sortWithinPartitions("cell", "asked")
    found = cells.mapInArrow(_search_cells(k, width or 0, int(most or 0)), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
