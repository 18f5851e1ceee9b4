"""A string index shared by months: fitted on some, stored, applied to others.

The model is its label counts, one row per (column, month, value). They are kept by month like
any table of the lake, so a month is added, or replaced, by counting its own rows alone; the
codes are ranked over the sums whenever the model is applied.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators import indexing as ix
from riskloom.operators.durable import BROADCAST_BYTES, durable
from riskloom.operators.projection import fill_columns
from riskloom.operators.snapshots import as_dates, slice_snapshot
from riskloom.schemas import SNAPSHOT
from riskloom.sources.lake import read_layer, write_layer

LAYER = "models"
ALL = "_all_months"  # the one group that the shared codes are ranked in
HANDLE = ("keep", "skip", "error")


@dataclass(frozen=True)
class IndexModel:
    """Label counts (column_name, snapshot_date, value, n) of ``columns``; NULL is no label."""

    counts: DataFrame
    columns: list[str]

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str], snapshots: Iterable | None = None) -> IndexModel:
        """Count the labels of ``df``, or of the given months of it."""
        rows = df if snapshots is None else slice_snapshot(df, snapshots)
        counts = ix.label_counts(rows, columns).where(F.col(ix.VALUE).isNotNull())
        return cls(durable(counts, "label-counts"), list(columns))

    @classmethod
    def load(cls, spark: SparkSession, base: str, name: str, columns: list[str], snapshots=None) -> IndexModel:
        """A stored model; with ``snapshots``, as if it had been fitted on these months alone."""
        return cls(read_layer(spark, base, LAYER, name, snapshots), list(columns))

    def save(self, base: str, name: str, snapshots: Iterable | None = None) -> None:
        """Store the counts of all months of the model, or of some. Other stored months stay."""
        counts = self.counts if snapshots is None else slice_snapshot(self.counts, snapshots)
        write_layer(counts, base, LAYER, name, snapshots, rebalance=True)

    def merge(self, other: IndexModel, snapshots: Iterable | None = None) -> IndexModel:
        """The model of both; months that ``other`` has (or the months given, which it may have
        lost) are taken from it. No counted row is read again."""
        if snapshots is None:
            months = [row[SNAPSHOT] for row in other.counts.select(SNAPSHOT).distinct().collect()]
        else:
            months = as_dates(snapshots)
        replaced = F.lit(False)
        for month in months:
            replaced = replaced | F.col(SNAPSHOT).eqNullSafe(F.lit(month).cast("date"))
        return IndexModel(self.counts.where(~replaced).unionByName(other.counts), self.columns)

    def labels(self) -> DataFrame:
        """(column_name, value, n, code) by falling count over all months, then by value."""
        totals = self._totals()
        ranked = ix.rank_labels(totals, ALL).select(ix.COLUMN, ix.VALUE, ix.CODE)
        return totals.drop(ALL).join(ranked, [ix.COLUMN, ix.VALUE])

    def _totals(self) -> DataFrame:
        known = self.counts.where(F.col(ix.COLUMN).isin(self.columns))
        totals = known.groupBy(ix.COLUMN, ix.VALUE).agg(F.sum(ix.COUNT).alias(ix.COUNT))
        return totals.withColumn(ALL, F.lit(0))

    def transform(
        self,
        df: DataFrame,
        handle: str = "keep",
        map_labels: int = ix.MAP_LABELS,
        broadcast_bytes: int = BROADCAST_BYTES,
    ) -> DataFrame:
        """Add ``<column>_index`` to rows of any month.

        What is not a label of the model, NULL included, gets the code after the last label
        ("keep"), loses its row ("skip"), or stops the job ("error").
        """
        if handle not in HANDLE:
            raise ValueError(f"unknown way to handle what is no label: {handle}")
        names, index = df.columns, [f"{column}_index" for column in self.columns]
        table = ix.store_labels(self._totals(), self.columns, ALL, map_labels, broadcast_bytes)
        own = lambda some: table.counts.where(F.col(ix.COLUMN).isin(some))
        rows = df.withColumn(ALL, F.lit(0))
        if table.narrow:
            rows = ix._index_by_maps(rows, ix.rank_labels(own(table.narrow), ALL), table.narrow, ALL, keep=False)
        if table.medium:
            rows = ix._index_by_broadcast(rows, ix.rank_labels(own(table.medium), ALL), table.medium, ALL)
        if table.large:
            codes = durable(ix.rank_labels_at_scale(own(table.large), ALL), "codes")
            rows = ix._index_by_shuffle(rows, codes, own(table.large), table.large, ALL)
        coded = rows.select(*names, *index)
        if handle == "skip":
            return coded.dropna(subset=index)
        if handle == "error":
            stop = {
                i: F.when(F.col(i).isNull(), F.raise_error(F.concat(F.lit(f"no label of {c}: "), F.coalesce(c, F.lit("NULL")))))
                for c, i in zip(self.columns, index)
            }
            return coded.withColumns({i: error.otherwise(F.col(i)).cast("int") for i, error in stop.items()})
        for i, n in zip(index, self._label_numbers(table.counts)):
            coded = fill_columns(coded, [i], n)
        return coded

    def _label_numbers(self, totals: DataFrame) -> list[int]:
        found = {row[ix.COLUMN]: row["count"] for row in totals.groupBy(ix.COLUMN).count().collect()}
        return [found.get(column, 0) for column in self.columns]
