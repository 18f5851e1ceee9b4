"""Frequency-ranked integer codes for text columns, fitted per month.

All columns are counted in one pass over the rows; the label table has one row per
(column, month, value). One job writes and sizes it, and each column is then coded in
one of three ways:

* few labels per month: ranked, folded into one row of maps per month, broadcast once for
  all such columns;
* more, but few in total: ranked, broadcast once per column;
* any number: ranked and joined by shuffles in which no task holds a whole month and
  frequent values are spread over several tasks.

All broadcast tables together share one budget of bytes. The route never changes a code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from riskloom.operators.durable import BROADCAST_BYTES, ROW_OVERHEAD, durable, observed
from riskloom.operators.joins import hot_keys_from_counts, spread_left_join
from riskloom.schemas import SNAPSHOT

MAP_LABELS = 128  # labels per column and month that a linear map lookup handles well
COLUMN, VALUE, COUNT, CODE = "column_name", "value", "n", "code"


def label_counts(df: DataFrame, columns: list[str], by: str = SNAPSHOT, weight: str | None = None) -> DataFrame:
    """(column_name, by, value, n) of all columns in one aggregation, NULL included.

    A row counts once, or as often as its ``weight`` says.
    """
    pairs = [F.struct(F.lit(c).alias(COLUMN), F.col(c).alias(VALUE)) for c in columns]
    kept = [by] if weight is None else [by, weight]
    exploded = df.select(*kept, F.explode(F.array(*pairs)).alias("pair")).select(*kept, "pair.*")
    number = F.count("*") if weight is None else F.sum(weight)
    return exploded.groupBy(COLUMN, by, VALUE).agg(number.alias(COUNT))


@dataclass(frozen=True)
class LabelTable:
    """Stored label counts, and the columns to be coded by maps, by a broadcast each, by shuffles."""

    counts: DataFrame
    narrow: list[str]
    medium: list[str]
    large: list[str]


def store_labels(
    counts: DataFrame, columns: list[str], by: str, map_labels: int = MAP_LABELS, broadcast_bytes: int = BROADCAST_BYTES
) -> LabelTable:
    """Write the counts; the same job observes what decides how each column is coded."""
    sizes = Observation()
    size = F.coalesce(F.octet_length(VALUE), F.lit(0)) + ROW_OVERHEAD
    metrics = [F.approx_count_distinct(by).alias("months")]
    for i, column in enumerate(columns):
        own = F.col(COLUMN) == column
        metrics += [F.count_if(own).alias(f"labels{i}"), F.sum(F.when(own, size)).alias(f"size{i}")]
    stored = durable(counts.observe(sizes, *metrics), "labels")
    seen = {name: value or 0 for name, value in observed(sizes).items()}
    # One budget for all tables that are broadcast together, filled from the smallest column up.
    large, used = [], 0
    for i in sorted(range(len(columns)), key=lambda i: (seen.get(f"size{i}", 0), columns[i])):
        used += seen.get(f"size{i}", 0)
        if used > broadcast_bytes:
            large.append(columns[i])
    few = {c for i, c in enumerate(columns) if seen.get(f"labels{i}", 0) <= map_labels * max(seen.get("months", 0), 1)}
    narrow = [c for c in columns if c in few and c not in large]
    medium = [c for c in columns if c not in few and c not in large]
    return LabelTable(stored, narrow, medium, large)


def _rank_order() -> list[Column]:
    """Most frequent first, equal counts by ascending value, NULL behind every label."""
    return [F.col(VALUE).isNull(), F.desc(COUNT), F.col(VALUE)]


def _as_code(rank: Column) -> Column:
    """Rank from 0. NULL ranks last, which is its code, unless there is no label at all."""
    return F.when((rank > 0) | F.col(VALUE).isNotNull(), rank).cast("int")


def rank_labels(counts: DataFrame, by: str = SNAPSHOT) -> DataFrame:
    """(column_name, by, value, code), for label tables a task per (column, month) can sort."""
    rank = F.row_number().over(Window.partitionBy(COLUMN, by).orderBy(*_rank_order())) - 1
    return counts.withColumn("_rank", rank).select(COLUMN, by, VALUE, _as_code(F.col("_rank")).alias(CODE))


def rank_labels_at_scale(counts: DataFrame, by: str = SNAPSHOT) -> DataFrame:
    """``rank_labels`` without a whole month in one task.

    The labels are range-partitioned in rank order; the code of a label is its place in
    its partition plus the labels of its month in earlier partitions.
    """
    group = [COLUMN, by]
    placed = counts.repartitionByRange(*group, *_rank_order()).withColumn("_part", F.spark_partition_id())
    placed = durable(placed, "placed-labels")  # fixes the sampled partition bounds
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*group, "_part")
        .agg(F.count("*").alias("_size"))
        .select(*group, "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    )
    place = F.row_number().over(Window.partitionBy(*group, "_part").orderBy(*_rank_order())) - 1
    offsets = offsets.select(*[F.col(c).alias(f"{c}_of") for c in group], F.col("_part").alias("_part_of"), "_offset")
    same = [F.col(c).eqNullSafe(F.col(f"{c}_of")) for c in group]  # a month may be NULL
    ranked = placed.withColumn("_place", place).join(offsets, same[0] & same[1] & (F.col("_part") == F.col("_part_of")))
    return ranked.select(*group, VALUE, _as_code(F.col("_offset") + F.col("_place")).alias(CODE))


def _index_by_maps(df: DataFrame, codes: DataFrame, columns: list[str], by: str, keep: bool = True) -> DataFrame:
    """One broadcast row per month with a value -> code map and a label count per column. What
    is no label has the code after the last one, unless ``keep`` is off."""
    known = F.col(VALUE).isNotNull()
    entry = F.struct(VALUE, CODE)
    folded = []
    for i, column in enumerate(columns):
        own = (F.col(COLUMN) == column) & known
        folded += [
            F.map_from_entries(F.collect_list(F.when(own, entry))).alias(f"_codes{i}"),
            F.count_if(own).cast("int").alias(f"_labels{i}"),
        ]
    by_month = codes.withColumnRenamed(by, "_by").groupBy("_by").agg(*folded)
    joined = df.join(F.broadcast(by_month), F.col(by).eqNullSafe(F.col("_by")), "left")
    index = {}
    for i, column in enumerate(columns):
        code = F.try_element_at(f"_codes{i}", F.col(column))
        index[f"{column}_index"] = F.coalesce(code, F.nullif(F.col(f"_labels{i}"), F.lit(0))) if keep else code
    return joined.withColumns(index).select(*df.columns, *index)


def _index_by_broadcast(df: DataFrame, codes: DataFrame, columns: list[str], by: str) -> DataFrame:
    for column in columns:
        own = codes.where(F.col(COLUMN) == column).select(  # the window's key: ranks this column alone
            F.col(by).alias("_by"), F.col(VALUE).alias("_value"), F.col(CODE).alias(f"{column}_index")
        )
        same = F.col(by).eqNullSafe(F.col("_by")) & F.col(column).eqNullSafe(F.col("_value"))
        df = df.join(F.broadcast(own), same, "left").drop("_by", "_value")
    return df


def _index_by_shuffle(
    df: DataFrame, codes: DataFrame, counts: DataFrame, columns: list[str], by: str
) -> DataFrame:
    """Look the codes up for the distinct combinations of the columns, then join them back.

    The wide rows are shuffled once, whatever the number of columns; the narrow table of
    combinations once per column. NULL is made a key of its own for value and month, and
    the counts tell the hot keys.
    """
    month_type = df.schema[by].dataType
    some_month = F.lit("1970-01-01" if month_type.typeName() in ("date", "timestamp") else "0").cast(month_type)

    def month(column: str) -> dict[str, Column]:
        return {"_no_month": F.col(column).isNull(), "_month": F.coalesce(F.col(column), some_month)}

    def value(column: str) -> dict[str, Column]:
        return {"_absent": F.col(column).isNull(), "_text": F.coalesce(F.col(column), F.lit(""))}

    own = [F.col(c).alias(f"_value{i}") for i, c in enumerate(columns)]
    combination = F.md5(F.to_json(F.struct(*own), {"ignoreNullFields": "false"}).cast("binary")).alias("_combination")
    rows = df.select("*", *[c.alias(k) for k, c in month(by).items()], combination)
    key = ["_no_month", "_month", "_combination"]
    distinct = rows.groupBy(*key).agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in columns])
    distinct = durable(distinct, "combinations")
    coded = distinct
    for column in columns:
        is_own = F.col(COLUMN) == column
        on = ["_no_month", "_month", "_absent", "_text"]
        table = codes.where(is_own).withColumns({**month(by), **value(VALUE)})
        table = table.select(*on, F.col(CODE).alias(f"{column}_index"))
        known = coded.withColumns(value(column))
        hot = hot_keys_from_counts(known.groupBy(*on).agg(F.count("*").alias("n")), on, n_sides=2)
        coded = spread_left_join(known, [table], on, hot=hot).drop("_absent", "_text")
    index = coded.select(*key, *[f"{column}_index" for column in columns])
    hot = hot_keys_from_counts(distinct.select(*key, "n"), key, n_sides=2)
    return spread_left_join(rows, [index], key, hot=hot).drop(*key)


def string_index(
    df: DataFrame,
    columns: list[str],
    by: str = SNAPSHOT,
    map_labels: int = MAP_LABELS,
    broadcast_bytes: int = BROADCAST_BYTES,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Add ``<column>_index`` for each column: its rank by frequency within ``by``.

    NULL gets the code after the last label; a column that is NULL throughout a month
    gets NULL there. The empty string is a label like any other. ``counts`` are the
    ``label_counts`` of ``df`` if they are known without reading it; they must have NULL as a
    value of every column and month that may hold it.
    """
    names = df.columns
    counts = label_counts(df, columns, by) if counts is None else counts
    table = store_labels(counts, columns, by, map_labels, broadcast_bytes)
    own = lambda some: table.counts.where(F.col(COLUMN).isin(some))
    if table.narrow:
        df = _index_by_maps(df, rank_labels(own(table.narrow), by), table.narrow, by)
    if table.medium:
        df = _index_by_broadcast(df, rank_labels(own(table.medium), by), table.medium, by)
    if table.large:
        codes = durable(rank_labels_at_scale(own(table.large), by))
        df = _index_by_shuffle(df, codes, own(table.large), table.large, by)
    return df.select(*names, *[f"{column}_index" for column in columns])
