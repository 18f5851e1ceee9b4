"""Layered Parquet tables, one directory per month.

A write replaces the months it is run for and leaves the others alone, so a backfill
can be repeated. Reads prune to the months asked for and have all columns of these months,
which are recorded by every write (``riskloom.sources.columns``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.durable import observed
from riskloom.operators.snapshots import as_dates, audit_counts, slice_snapshot
from riskloom.schemas import SNAPSHOT
from riskloom.sources.columns import record_columns, recorded_columns


def table_path(base: str, layer: str, table: str) -> str:
    return f"{base.rstrip('/')}/{layer}/{table}"


def write_layer(
    df: DataFrame,
    base: str,
    layer: str,
    table: str,
    snapshots: Iterable | None = None,
    rebalance: bool = False,
) -> dict[dt.date, int]:
    """Write a table by month and return its rows per month of ``snapshots``.

    ``rebalance`` gathers the rows of a month into full-sized files and is for frames
    whose tasks hold rows of many months; Spark splits large months and merges small
    ones. Frames that come straight from a lake scan need no such shuffle.

    With ``snapshots`` given, a month that has no rows any more is emptied, and the rows
    are counted from the footers of the files just written. The columns of the months are
    recorded before their rows, so that no reader misses a column.
    """
    spark = df.sparkSession
    path = table_path(base, layer, table)
    if snapshots is not None:
        record_columns(spark, path, df.schema, as_dates(snapshots))
    if rebalance:
        df = df.hint("rebalance", SNAPSHOT)
    months = Observation()
    watched = df.observe(months, F.collect_set(SNAPSHOT).alias("written"))
    writer = watched.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(SNAPSHOT).parquet(path)
    written = set(observed(months).get("written") or [])
    if snapshots is None:
        record_columns(spark, path, df.schema, written)
        return {}
    days = as_dates(snapshots)
    _empty_months(df, path, [day for day in days if day not in written])
    stored = slice_snapshot(spark.read.schema(df.schema).parquet(path), sorted(written))
    counts = {row[SNAPSHOT]: row.n for row in audit_counts(stored, table).collect()}
    return {day: counts.get(day, 0) for day in days}


def _empty_months(df: DataFrame, path: str, days: list[dt.date]) -> None:
    """Overwrite months that had rows in an earlier run and have none now."""
    if not days:
        return
    spark = df.sparkSession
    stale = audit_counts(slice_snapshot(spark.read.schema(df.schema).parquet(path), days), path).collect()
    schema = T.StructType([field for field in df.schema.fields if field.name != SNAPSHOT])
    for row in stale:
        month = f"{path}/{SNAPSHOT}={row[SNAPSHOT].isoformat()}"
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(month)


def write_bronze(df: DataFrame, base: str, table: str, snapshots: Iterable | None = None) -> dict[dt.date, int]:
    """Land a raw slice. Raw files mix months, hence the rebalance."""
    return write_layer(df, base, "bronze", table, snapshots, rebalance=True)


def read_layer(
    spark: SparkSession,
    base: str,
    layer: str,
    table: str,
    snapshots: Iterable | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Scan a table; with ``snapshots`` only those directories.

    The columns are those recorded for the months, or ``schema``; they are NULL in months that
    lack them. Tables that others wrote have no record; their footers are merged.
    """
    path = table_path(base, layer, table)
    days = None if snapshots is None else as_dates(snapshots)
    schema = schema or recorded_columns(spark, path, days)
    reader = spark.read.option("mergeSchema", True) if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return df if days is None else slice_snapshot(df, days)
