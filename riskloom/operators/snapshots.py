"""Monthly snapshots: slicing, calendar and row-count audits."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.schemas import SNAPSHOT


def as_dates(dates) -> list[dt.date]:
    """One date or many, as ``datetime.date``; ISO text is accepted."""
    if isinstance(dates, (str, dt.date)):
        dates = [dates]
    return [dt.date.fromisoformat(d) if isinstance(d, str) else d for d in dates]


def slice_snapshot(df: DataFrame, dates: str | dt.date | Iterable, required: bool = True) -> DataFrame:
    """Rows of the given snapshot(s); rows without a date belong to none.

    On a lake table this is partition pruning. With ``required=False`` a source that
    has no snapshot column is valid for every month: each row is repeated once per date.
    """
    days = [F.lit(d) for d in as_dates(dates)]
    if SNAPSHOT in df.columns:
        return df.where(F.col(SNAPSHOT).isin(days)) if days else df.where(F.lit(False))
    if required:
        raise ValueError(f"source has no {SNAPSHOT} column")
    return df.withColumn(SNAPSHOT, F.explode(F.array(*days).cast("array<date>")))


def first_of_months(start: Column, end: Column) -> Column:
    """Array of month starts, from the month of ``start`` up to and including ``end``."""
    first = F.trunc(start, "MM")
    months = F.sequence(first, end, F.expr("INTERVAL 1 MONTH"))
    return F.when(first <= end, months).otherwise(F.array().cast("array<date>"))


def snapshot_calendar(spark: SparkSession, start, end) -> DataFrame:
    """One row per month between two dates; empty if ``end`` precedes the first month."""
    start, end = as_dates([start, end])
    return spark.range(1).select(F.explode(first_of_months(F.lit(start), F.lit(end))).alias(SNAPSHOT))


def calendar_of(df: DataFrame, column: str = SNAPSHOT) -> DataFrame:
    """The months a table spans, gaps included."""
    span = df.agg(F.min(column).alias("start"), F.max(column).alias("end"))
    return span.select(F.explode(first_of_months(F.col("start"), F.col("end"))).alias(SNAPSHOT))


def audit_counts(df: DataFrame, table: str) -> DataFrame:
    """(table, snapshot_date, n): rows per month from one partially aggregated job."""
    return df.groupBy(SNAPSHOT).agg(F.count("*").alias("n")).select(F.lit(table).alias("table"), SNAPSHOT, "n")
