"""Duplicate audits and the one-row-per-customer rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.cleaning import default_date
from riskloom.schemas import CUSTOMER, SNAPSHOT

# Order among rows of one customer and date; remaining columns follow, so only exact
# copies are interchangeable.
TIE_BREAKERS = ["Name", "Age", "SSN", "Occupation"]


def latest_per_customer(df: DataFrame, scope: str = "snapshot", run_date=None) -> DataFrame:
    """One row per customer and month (``scope="snapshot"``) or overall (``scope="all"``).

    The latest date wins, then the tie-breakers in ascending order with NULLs last. Rows
    without a customer form one group. Rows without a date take part in the month of
    ``run_date`` behind the dated ones.

    ``rank = 1`` lets Spark apply the limit before the shuffle, so a customer holding a
    large share of the table sends one row per task, not all of them.
    """
    if scope not in ("snapshot", "all"):
        raise ValueError(f"unknown scope: {scope}")
    month = default_date(SNAPSHOT, run_date)
    group = [month, CUSTOMER] if scope == "snapshot" else [CUSTOMER]
    named = [c for c in TIE_BREAKERS if c in df.columns]
    rest = [c for c in df.columns if c not in (*named, CUSTOMER, SNAPSHOT)]
    order = [F.col(SNAPSHOT).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in named + rest]]
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def latest_with_counts(df: DataFrame, scope: str = "snapshot", run_date=None, count: str = "n_rows") -> DataFrame:
    """The rows of ``latest_per_customer`` with the number of rows of their group, by one shuffle.

    One aggregate per group takes the least row of the same order and counts. Tasks combine
    their rows first, so a customer holding a large share of the table sends one row per task.
    """
    if scope not in ("snapshot", "all"):
        raise ValueError(f"unknown scope: {scope}")
    group = {"_month": default_date(SNAPSHOT, run_date)} if scope == "snapshot" else {}
    named = [c for c in TIE_BREAKERS if c in df.columns]
    rest = [c for c in df.columns if c not in (*named, CUSTOMER, SNAPSHOT)]
    dated = [F.col(SNAPSHOT).isNull().alias("_undated"), (-F.unix_date(SNAPSHOT)).alias("_age")]
    ordered = [x for i, c in enumerate(named + rest) for x in (F.col(c).isNull().alias(f"_null{i}"), F.col(c).alias(f"_value{i}"))]
    least = F.min(F.struct(*dated, *ordered)).alias("_least")
    keys = [*[month.alias(name) for name, month in group.items()], CUSTOMER]
    kept = df.groupBy(*keys).agg(least, F.count("*").alias(count))
    value = {c: F.col(f"_least._value{i}") for i, c in enumerate(named + rest)}
    value |= {CUSTOMER: F.col(CUSTOMER), SNAPSHOT: F.date_from_unix_date(-F.col("_least._age"))}
    return kept.select(*[value[c].alias(c) for c in df.columns], count)


def duplicate_groups(df: DataFrame, key: Column | str, name: str) -> DataFrame:
    """(snapshot_date, name, n) of the keys that occur more than once in a month."""
    key = F.col(key) if isinstance(key, str) else key
    return df.groupBy(SNAPSHOT, key.alias(name)).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def duplicate_summary(df: DataFrame, key: Column | str, name: str) -> DataFrame:
    """(snapshot_date, duplicated, surplus_rows) per month that has duplicates."""
    groups = duplicate_groups(df, key, name)
    return groups.groupBy(SNAPSHOT).agg(
        F.count("*").alias("duplicated"), (F.sum("n") - F.count("*")).alias("surplus_rows")
    )
