"""Tables stored in buckets of customers within the month, so that joins by customer and month
move no rows.

The files are Parquet like those of any table of the lake and can be read as such. That they
are bucketed is Spark's own layout, which it takes from a table declaration; the declaration is
made for a write or a read and lives in the session alone. The number of buckets is kept in the
notes of the table's columns and is the same in all months.

A join uses the buckets where nothing else has to be shuffled. It has a task per bucket; joins of
some months each, put together, have as many tasks as there are cores for. Where a customer is so frequent
that its rows are cut into slices, Spark reads the same files in splits as usual.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from math import ceil

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.durable import BROADCAST_BYTES, observed, remove_table
from riskloom.operators.snapshots import as_dates, audit_counts, slice_snapshot
from riskloom.schemas import CUSTOMER, SNAPSHOT
from riskloom.sources.columns import record_columns, recorded_buckets, recorded_columns
from riskloom.sources.lake import table_path

BUCKET_JOINS = {
    # Lets a join by (customer, month) use tables that lie by customer alone.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Joins of some months each keep their own tasks when they are put together.
    "spark.sql.unionOutputPartitioning": "false",
}
JOINED_ROWS = 1_000_000  # of a bucket and some months, for one task
FEW_ROWS = 50_000  # for which another task does not pay
MONTH_GROUPS = 16  # joins in one plan
BROADCAST_LIMIT = "spark.sql.autoBroadcastJoinThreshold"


@contextmanager
def joins_use_buckets(spark: SparkSession) -> Iterator[None]:
    """Inside, joins by customer and month are planned on the buckets. Feature tables of few months
    may be broadcast, for all joins of a plan together within the budget."""
    known = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    settings = {**BUCKET_JOINS, BROADCAST_LIMIT: str(min(known, BROADCAST_BYTES // (4 * MONTH_GROUPS)))}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def month_groups(rows: Mapping[dt.date, int], buckets: int, cores: int) -> list[list[dt.date]]:
    """The months in runs of about equal rows. A join of one run has a task per bucket, all runs
    together some tasks per core, however few the buckets are and however large they grow."""
    total = sum(rows.values())
    wanted = max(2 * cores, total / JOINED_ROWS) / buckets
    n = max(1, min(ceil(wanted), total // (buckets * FEW_ROWS), MONTH_GROUPS, len(rows)))
    groups: list[list[dt.date]] = [[] for _ in range(n)]
    seen = 0
    for day in sorted(rows):
        groups[min(n - 1, (2 * seen + rows[day]) * n // (2 * total) if total else 0)].append(day)
        seen += rows[day]
    return [group for group in groups if group]


def _declare(spark: SparkSession, path: str, schema: T.StructType, buckets: int, use: str) -> str:
    """Name of a declaration of the files below ``path``; an earlier one for this use goes."""
    name = f"riskloom_{use}_{hashlib.md5(path.encode()).hexdigest()}"
    columns = [f for f in schema if f.name != SNAPSHOT] + [schema[SNAPSHOT]]
    listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # of a table with a location: the declaration alone
    spark.sql(
        f"CREATE TABLE {name} ({listed}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({SNAPSHOT}) "
        f"CLUSTERED BY ({CUSTOMER}) SORTED BY ({CUSTOMER}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return name


def write_bucketed(df: DataFrame, base: str, layer: str, table: str, snapshots: Iterable, buckets: int) -> dict[dt.date, int]:
    """Write the months of ``snapshots`` in buckets and return their rows; other months stay.

    Rows are gathered by customer first; a customer too large for one file has several.
    """
    spark, path, days = df.sparkSession, table_path(base, layer, table), as_dates(snapshots)
    record_columns(spark, path, df.schema, days, buckets)
    name = _declare(spark, path, df.schema, buckets, "write")
    months = Observation()
    gathered = df.select(*spark.table(name).columns).hint("rebalance", buckets, CUSTOMER)
    written = gathered.observe(months, F.collect_set(SNAPSHOT).alias("months"))
    written.write.mode("overwrite").insertInto(name)  # the months written alone, as declared
    spark.sql(f"DROP TABLE {name}")
    found = set(observed(months).get("months") or [])
    for day in days:
        if day not in found:
            remove_table(spark, f"{path}/{SNAPSHOT}={day.isoformat()}")
    stored = slice_snapshot(spark.read.schema(df.schema).parquet(path), sorted(found))
    counts = {row[SNAPSHOT]: row.n for row in audit_counts(stored, table).collect()}
    return {day: counts.get(day, 0) for day in days}


def read_bucketed(spark: SparkSession, base: str, layer: str, table: str, snapshots: Iterable) -> DataFrame | None:
    """The months of a bucketed table with all their columns; None if it has no buckets."""
    path, days = table_path(base, layer, table), as_dates(snapshots)
    buckets, schema = recorded_buckets(spark, path), recorded_columns(spark, path, days)
    if not buckets or schema is None:
        return None
    name = _declare(spark, path, schema, buckets, "read")
    spark.catalog.recoverPartitions(name)
    return slice_snapshot(spark.table(name), days)
