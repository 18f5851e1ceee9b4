"""Bronze, silver and gold for a range of months, one write job per table.

There is no loop over months: the month is a key of every plan and the partition of
every table. Running fewer months means passing fewer; their partitions are replaced.

Every layer that is finished is noted month by month, with a fingerprint of the raw rows and
the settings it was made from. A run that resumes takes up each month where it was left, and
does nothing for months whose raw rows are the same.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.dedup import duplicate_summary
from riskloom.operators.durable import observed, path_exists, scratch_scope
from riskloom.operators.snapshots import as_dates, slice_snapshot, snapshot_calendar
from riskloom.operators.vocabulary import (
    THRESHOLD,
    listed_columns,
    loan_type_columns,
    store_vocabulary,
    widen_loan_types,
)
from riskloom.plans.attributes import attributes_gold, attributes_silver
from riskloom.plans.clickstream import clickstream_gold, clickstream_silver
from riskloom.plans.combined import combined_features
from riskloom.plans.financials import financials_gold, financials_silver
from riskloom.plans.loans import label_store, loan_silver
from riskloom.schemas import (
    ATTRIBUTES_GOLD,
    ATTRIBUTES_SILVER,
    FINANCIALS_SILVER,
    LABEL_STORE,
    LOAN_SILVER,
    LOAN_TYPE_COLUMNS,
    LOAN_TYPES_PRESENT,
    SNAPSHOT,
    struct,
)
from riskloom.session import compiled_methods, even_splits
from riskloom.sources.buckets import joins_use_buckets, month_groups, read_bucketed, write_bucketed
from riskloom.sources.lake import read_layer, table_path, write_bronze, write_layer
from riskloom.sources.raw import OPTIONAL_SNAPSHOT, RAW_TYPES, read_source

# Tables whose columns do not depend on the data; they read back even without any row.
FIXED_SCHEMAS = {
    **{("bronze", source): struct(types) for source, types in RAW_TYPES.items() if source != "clickstream"},
    ("silver", "loans"): struct(LOAN_SILVER),
    ("silver", "attributes"): struct(ATTRIBUTES_SILVER),
    ("silver", "financials"): struct(FINANCIALS_SILVER),
    ("gold", "label_store"): struct(LABEL_STORE),
    ("gold", "attributes"): struct(ATTRIBUTES_GOLD),
}
# What is joined by customer and month, and may be stored in buckets of customers.
BUCKETED = {("gold", "financials"), ("gold", "clickstream"), ("gold", "attributes")}
AUDIT_SCHEMA = "layer string, table string, snapshot_date date, n long"
Audit = list[tuple]


class Lake:
    """The tables under one base path, restricted to the months of a run."""

    def __init__(self, spark: SparkSession, base: str, snapshots: Iterable, buckets: int | None = None):
        self.spark, self.base, self.snapshots, self.buckets = spark, base, as_dates(snapshots), buckets
        self.audit: Audit = []
        self._schemas: dict[tuple[str, str], T.StructType] = dict(FIXED_SCHEMAS)

    def read(self, layer: str, table: str) -> DataFrame:
        if self.buckets and (layer, table) in BUCKETED:
            bucketed = read_bucketed(self.spark, self.base, layer, table, self.snapshots)
            if bucketed is not None:
                return bucketed
        schema = self._schemas.get((layer, table))
        return read_layer(self.spark, self.base, layer, table, self.snapshots, schema)

    def write(self, layer: str, tables: Mapping[str, DataFrame], rebalance: Iterable[str] = ()) -> None:
        """Write independent tables of a layer side by side, so that the last tasks of one
        leave no executors idle."""
        submit = inheritable_thread_target(self.spark)(self._write_table)
        with ThreadPoolExecutor(max_workers=len(tables)) as pool:
            jobs = [pool.submit(submit, df, layer, table, table in rebalance) for table, df in tables.items()]
        for job in jobs:
            self.audit += job.result()

    def _write_table(self, df: DataFrame, layer: str, table: str, rebalance: bool) -> Audit:
        if layer == "bronze":
            counts = write_bronze(df, self.base, table, self.snapshots)
        elif self.buckets and (layer, table) in BUCKETED:
            counts = write_bucketed(df, self.base, layer, table, self.snapshots, self.buckets)
        else:
            counts = write_layer(df, self.base, layer, table, self.snapshots, rebalance)
        self._schemas[layer, table] = df.schema
        return [(layer, table, day, n) for day, n in counts.items()]


def read_raw_months(spark: SparkSession, raw_paths: Mapping[str, str], snapshots: Iterable) -> dict[str, DataFrame]:
    """The raw rows of some months, source by source."""
    raw = {source: read_source(spark, raw_paths[source], source) for source in RAW_TYPES}
    return {s: slice_snapshot(df, snapshots, s not in OPTIONAL_SNAPSHOT) for s, df in raw.items()}


def build_bronze(lake: Lake, raw_paths: Mapping[str, str]) -> None:
    lake.write("bronze", read_raw_months(lake.spark, raw_paths, lake.snapshots))


def build_silver(lake: Lake) -> None:
    """Only the attribute table regroups rows (to find one per customer); the others are map-only.
    The job that keeps one row per customer also counts the customers that had several."""
    plans = {"loans": loan_silver, "clickstream": clickstream_silver, "financials": financials_silver}
    tables = {table: plan(lake.read("bronze", table)) for table, plan in plans.items()}
    several = Observation()
    customers = attributes_silver(lake.read("bronze", "attributes"), count="_rows")
    repeated = [F.count_if((F.col(SNAPSHOT) == F.lit(day)) & (F.col("_rows") > 1)).alias(f"m{i}") for i, day in enumerate(lake.snapshots)]
    tables["attributes"] = customers.observe(several, F.count("*").alias("rows"), *repeated).drop("_rows")
    lake.write("silver", tables, ["attributes"])
    seen = observed(several)
    lake.audit += [("audit", "duplicate_customers", day, seen.get(f"m{i}", 0)) for i, day in enumerate(lake.snapshots)]
    shared = duplicate_summary(lake.read("silver", "attributes").where(F.col("SSN").isNotNull()), "SSN", "SSN")
    counts = {row[SNAPSHOT]: row.duplicated for row in shared.collect()}
    lake.audit += [("audit", "duplicate_ssn", day, counts.get(day, 0)) for day in lake.snapshots]


def read_loan_types(spark: SparkSession, base: str) -> DataFrame:
    return read_layer(spark, base, "gold", "loan_types", schema=struct(LOAN_TYPE_COLUMNS))


def read_features(
    spark: SparkSession, base: str, table: str = "combined", snapshots=None, wide: bool = False
) -> DataFrame:
    """Gold ``combined`` or ``financials``, with the loan types of a row as an array.

    ``wide`` asks for one 0/1 column per loan type known to the lake instead. A type that is
    not in the vocabulary of a month is 0 there in ``combined`` and NULL in ``financials``.
    """
    df = read_layer(spark, base, "gold", table, snapshots)
    if not wide:
        return df
    fill = 0 if table == "combined" else None
    return widen_loan_types(df, read_loan_types(spark, base), fill).drop(LOAN_TYPES_PRESENT)


def month_vocabulary(lake: Lake, silver: DataFrame, threshold: int, loan_types: list[str] | None) -> DataFrame:
    """(snapshot_date, column_name, loan_type) of the run's months: counted, or the given list."""
    if loan_types is None:
        return loan_type_columns(silver, threshold).select(*LOAN_TYPE_COLUMNS)
    rows = [(day, name, t) for day in lake.snapshots for name, t in listed_columns(loan_types).items()]
    return lake.spark.createDataFrame(rows, struct(LOAN_TYPE_COLUMNS))


def build_gold(
    lake: Lake, dpd: int = 30, mob: int = 6, threshold: int = THRESHOLD, loan_types: list[str] | None = None
) -> None:
    """Gold tables of the run's months. The vocabulary of a month is kept as a table in any
    case; it tells which types were looked for."""
    silver = lake.read("silver", "financials")
    vocabulary = store_vocabulary(month_vocabulary(lake, silver, threshold, loan_types))
    write_layer(vocabulary.frame, lake.base, "gold", "loan_types", lake.snapshots, rebalance=True)
    tables = {
        "label_store": label_store(lake.read("silver", "loans"), dpd, mob),
        "attributes": attributes_gold(lake.read("silver", "attributes")),
        "clickstream": clickstream_gold(lake.read("silver", "clickstream")),
        "financials": financials_gold(silver, vocabulary),
    }
    # Labels are a tenth of the ledger's rows: merge them into few files.
    lake.write("gold", tables, rebalance=["label_store"])
    sources = [lake.read("gold", t) for t in ("financials", "clickstream", "attributes")]
    repeated: list[tuple] = []
    groups: list[list[dt.date]] = []
    if lake.buckets:
        rows = {day: n for layer, table, day, n in lake.audit if (layer, table) == ("gold", "financials")}
        groups = month_groups(rows, lake.buckets, lake.spark.sparkContext.defaultParallelism)
    with joins_use_buckets(lake.spark) if lake.buckets else nullcontext():
        lake.write("gold", {"combined": combined_features(*sources, fan_out=repeated, groups=groups)}, rebalance=["combined"])
    counts = {(f"{table}_repeated_{what}", day): n for day, table, *both in repeated for what, n in zip(("keys", "rows"), both)}
    for table in ("clickstream", "attributes"):
        for name in (f"{table}_repeated_keys", f"{table}_repeated_rows"):
            lake.audit += [("audit", name, day, counts.get((name, day), 0)) for day in lake.snapshots]


# --- what is finished -------------------------------------------------------------------------

LAYERS = ["bronze", "silver", "gold"]
FINISHED = f"at long, layer string, {SNAPSHOT} date, made_from string"
RULES = "1"  # raised when the rules of a layer change, so that months are made anew


HASH_PART = 22  # bits of a hash that are summed as one long, which holds the sum of 2^41 rows


def hash_sums(sources: Mapping[str, DataFrame]) -> DataFrame:
    """(month, source, rows, sums of the parts of the row hashes): sums of longs, as decimals of
    this size are objects."""
    narrow = []
    for source, df in sources.items():
        cells = [x for c in sorted(df.columns) for x in (F.when(F.col(c).isNotNull(), F.lit(c)), F.col(c))]
        narrow.append(df.select(SNAPSHOT, F.lit(source).alias("source"), F.xxhash64(*cells).alias("row")))
    low = F.lit((1 << HASH_PART) - 1).cast("long")
    shifted = [F.shiftright("row", i * HASH_PART) for i in range(3)]  # the last one has the sign
    parts = [F.sum(part if i == 2 else part.bitwiseAND(low)).alias(f"part{i}") for i, part in enumerate(shifted)]
    return reduce(DataFrame.unionAll, narrow).groupBy(SNAPSHOT, "source").agg(F.count("*").alias("n"), *parts)


def month_fingerprints(sources: Mapping[str, DataFrame], snapshots: Iterable) -> dict[dt.date, str]:
    """For each month, a text that changes with any value, row or repetition of its raw rows, and
    not with the order of rows or with columns that the month has no value in."""
    found: dict[dt.date, list[str]] = {day: [] for day in as_dates(snapshots)}
    for row in sorted(hash_sums(sources).collect(), key=lambda row: row.source):
        total = sum(row[f"part{i}"] << i * HASH_PART for i in range(3))
        found[row[SNAPSHOT]].append(f"{row.source}:{row.n}:{total}")
    return {day: " ".join([RULES, *parts]) for day, parts in found.items()}


def finished_layers(spark: SparkSession, base: str, snapshots: Iterable) -> dict[str, dict[dt.date, str]]:
    """What each layer's months were made from, as far as they were finished."""
    found: dict[str, dict[dt.date, str]] = {layer: {} for layer in LAYERS}
    path = table_path(base, "log", "finished")
    if path_exists(spark, path):
        lines = slice_snapshot(spark.read.schema(FINISHED).parquet(path), snapshots)
        for line in sorted(lines.collect(), key=lambda line: line["at"]):
            found[line.layer][line[SNAPSHOT]] = line.made_from
    return {layer: {day: text for day, text in days.items() if text} for layer, days in found.items()}


def _note(spark: SparkSession, base: str, layer: str, made_from: Mapping[dt.date, str | None]) -> None:
    """Add to the log what a layer's months were made from; None: they are out of date."""
    later = LAYERS[LAYERS.index(layer) + 1 :]
    at = time.time_ns()
    lines = [(at, name, day, text if name == layer else None) for day, text in made_from.items() for name in (layer, *later)]
    spark.createDataFrame(lines, FINISHED).coalesce(1).write.mode("append").parquet(table_path(base, "log", "finished"))


def backfill(
    spark: SparkSession,
    raw_paths: Mapping[str, str],
    base: str,
    start,
    end,
    dpd: int = 30,
    mob: int = 6,
    threshold: int = THRESHOLD,
    loan_types: list[str] | None = None,
    resume: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Run all layers for the months from ``start`` to ``end``.

    ``raw_paths`` names the CSV of ``loans``, ``clickstream``, ``attributes`` and
    ``financials``. Returns the audit (layer, table, snapshot_date, n): the rows stored, and
    under the layer ``audit`` the customers and SSNs that occur more than once, and the keys
    that ``combined`` finds several times in a feature table with the financial rows that
    become several by it. What the run kept in the shared folder meanwhile is removed.

    ``buckets`` stores the gold tables that ``combined`` joins in so many buckets of customers,
    and the joins move no rows then. The number stays for the life of a lake; it should be one
    that makes a bucket of all months of a run some hundred megabytes.

    With ``resume``, a layer of a month is left as it is if it was finished from the same raw
    rows and with the same settings; the audit tells what was made anew.
    """
    months = [row[SNAPSHOT] for row in snapshot_calendar(spark, start, end).collect()]
    settings = {"gold": f" {dpd} {mob} {threshold} {loan_types}"}
    audit: Audit = []
    with scratch_scope(spark), compiled_methods(spark), even_splits(spark):
        done = finished_layers(spark, base, months)
        made_from: dict[dt.date, str] = {}
        if resume and done["bronze"]:
            made_from = month_fingerprints(read_raw_months(spark, raw_paths, months), months)
        steps = {
            "bronze": lambda lake: build_bronze(lake, raw_paths),
            "silver": build_silver,
            "gold": lambda lake: build_gold(lake, dpd, mob, threshold, loan_types),
        }
        redone: set[dt.date] = set()
        for layer, build in steps.items():
            suffix = settings.get(layer, "")
            redone |= {day for day in months if day not in made_from or done[layer].get(day) != made_from[day] + suffix}
            todo = [day for day in months if day in redone]
            if not todo:
                continue
            _note(spark, base, layer, dict.fromkeys(todo))  # until it is finished
            lake = Lake(spark, base, todo, buckets)
            build(lake)
            audit += lake.audit
            if layer == "bronze":  # what was stored, which may be newer than what was looked at
                made_from |= month_fingerprints({table: lake.read("bronze", table) for table in RAW_TYPES}, todo)
            _note(spark, base, layer, {day: made_from[day] + suffix for day in todo})
    return spark.createDataFrame(audit, AUDIT_SCHEMA)
