"""Financials, clickstream and attributes joined into one row per financial record."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from riskloom.operators.durable import BROADCAST_BYTES, ROW_OVERHEAD, durable, observed
from riskloom.operators.indexing import COLUMN, COUNT, VALUE, label_counts, string_index
from riskloom.operators.joins import MIN_HOT_ROWS, hot_keys, repeated_keys, spread_left_join
from riskloom.operators.projection import classify_columns, fill_columns, select_except
from riskloom.operators.snapshots import slice_snapshot
from riskloom.schemas import KEYS, SNAPSHOT

# Categorical columns without an index, and columns dropped from the result.
UNINDEXED = ["Type_of_Loan", "Payment_of_Min_Amount_Category", "Credit_History_Age"]
DROPPED = ["Payment_of_Min_Amount", "Payment_Behaviour", "Payment_of_Min_Amount_Category", "Age_Group", "Occupation"]


def join_clickstream(financials: DataFrame, clickstream: DataFrame, hot="auto") -> DataFrame:
    """Left join by customer and month; several clickstream rows of a key fan out."""
    return spread_left_join(financials, [clickstream], KEYS, hot)


def join_attributes(df: DataFrame, attributes: DataFrame, hot="auto") -> DataFrame:
    """Left join with the attributes of the same month, which has a customer once."""
    return spread_left_join(df, [attributes], KEYS, hot, unique=[1])


def joined_features(
    financials: DataFrame,
    clickstream: DataFrame,
    attributes: DataFrame,
    hot="auto",
    unique=(2,),
    groups: Sequence[Sequence[dt.date]] = (),
) -> DataFrame:
    """Both joins over one shuffle of the financials.

    ``groups`` names all months of the tables in several groups, each of which is joined by itself:
    tables in buckets have more tasks then. With hot keys all months are joined at once.
    """
    features = [clickstream, attributes]
    if len(groups) > 1:
        if isinstance(hot, str):
            hot = hot_keys([financials, *features], KEYS, unique=unique)
        if hot is None:
            parts = [[slice_snapshot(df, days) for df in (financials, *features)] for days in groups]
            return reduce(DataFrame.unionAll, [spread_left_join(fact, own, KEYS, None) for fact, *own in parts])
    return spread_left_join(financials, features, KEYS, hot, unique=unique)


@dataclass(frozen=True)
class Repeated:
    """Stored keys that a feature table has several times, with the rows of each table."""

    keys: DataFrame
    names: list[str]
    n: int
    most: dict[str, int]  # rows of the most frequent key
    months: list[dt.date]

    def weigh(self, df: DataFrame, names: list[str]) -> tuple[DataFrame, Column]:
        """``df`` with the counts of its keys, and how often a row occurs once joined with ``names``."""
        if not self.n:
            return df, F.lit(1).cast("long")
        small = self.n * ROW_OVERHEAD * len(self.names) <= BROADCAST_BYTES
        joined = df.join(F.broadcast(self.keys) if small else self.keys, KEYS, "left")
        times = [F.greatest(F.coalesce(f"_{name}", F.lit(1)), F.lit(1)) for name in names]
        return joined, reduce(Column.__mul__, times, F.lit(1).cast("long"))


def find_repeated(features: dict[str, DataFrame]) -> Repeated:
    found = repeated_keys({f"_{name}": df for name, df in features.items()}, KEYS)
    seen = Observation()
    most = [F.max(f"_{name}").alias(name) for name in features]
    found = durable(found.observe(seen, F.count("*").alias("_n"), F.collect_set(SNAPSHOT).alias("_months"), *most), "repeated")
    got = observed(seen)
    most_rows = {name: got.get(name) or 0 for name in features}
    return Repeated(found, list(features), got.get("_n", 0), most_rows, sorted(got.get("_months", [])))


def joined_label_counts(
    financials: DataFrame,
    features: dict[str, DataFrame],
    columns: list[str],
    repeated: Repeated,
    by: str = SNAPSHOT,
    report: Observation | None = None,
) -> DataFrame:
    """``label_counts`` of the joined table without joining it.

    A row of the financials counts as often as the feature rows of its key say, a row of a
    feature table as often as the financials have its key (times the other tables' rows).
    ``report`` observes, while this runs, which financial rows the join multiplies.
    """
    wide = dict.fromkeys([*KEYS, by])
    values = [F.col(c) if c in financials.columns else F.lit(None).cast("string").alias(c) for c in columns]
    rows, weight = repeated.weigh(financials.select(*wide, *values), repeated.names)
    weighted = rows.withColumn("_weight", weight)
    if report is not None:
        weighted = weighted.observe(report, *_multiplied(repeated))
    counts = label_counts(weighted, columns, by, "_weight")
    met = financials.dropna(subset=KEYS).groupBy(*wide).agg(F.count("*").alias("_rows"))
    for name, feature in features.items():
        own = [c for c in columns if c in feature.columns and c not in financials.columns]
        if not own:
            continue
        matched = feature.select(*KEYS, *own).join(met, KEYS)
        rows, weight = repeated.weigh(matched, [other for other in repeated.names if other != name])
        counts = counts.unionByName(label_counts(rows.withColumn("_weight", weight * F.col("_rows")), own, by, "_weight"))
    return counts.groupBy(COLUMN, by, VALUE).agg(F.sum(COUNT).alias(COUNT))


def _multiplied(repeated: Repeated) -> list[Column]:
    """Per month and feature table, the financial rows that meet several rows."""
    metrics = [F.count("*").alias("rows")]
    if repeated.n:
        for i, month in enumerate(repeated.months):
            here = F.col(SNAPSHOT) == F.lit(month)
            metrics += [F.count_if(here & (F.col(f"_{name}") > 1)).alias(f"{name}_{i}") for name in repeated.names]
    return metrics


def combined_features(
    financials: DataFrame,
    clickstream: DataFrame,
    attributes: DataFrame,
    hot="auto",
    index_by: str = SNAPSHOT,
    fan_out: list[tuple] | None = None,
    groups: Sequence[Sequence[dt.date]] = (),
) -> DataFrame:
    """The model table: numeric gaps 0, text columns indexed by frequency within the month.

    The labels are counted on the narrow sources, weighted by what the joins will make of
    their rows, so the wide joined rows exist once, in the result. ``fan_out`` receives
    (month, feature table, repeated keys, financial rows they multiply) of the joins. ``groups``
    are those of ``joined_features``.
    """
    features = {"clickstream": clickstream, "attributes": attributes}
    repeated = find_repeated(features)
    # A key is no hot key of a feature table unless it is repeated that often there.
    unique = [i for i, name in enumerate(features, start=1) if repeated.most[name] <= MIN_HOT_ROWS]
    joined = joined_features(financials, clickstream, attributes, hot, unique, groups)
    categorical, numeric = classify_columns(joined, KEYS)
    indexed = [c for c in categorical if c not in UNINDEXED]
    report = Observation()
    counts = joined_label_counts(financials, features, indexed, repeated, index_by, report)
    out = string_index(fill_columns(joined, numeric, 0), indexed, index_by, counts=counts)
    if fan_out is not None:
        fan_out += _fan_out_rows(repeated, observed(report))
    return select_except(out, DROPPED)


def _fan_out_rows(repeated: Repeated, seen: dict) -> list[tuple]:
    if not repeated.n:
        return []
    several = [F.count_if(F.col(f"_{name}") > 1).alias(name) for name in repeated.names]
    keys = {row[SNAPSHOT]: row for row in repeated.keys.groupBy(SNAPSHOT).agg(*several).collect()}
    return [
        (month, name, keys[month][name], seen.get(f"{name}_{i}", 0))
        for i, month in enumerate(repeated.months)
        for name in repeated.names
    ]
