"""Left joins of one fact table with keyed feature tables, safe under hot keys.

Several left joins on the same keys share one shuffle of the fact table. AQE does not
split skewed partitions there (splitting would cost the shared partitioning), so a key
with a large share of the rows would end up in one task. Such keys are found first by
a narrow exact count, and only their rows are spread over numbered slices:

* a side in which the key is hot cuts its rows into slices by a hash of the row and of
  its partition number, so that a mass of identical copies is cut as well; both are the
  same when a lost task runs again;
* every other side repeats its rows for that key once per slice.

Keys that are not hot have one slice, and without any hot key the plan is the plain
chain of joins. Slicing changes the placement of rows, never the result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIN_HOT_ROWS = 1_000_000
PARTITIONS_PER_HOT_KEY = 4  # hot = more rows than this many average partitions


def _count_name(side: int) -> str:
    return f"_rows{side}"


def _slice_name(side: int) -> str:
    return f"_slice{side}"


def hot_keys(
    sides: Sequence[DataFrame],
    keys: Sequence[str],
    min_rows: int = MIN_HOT_ROWS,
    partitions: int | None = None,
    unique: Sequence[int] = (),
) -> DataFrame | None:
    """Keys too large for one task in some side, with the slices each side needs; else None.

    Sides listed in ``unique`` have about one row per key and are not counted.

    First rows per key-hash bucket are counted: the partial aggregates are at most
    ``buckets`` rows per task whatever the number of keys. Only if a bucket exceeds the
    threshold are its keys counted one by one. At most ``partitions`` keys per side can
    pass, so the answer is small enough to collect and to broadcast.
    """
    partitions = partitions or shuffle_partitions(sides[0])
    buckets = min(max(4 * partitions, 1024), 65536)
    # A NULL key matches nothing, so it can be hot in the fact table alone.
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    narrow = [
        side.where(known if i else F.lit(True)).select(
            F.lit(i).alias("_side"), F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("_bucket"), *keys
        )
        for i, side in enumerate(sides)
        if i not in unique
    ]
    stacked = reduce(DataFrame.unionByName, narrow)
    census = stacked.groupBy("_side", "_bucket").agg(F.count("*").alias("n")).collect()

    totals = [sum(r.n for r in census if r["_side"] == i) for i in range(len(sides))]
    limits = [max(min_rows, PARTITIONS_PER_HOT_KEY * total / partitions) for total in totals]
    suspects = [r["_bucket"] for r in census if r.n > limits[r["_side"]]]
    if not suspects:
        return None

    is_suspect = F.col("_bucket").isin(suspects)
    over_limit = reduce(
        Column.__or__, [(F.col("_side") == i) & (F.col("n") > limit) for i, limit in enumerate(limits)]
    )
    found = stacked.where(is_suspect).groupBy("_side", *keys).agg(F.count("*").alias("n")).where(over_limit).collect()
    slices: dict[tuple, list[int]] = {}
    for row in found:
        side, share = row["_side"], row.n / totals[row["_side"]]
        per_side = slices.setdefault(tuple(row[k] for k in keys), [1] * len(sides))
        per_side[side] = max(2, ceil(share * partitions))
    return _slices_frame(sides[0], keys, slices, len(sides))


def repeated_keys(features: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """(keys, rows of the key in each feature table) of the keys that some table has several times.

    These are the keys that multiply rows of a fact table; usually there are few of them.
    """
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    narrow = [side.where(known).select(*keys, F.lit(name).alias("_side")) for name, side in features.items()]
    counts = [F.count_if(F.col("_side") == name).alias(name) for name in features]
    several = reduce(Column.__or__, [F.col(name) > 1 for name in features])
    return reduce(DataFrame.unionByName, narrow).groupBy(*keys).agg(*counts).where(several)


def fan_out(fact: DataFrame, feature: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """(by, repeated_keys, fact_rows, joined_rows) of a left join: the feature keys with several
    rows, the fact rows they multiply, and what these rows become. Groups without any are absent.

    Both sides are counted per key before they meet, so a hot key is one row.
    """
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    narrow = [side.where(known).select(*keys, F.lit(i).alias("_side")) for i, side in enumerate((fact, feature))]
    rows = [F.count_if(F.col("_side") == i).alias(f"_n{i}") for i in range(2)]
    per_key = narrow[0].unionByName(narrow[1]).groupBy(*keys).agg(*rows).where(F.col("_n1") > 1)
    joined = F.sum(F.col("_n0") * F.col("_n1")).alias("joined_rows")
    return per_key.groupBy(by).agg(F.count("*").alias("repeated_keys"), F.sum("_n0").alias("fact_rows"), joined)


def hot_keys_from_counts(
    counts: DataFrame, keys: Sequence[str], n_sides: int, count: str = "n", min_rows: int = MIN_HOT_ROWS
) -> DataFrame | None:
    """``hot_keys`` when the rows per key of the fact table (side 0) are known already."""
    partitions = shuffle_partitions(counts)
    total = counts.agg(F.sum(count)).first()[0] or 0
    limit = max(min_rows, PARTITIONS_PER_HOT_KEY * total / partitions)
    found = counts.where(F.col(count) > limit).collect()
    slices = {
        tuple(row[k] for k in keys): [max(2, ceil(row[count] / total * partitions))] + [1] * (n_sides - 1)
        for row in found
    }
    return _slices_frame(counts, keys, slices, n_sides)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _slices_frame(like: DataFrame, keys: Sequence[str], slices: dict, n_sides: int) -> DataFrame | None:
    if not slices:
        return None
    schema = T.StructType(
        [T.StructField(k, like.schema[k].dataType) for k in keys]
        + [T.StructField(_count_name(i), T.IntegerType()) for i in range(n_sides)]
    )
    return like.sparkSession.createDataFrame([(*key, *counts) for key, counts in slices.items()], schema)


def _with_slices(df: DataFrame, side: int, n_sides: int, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """Number the slice of each row on its own axis and repeat it along the other axes."""
    columns = df.columns
    row_hash = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in columns])
    listed = F.broadcast(hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], *[_count_name(i) for i in range(n_sides)]))
    match = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
    out = df.join(listed, match, "left").drop(*[f"_hot_{k}" for k in keys])
    for i in range(n_sides):
        count = F.coalesce(_count_name(i), F.lit(1))
        own = F.pmod(row_hash, count).cast("int")
        out = out.withColumn(_slice_name(i), own if i == side else F.explode(F.sequence(F.lit(0), count - 1)))
    return out


def _slices_that_exist(hot: DataFrame, features: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """``hot`` with one slice for keys that a feature table (without NULL keys) does not have,
    whatever the caller says: a copy of a fact row that meets no slice would be lost."""
    rows = [row.asDict() for row in hot.collect()]  # few, as they are to be broadcast
    for i, feature in enumerate(features, start=1):
        name = _count_name(i)
        if any(row[name] > 1 for row in rows):
            listed = F.broadcast(hot.where(F.col(name) > 1).select(*keys))
            found = feature.select(*keys).join(listed, keys, "left_semi").distinct().collect()
            present = {tuple(row) for row in found}
            for row in rows:
                if tuple(row[k] for k in keys) not in present:
                    row[name] = 1
    return hot.sparkSession.createDataFrame([tuple(row[c] for c in hot.columns) for row in rows], hot.schema)


def spread_left_join(
    fact: DataFrame,
    features: Sequence[DataFrame],
    keys: Sequence[str],
    hot: DataFrame | None | str = "auto",
    min_rows: int = MIN_HOT_ROWS,
    unique: Sequence[int] = (),
) -> DataFrame:
    """``fact`` left joined with each feature table on ``keys``; duplicates fan out.

    ``hot`` is the answer of ``hot_keys`` for ``[fact, *features]``, None to take the
    plain joins, or "auto" to count first; ``unique`` names sides that need no count
    (0 is the fact table). NULL keys match nothing, but may be hot in the fact table and
    are spread like any other key.
    """
    keys = list(keys)
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    features = [f.where(known) for f in features]
    sides = [fact, *features]
    if isinstance(hot, str):
        hot = hot_keys(sides, keys, min_rows, unique=unique)
    elif hot is not None:
        hot = _slices_that_exist(hot, features, keys)
    if hot is None:
        return reduce(lambda left, right: left.join(right, keys, "left"), features, fact)

    n = len(sides)
    axes = [_slice_name(i) for i in range(n)]
    counts = [_count_name(i) for i in range(n)]
    out = _with_slices(fact, 0, n, keys, hot)
    for i, feature in enumerate(features, start=1):
        sliced = _with_slices(feature, i, n, keys, hot).drop(*counts).withColumn(f"_hit{i}", F.lit(True))
        out = out.join(sliced, [*keys, *axes], "left")
    # A key that is hot in a feature table is present there: its copies of a fact row
    # that met an empty slice are not results.
    for i in range(1, n):
        one_slice = F.coalesce(_count_name(i), F.lit(1)) == 1
        out = out.where(one_slice | F.col(f"_hit{i}").isNotNull())
    return out.drop(*axes, *counts, *[f"_hit{i}" for i in range(1, n)])
