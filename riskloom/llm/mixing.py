"""Mix sources to target weights along a time-varying curriculum, in DataFrame functions.

A source has a weight schedule over training time 0..1, given as knots (time, weight) with
straight lines between. Its integral is the source's weight in the mix. Targets share the
budget by weight and stop at ``most_repeats`` times the source's size; what a source
cannot take is shared by the others, again by weight.

Documents of a source stand in an order that a hash of the id fixes. The words before a
document are its cumulative demand; the source's integrated schedule, inverted at that
demand, is the document's training position. A second pass over the source follows the
first. A pass ends where the target is met, so the last document may give part of its
words.

Running totals never gather a source in one task: words are summed per (source, hash
bucket) first, a window over those few sums gives every bucket its start, and documents are
added up within their bucket. The number of buckets follows the number of rows and does
not change any result.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.shared import WORD_PATTERN
from riskloom.operators.durable import durable

Schedule = Sequence[tuple[float, float]]
ROWS_PER_BUCKET = 512
FULL_BUCKET = 16  # times the rows of a bucket that only repeated ids bring together
COPIES_PER_TASK = 10_000
MOST_DIGITS = 4  # at most 16^4 buckets per source, which one task adds up
# The first source starts strong and fades, the third gains; their integrals are 5, 2, 1.
SCHEDULES: list[Schedule] = [[(0.0, 7.5), (1.0, 2.5)], [(0.0, 2.0), (1.0, 2.0)], [(0.0, 0.5), (1.0, 1.5)]]
BUDGET = 1.5
MOST_REPEATS = 2.0


def integral(schedule: Schedule) -> float:
    return sum((w0 + w1) / 2 * (t1 - t0) for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]))


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], budget: float, most: float) -> DataFrame:
    """(source, source_size, rank, target) from (source, source_size).

    Sources rank by code point, NULL last, and take ``weights`` in turn. If the sources are
    ordered by the factor at which they reach their limit, the factor that all others get is
    the largest that any place in this order gives.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = (
        sizes.withColumn("rank", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * F.lit(float(most)))
    )
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    full = F.coalesce(F.sum("limit").over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything)
    placed = ranked.withColumn("_factor", (total * F.lit(float(budget)) - full) / open_weight)
    target = F.least("limit", F.max("_factor").over(everything) * F.col("weight"))
    return placed.withColumn("target", target).select("source", "source_size", "rank", "target")


def _position(schedule: Schedule, share: Column) -> Column:
    """Time at which ``share`` of the schedule's integral is reached."""
    area, reached, out = integral(schedule), 0.0, None
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        own = (w0 + w1) / 2 * (t1 - t0)
        rest = share * area - reached
        slope = (w1 - w0) / (t1 - t0)
        # The root of w0 x + slope x^2 / 2 = rest that stays exact for a flat line.
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + F.lit(2 * slope) * rest))
        time = F.least(F.lit(t1), F.lit(t0) + F.coalesce(F.try_divide(2 * rest, F.lit(w0) + root), F.lit(0.0)))
        out = time if out is None else F.when(share * area <= reached, out).otherwise(time)
        reached += own
    return out


def _apart(placed: DataFrame) -> DataFrame:
    """A row for each copy, each behind the copies before it; many copies are dealt over tasks."""
    blocks = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES_PER_TASK).cast("long"))
    dealt = placed.withColumn("first", F.explode(blocks)).repartition("key", "order", "size", "first")
    last = F.least(F.col("first") + COPIES_PER_TASK, F.col("copies")) - 1
    one = dealt.withColumn("copy", F.explode(F.sequence(F.col("first"), last)))
    return one.withColumn("before", F.col("before") + F.col("copy") * F.col("size"))


def mix_sources(
    docs: DataFrame,
    schedules: Sequence[Schedule] = SCHEDULES,
    budget: float = BUDGET,
    most_repeats: float = MOST_REPEATS,
    id_column: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """(id, source, size, source_size, target, taken, position, repeat_position), by position.

    One row per document. ``taken`` counts the words the mix takes, repeats included;
    positions are NULL where a pass does not reach the document. A NULL text and a text of
    white space have size 0 and are placed but give no words. A NULL source is a source.
    Rows with the same id follow each other by size; whole repeats count each, and stand for
    one row of the running totals where an id is frequent. Other columns are not looked at. No
    rows give no rows.
    """
    words = docs.select(
        F.col(id_column).alias("id"),
        F.col(source).alias("source"),
        word_count(text).alias("size"),
        F.md5(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")).alias("order"),
    )
    words = durable(words, "words")
    n = words.count()
    digits = min(MOST_DIGITS, max(1, ceil(log(max(n / ROWS_PER_BUCKET, 1), 16))))
    keyed = words.withColumns(
        {
            "key": F.coalesce(F.concat(F.lit("="), "source"), F.lit("")),
            "bucket": F.substring("order", 1, digits),
        }
    )
    buckets = keyed.groupBy("key", "bucket").agg(
        F.sum("size").alias("words"), F.first("source").alias("source"), F.count("*").alias("rows")
    )
    buckets = durable(buckets, "buckets")
    # Hashing spreads ids, not the rows of one id: only repeated ids fill a bucket that far.
    repeated = (buckets.agg(F.max("rows")).first()[0] or 0) > FULL_BUCKET * ROWS_PER_BUCKET
    if repeated:
        keyed = keyed.groupBy(*keyed.columns).agg(F.count("*").alias("copies"))
    else:
        keyed = keyed.withColumn("copies", F.lit(1).cast("long"))
    sizes = buckets.groupBy("key").agg(F.sum("words").alias("source_size"), F.first("source").alias("source"))
    weights = [integral(s) for s in schedules]
    targets = durable(source_targets(sizes.drop("key"), weights, budget, most_repeats), "targets")
    targets = targets.withColumn("key", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))).drop("source")
    earlier = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.select("key", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start"))
    starts = starts.join(targets, "key")

    inside = Window.partitionBy("key", "bucket").orderBy("order", "id", "size")
    sizes_before = inside.rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("size") * F.col("copies")).over(sizes_before), F.lit(0))
    placed = keyed.withColumn("before", before).join(starts, ["key", "bucket"])
    if repeated:
        placed = _apart(placed)
    offset = F.col("start") + F.col("before")
    demand = F.round("target").cast("long")

    def given(begin: Column) -> Column:
        return F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), demand - begin))

    def place(begin: Column) -> Column:
        kinds = F.col("rank") % len(schedules)
        share = F.try_divide(begin.cast("double"), F.col("target"))
        chosen = None
        for i, schedule in enumerate(schedules):
            time = _position(schedule, share)
            chosen = F.when(kinds == i, time) if chosen is None else chosen.when(kinds == i, time)
        return F.when(begin < demand, chosen)

    again = F.col("source_size") + offset
    out = placed.select(
        F.col("id").alias(id_column),
        F.col("source").alias(source),
        "size",
        "source_size",
        "target",
        (given(offset) + given(again)).alias("taken"),
        place(offset).alias("position"),
        place(again).alias("repeat_position"),
        F.col("order").alias("_order"),
    )
    return out.orderBy(F.col("position").asc_nulls_last(), "_order", id_column, "size").drop("_order")
