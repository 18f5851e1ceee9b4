"""Exact duplicates by skew-safe combining.

Copies are combined in three stages, each an aggregate whose key is the whole content beside
its digest, so that a digest shared by different contents never merges them:

1. in every task, before anything is sent (the partial side of the first aggregate);
2. per salt: what the tasks have left of a digest is dealt over ``SALTS`` groups by the
   number of the task, so a text that every task holds meets in several places;
3. globally: at most ``SALTS`` winners per content.

The state of a group is two numbers, whatever its size. Members learn the group they are in by
a join on the digest, in which groups with a large share of the rows are spread.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.shared import fresh
from riskloom.operators.durable import durable
from riskloom.operators.joins import hot_keys_from_counts, spread_left_join

BLANKS = r"[\x20\x09-\x0D]+"  # fixed value: what equal texts may differ in
SALTS = 16
MIN_HOT_ROWS = 4096  # rows of one group that may meet in one task, however small the table
WIDE = "decimal(38,0)"
ID_SPAN = Decimal(2**63)  # ids lie below it


def _normal(text: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), BLANKS, "")


def sha256_of(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def _rank(text: str, doc_id: str) -> Column:
    """One number by which a longer text is greater, then a smaller id; NULL ids come last.

    Numbers of a fixed width keep the aggregates hash-based, which sort no texts.
    """
    place = F.coalesce(F.lit(ID_SPAN).cast(WIDE) - F.col(doc_id).cast(WIDE), F.lit(0).cast(WIDE))
    size = F.length(F.coalesce(F.col(text), F.lit(""))).cast("decimal(10,0)")
    return (size * F.lit(2 * ID_SPAN + 1).cast("decimal(20,0)") + place).cast(WIDE)


def _id_of(rank: Column, id_type: str) -> Column:
    place = rank % F.lit(2 * ID_SPAN + 1).cast(WIDE)
    return F.when(place > 0, (F.lit(ID_SPAN).cast(WIDE) - place).cast(id_type))


def combined(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """(digest, content, best, n) from rows of (digest, content, rank), by way of salts."""
    salted = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    winners = salted.groupBy("salt", "digest", "content").agg(F.max("rank").alias("best"), F.count("*").alias("n"))
    together = winners.repartition("digest")  # also serves what is asked of a digest as a whole
    return together.groupBy("digest", "content").agg(F.max("best").alias("best"), F.sum("n").alias("n"))


def copy_groups(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """(digest, content_no, content, best, n) of every different content.

    ``best`` is the rank of the row that stays. ``content_no`` numbers the contents of one
    digest from 0; ``content`` is given only where a digest has several.
    """
    merged = combined(rows, salts)
    by_digest = merged.groupBy("digest").agg(
        F.max("best").alias("best"), F.sum("n").alias("n"), F.count("*").alias("contents")
    )
    by_digest = durable(by_digest, "digests")
    columns = ["digest", "content_no", "content", "best", "n"]
    alone = by_digest.where("contents = 1").withColumns({"content_no": F.lit(0), "content": F.lit(None).cast("string")})
    shared = by_digest.where("contents > 1").select("digest")
    if shared.isEmpty():
        return alone.select(*columns)
    place = F.row_number().over(Window.partitionBy("digest").orderBy("content")) - 1
    apart = combined(rows.join(shared, "digest", "left_semi"), salts).withColumn("content_no", place)
    return alone.select(*columns).unionAll(durable(apart.select(*columns), "shared-digests"))


def _with_groups(
    df: DataFrame, doc_id: str, text: str, salts: int, digest, min_hot_rows: int
) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with the group of each row, and the names of the added columns."""
    names = {c: fresh(f"_{c}", df) for c in ("digest", "content_no", "content", "best", "n", "rank", "sha")}
    content = _normal(text)
    keyed = df.select(digest(content).alias("digest"), content.alias("content"), _rank(text, doc_id).alias("rank"))
    groups = copy_groups(keyed, salts).withColumnsRenamed(names)
    key, number, known, best, n = (names[c] for c in ("digest", "content_no", "content", "best", "n"))
    # All that needs the text is computed before the join, which then moves it only if it is asked for.
    rows = df.withColumns({key: digest(content), names["rank"]: _rank(text, doc_id)})
    rows = rows.withColumn(names["sha"], F.col(key) if digest is sha256_of else sha256_of(content))
    several = groups.where(F.col(known).isNotNull())
    if several.isEmpty():
        rows = rows.withColumn(number, F.lit(0))
    else:  # contents that share a digest are told apart by the content once more
        rows = rows.withColumn(known, content).join(several.select(key, known, number), [key, known], "left").drop(known)
        rows = rows.withColumn(number, F.coalesce(number, F.lit(0)))
    hot = hot_keys_from_counts(groups.select(key, number, n), [key, number], 2, count=n, min_rows=min_hot_rows)
    return spread_left_join(rows, [groups.select(key, number, best, n)], [key, number], hot=hot), names


def exact_copies(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    salts: int = SALTS,
    digest=sha256_of,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """``df`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal if they are identical without blanks; NULL is the empty text, which is a
    text like any other. Of equal texts the longest original stays, then the smallest id; a
    NULL id is behind all others. Rows that repeat both the id and the length of the row that
    stays are all marked as kept (``drop_copies`` leaves one of them). The id is a whole
    number. Very long texts are keys like others. Other columns of ``df`` pass through unless
    they have the name of a result; no rows give no rows.
    """
    joined, names = _with_groups(df, doc_id, text, salts, digest, min_hot_rows)
    results = {
        "keep_id": _id_of(F.col(names["best"]), df.schema[doc_id].dataType.simpleString()),
        "group_size": F.col(names["n"]),
        "kept": F.col(names["rank"]) == F.col(names["best"]),
        "text_sha256": F.col(names["sha"]),
    }
    others = [F.col(f"`{c}`") for c in df.columns if c.lower() not in results]
    return joined.select(*others, *[value.alias(name) for name, value in results.items()])


def drop_copies(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", digest=sha256_of, min_hot_rows: int = MIN_HOT_ROWS
) -> DataFrame:
    """One row of each group of equal texts, with the columns of ``df``; order and ties as in
    ``exact_copies``, rows with nothing to tell them apart are interchangeable."""
    joined, names = _with_groups(df, doc_id, text, SALTS, digest, min_hot_rows)
    best = joined.where(F.col(names["rank"]) == F.col(names["best"]))
    return best.dropDuplicates([names["digest"], names["content_no"]]).select(*[F.col(f"`{c}`") for c in df.columns])
