"""Exact duplicates against plain Python, with weak digests, hot groups and odd tables."""

import hashlib
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm import dedup


def plain(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id))
    out = []
    for doc_id, text in rows:
        content = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        size, _, keep = min(groups[content], key=lambda g: (g[0], g[1], g[2] or 0))
        kept = (keep, -size) == (doc_id, len(text or ""))
        out.append((doc_id, keep, len(groups[content]), kept, hashlib.sha256(content.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df, **options):
    got = dedup.exact_copies(df, **options).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    return sorted((tuple(row) for row in got.collect()), key=repr)


ROWS = [
    (4, "one two"),
    (2, "one  two"),
    (3, "onetwo"),
    (1, " o n e\ttwo\n"),
    (9, "One two"),
    (5, None),
    (6, ""),
    (7, " \t\r\n\x0b\x0c"),
    (8, "\x1f"),
    (-3, "é è"),
    (10, "éè"),
    (11, "é è"),
    (12, "\U0001f600 \U0001f600"),
    (13, "\U0001f600\U0001f600"),
    (14, "x" * 200_000),
    (15, "x " * 200_000),
    (None, "one  two"),
    (None, "alone"),
    (2, "one  two"),  # a repeated row
    (2**63 - 1, "ends"),
    (-(2**63), "en ds"),
]


def test_against_plain(documents):
    assert found(documents(*ROWS)) == plain(ROWS)


def test_digests_that_collide(documents):
    """Contents are compared at every stage, so a weak digest changes nothing."""
    for digest in (lambda c: F.lit("same"), lambda c: F.length(c).cast("string")):
        assert found(documents(*ROWS), digest=digest) == plain(ROWS)
    kept = dedup.drop_copies(documents(*ROWS), digest=lambda c: F.lit("same"))
    assert kept.count() == len({row[4] for row in plain(ROWS)})


def test_hot_group_is_spread(spark, documents):
    rows = [(i, "copy  of all" if i % 3 else f"text {i % 50}") for i in range(3000)]
    df = documents(*rows).repartition(20)
    assert found(df, min_hot_rows=100, salts=4) == plain(rows)


def test_random_tables(documents):
    random.seed(5)
    for _ in range(3):
        rows = [(random.randrange(40), "".join(random.choice("ab \n") for _ in range(random.randrange(6)))) for _ in range(200)]
        assert found(documents(*rows)) == plain(rows)


def test_empty_table(documents):
    assert found(documents()) == []
    assert dedup.drop_copies(documents()).collect() == []


def test_clashing_and_odd_columns_pass_through(spark):
    schema = T.StructType().add("doc_id", T.IntegerType()).add("text", T.StringType()).add("_digest", T.StringType())
    schema = schema.add("best", T.MapType(T.StringType(), T.IntegerType())).add("KEPT", T.StringType()).add("a.b", T.IntegerType())
    df = spark.createDataFrame([(1, "a b", "d", {"x": 1}, "k", 1), (2, "ab", None, None, None, None)], schema)
    out = dedup.exact_copies(df)
    assert out.columns == ["doc_id", "text", "_digest", "best", "a.b", "keep_id", "group_size", "kept", "text_sha256"]
    assert {(r.doc_id, r.keep_id, r._digest, r.kept) for r in out.collect()} == {(1, 1, "d", True), (2, 1, None, False)}
    assert dict(out.dtypes)["keep_id"] == "int"
    kept = dedup.drop_copies(df)
    assert kept.columns == df.columns
    assert [(r.doc_id, r.best, r.KEPT) for r in kept.collect()] == [(1, {"x": 1}, "k")]


def test_one_row_of_repeated_rows_stays(documents):
    df = documents((1, "a"), (1, "a"), (1, "a"), (2, " a"), (None, "b"), (None, "b"))
    assert sorted((r.doc_id or 0, r.text) for r in dedup.drop_copies(df).collect()) == [(0, "b"), (2, " a")]
