"""Loan-type tokens, their monthly vocabulary and the loan types a text contains.

The vocabulary of a month are the loan types named often enough in that month. Counting
is one partially aggregated shuffle of (month, token); text columns alone are scanned.

What a row mentions is kept as one sorted array of indicator names, for any number of
types. Wide 0/1 columns are made from it on request.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from riskloom.functions.financials import LOAN_COLUMN_PREFIX, loan_column_name, loan_tokens, loan_type_name
from riskloom.operators.durable import BROADCAST_BYTES, broadcast_size, durable, observed
from riskloom.operators.joins import hot_keys_from_counts, spread_left_join
from riskloom.schemas import LOAN_TYPES_PRESENT, SNAPSHOT

TEXT = "Type_of_Loan"
THRESHOLD = 10
FEW_TYPES = 48  # types per month that are quicker tested one by one than joined
SALTS = 16  # parts of a piece of text that a common type is joined in


def loan_type_tokens(df: DataFrame) -> DataFrame:
    """(snapshot_date, loan_token): one row per token; missing text has none."""
    return df.select(SNAPSHOT, F.explode(loan_tokens(TEXT)).alias("loan_token"))


def loan_type_counts(df: DataFrame) -> DataFrame:
    return loan_type_tokens(df).groupBy(SNAPSHOT, "loan_token").agg(F.count("*").alias("n"))


def frequent_loan_types(df: DataFrame, threshold: int = THRESHOLD, ordered: bool = False) -> DataFrame:
    """Tokens named at least ``threshold`` times in the month, counted as spelled.

    ``ordered`` sorts by month, falling count, token.
    """
    frequent = loan_type_counts(df).where(F.col("n") >= threshold)
    return frequent.orderBy(SNAPSHOT, F.desc("n"), "loan_token") if ordered else frequent


def loan_type_vocabulary(df: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(snapshot_date, loan_type): frequent tokens, trimmed after counting, blanks left out."""
    named = frequent_loan_types(df, threshold).select(SNAPSHOT, loan_type_name("loan_token").alias("loan_type"))
    return named.where(F.col("loan_type") != "").distinct()


def loan_type_columns(df: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(snapshot_date, column_name, loan_type): which type fills which indicator column.

    If several types share a column name, the one last in order of falling count (then
    ascending token) has it. Names that differ by case alone are one column.
    """
    loan_type = loan_type_name("loan_token")
    named = frequent_loan_types(df, threshold).where(loan_type != "")
    last = F.struct(-F.col("n"), F.col("loan_token"))
    return (
        named.groupBy(SNAPSHOT, F.lower(loan_column_name(loan_type)).alias("_column"))
        .agg(F.max_by(loan_type, last).alias("loan_type"))
        .select(SNAPSHOT, loan_column_name("loan_type").alias("column_name"), "loan_type")
    )


def listed_columns(loan_types: list[str]) -> dict[str, str]:
    """Indicator name -> loan type of a given list; of names equal but for case the last one stays."""
    named = {}
    for loan_type in loan_types:
        name = LOAN_COLUMN_PREFIX + loan_type.translate(str.maketrans(" -", "__"))
        named[name.lower()] = (name, loan_type)
    return dict(named.values())


def _pieces(texts: DataFrame, classes: list[int]) -> DataFrame:
    """(month, text_id, class, key, rest): the text from each of its positions.

    A type of class c has 2^c to 2^(c+1) - 1 characters; ``key`` are the first 2^c of the
    text there, ``rest`` as many as a type of the class can have.
    """
    starts = texts.select(SNAPSHOT, "_text_id", TEXT, F.explode(F.sequence(F.lit(1), F.length(TEXT))).alias("_start"))
    sized = starts.withColumn("_class", F.explode(F.array(*[F.lit(c) for c in classes])))
    width = F.expr("shiftleft(1, _class)")
    rest = F.substring(F.col(TEXT), F.col("_start"), 2 * width - 1)
    pieces = sized.select(SNAPSHOT, "_text_id", "_class", "_start", rest.alias("_rest"), width.alias("_width"))
    pieces = pieces.where(F.length("_rest") >= F.col("_width"))
    return pieces.withColumn("_key", F.substring(F.col("_rest"), F.lit(1), F.col("_width"))).drop("_width")


def _contained(texts: DataFrame, vocabulary: DataFrame, broadcast_bytes: int) -> DataFrame:
    """(month, text_id, loan_type): the types that each text contains, position by position.

    Every position of a text meets the types that start with the characters there, by an
    equality join, so the cost follows the texts and not the number of types.
    """
    size = F.length("loan_type")
    sized = vocabulary.where(size > 0).withColumn("_class", F.floor(F.log2(size.cast("double"))).cast("int"))
    key = F.substring(F.col("loan_type"), F.lit(1), F.expr("shiftleft(1, _class)"))
    types = sized.withColumn("_key", key)
    seen = types.agg(F.collect_set("_class").alias("classes"), broadcast_size("loan_type").alias("size")).first()
    pieces = _pieces(texts.where(F.length(TEXT) > 0), sorted(seen.classes) or [0])
    on = [SNAPSHOT, "_class", "_key"]
    if seen["size"] <= broadcast_bytes:
        met = pieces.join(F.broadcast(types), on)
    else:
        salted = types.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        own = F.pmod(F.xxhash64("_text_id", "_start"), F.lit(SALTS)).cast("int")
        met = pieces.withColumn("_salt", own).join(salted, [*on, "_salt"])
    return met.where(F.startswith("_rest", F.col("loan_type"))).select(SNAPSHOT, "_text_id", "loan_type").distinct()


def _spans_separator(loan_type: Column) -> Column:
    """Whether a text can contain the type without one of its tokens doing so: it holds a
    separator or is a part of one, or begins or ends like a part of one."""
    return F.contains(F.lit(" and "), loan_type) | loan_type.rlike(",| and |( | a| an| and)$|^( |d |nd |and )")


def matches(texts: DataFrame, vocabulary: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(month, text_id, loan_type): the types of its month that each distinct text contains.

    Texts are made of few different tokens. Only these are searched for types, and a text has
    the types of its tokens; types that can span a separator are looked for in whole texts.
    ``texts`` is (month, text, text_id), ``vocabulary`` (month, loan_type).
    """
    spanning = vocabulary.where(_spans_separator(F.col("loan_type")))
    inside = vocabulary.where(~_spans_separator(F.col("loan_type")))
    token = F.explode(F.array_distinct(loan_tokens(TEXT))).alias("_token")
    tokens = durable(texts.select(SNAPSHOT, "_text_id", token).where(F.length("_token") > 0), "loan-tokens")
    tokens = tokens.withColumn("_token_id", F.md5(F.col("_token").cast("binary")))
    key = [SNAPSHOT, "_token_id"]
    distinct = durable(tokens.groupBy(*key).agg(F.count("*").alias("n"), F.first("_token").alias(TEXT)), "distinct-tokens")
    searched = _contained(distinct.select(SNAPSHOT, F.col("_token_id").alias("_text_id"), TEXT), inside, broadcast_bytes)
    types = searched.groupBy(SNAPSHOT, F.col("_text_id").alias("_token_id")).agg(F.collect_set("loan_type").alias("_types"))
    hot = hot_keys_from_counts(distinct.select(*key, "n"), key, 2)
    named = spread_left_join(tokens.select(*key, "_text_id"), [types], key, hot=hot)
    found = named.select(SNAPSHOT, "_text_id", F.explode("_types").alias("loan_type")).distinct()
    if spanning.isEmpty():
        return found
    return found.unionAll(_contained(texts, spanning, broadcast_bytes))


def _text_id() -> Column:
    return F.md5(F.col(TEXT).cast("binary"))


def _by_text(df: DataFrame, vocabulary: DataFrame, broadcast_bytes: int) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Rows with their text id, matches of the distinct texts, and the hot texts."""
    rows = df.withColumn("_text_id", _text_id())
    texts = rows.where(F.col(TEXT).isNotNull()).groupBy(SNAPSHOT, "_text_id").agg(F.count("*").alias("n"), F.first(TEXT).alias(TEXT))
    texts = durable(texts, "loan-texts")
    found = durable(matches(texts, vocabulary, broadcast_bytes), "loan-matches")
    return rows, found, hot_keys_from_counts(texts.select(SNAPSHOT, "_text_id", "n"), [SNAPSHOT, "_text_id"], 2)


@dataclass(frozen=True)
class StoredVocabulary:
    """A written vocabulary with its size: types in all, and months (a NULL month not counted)."""

    frame: DataFrame
    types: int
    months: int

    def few(self, limit: int) -> bool:
        """Whether its types, ``limit`` a month on average, are tested row by row."""
        return self.types <= limit * max(self.months, 1)


def store_vocabulary(vocabulary: DataFrame | StoredVocabulary) -> StoredVocabulary:
    """Write a frame of ``loan_type_columns`` or ``loan_type_vocabulary``; the same job sizes it."""
    if isinstance(vocabulary, StoredVocabulary):
        return vocabulary
    size = Observation()
    metrics = [F.count("*").alias("types"), F.size(F.collect_set(SNAPSHOT)).alias("months")]
    frame = durable(vocabulary.observe(size, *metrics), "loan-vocabulary")
    seen = observed(size)
    return StoredVocabulary(frame, seen.get("types", 0), seen.get("months", 0))


def with_loan_types(
    df: DataFrame,
    vocabulary: DataFrame | StoredVocabulary,
    few_types: int = FEW_TYPES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``Loan_Types``: the sorted indicator names of the month's types the text contains.

    ``vocabulary`` is a frame of ``loan_type_columns``. Missing text and months without a
    vocabulary have an empty array.
    """
    stored = store_vocabulary(vocabulary)
    words = stored.frame.select(SNAPSHOT, "column_name", "loan_type")
    none = F.array().cast("array<string>")
    if stored.few(few_types):
        entry = F.struct("column_name", "loan_type")
        by_month = words.groupBy(SNAPSHOT).agg(F.array_sort(F.collect_list(entry)).alias("_entries"))
        present = F.filter("_entries", lambda e: F.contains(F.col(TEXT), e["loan_type"]))
        names = F.coalesce(F.transform(present, lambda e: e["column_name"]), none)
        joined = df.join(F.broadcast(by_month), SNAPSHOT, "left")
        return joined.withColumn(LOAN_TYPES_PRESENT, names).select(*df.columns, LOAN_TYPES_PRESENT)
    rows, found, hot = _by_text(df, words, broadcast_bytes)
    named = found.join(words, [SNAPSHOT, "loan_type"])
    lists = named.groupBy(SNAPSHOT, "_text_id").agg(F.array_sort(F.collect_set("column_name")).alias("_names"))
    joined = spread_left_join(rows, [lists], [SNAPSHOT, "_text_id"], hot=hot)
    return joined.withColumn(LOAN_TYPES_PRESENT, F.coalesce("_names", none)).select(*df.columns, LOAN_TYPES_PRESENT)


def _wide_columns(tests: list[tuple[str, list, Column]], fill: int | None) -> dict[str, Column]:
    """Indicator columns from (name, months, test); names that differ by case alone are one."""
    flags: dict[str, tuple[str, Column]] = {}
    for name, months, test in sorted(tests, key=lambda t: (t[0].lower(), t[0])):
        flag = F.when(F.col(SNAPSHOT).isin(months), test.cast("int"))
        first, earlier = flags.get(name.lower(), (name, None))
        flags[name.lower()] = (first, flag if earlier is None else F.coalesce(earlier, flag))
    return {name: flag if fill is None else F.coalesce(flag, F.lit(fill)) for name, flag in flags.values()}


def widen_loan_types(df: DataFrame, vocabulary: DataFrame | StoredVocabulary, fill: int | None = None) -> DataFrame:
    """One 0/1 column per indicator of ``vocabulary`` from ``Loan_Types``.

    A column is ``fill`` (by default NULL) in months whose vocabulary lacks the type. One
    column per type is what the caller asks for here: the names are collected.
    """
    words = vocabulary.frame if isinstance(vocabulary, StoredVocabulary) else vocabulary
    months = F.sort_array(F.collect_set(SNAPSHOT)).alias("months")
    rows = words.groupBy("column_name").agg(months).collect()
    tests = [(r.column_name, r.months, F.array_contains(LOAN_TYPES_PRESENT, r.column_name)) for r in rows]
    return df.withColumns(_wide_columns(tests, fill))


def wide_loan_types(df: DataFrame, vocabulary: DataFrame | StoredVocabulary, fill: int | None = None) -> DataFrame:
    """The columns of ``widen_loan_types`` straight from the text, for a vocabulary of
    ``loan_type_columns`` with few types: each type is tested once, no array is made."""
    words = vocabulary.frame if isinstance(vocabulary, StoredVocabulary) else vocabulary
    months = F.sort_array(F.collect_set(SNAPSHOT)).alias("months")
    rows = words.groupBy("column_name", "loan_type").agg(months).collect()
    text = F.coalesce(TEXT, F.lit(""))
    tests = [(r.column_name, r.months, F.contains(text, F.lit(r.loan_type))) for r in rows]
    return df.withColumns(_wide_columns(tests, fill))


def one_hot_loans(df: DataFrame, vocabulary: DataFrame | StoredVocabulary | list[str]) -> DataFrame:
    """One 0/1 column per loan type: 1 if the text contains the type.

    ``vocabulary`` is a list of types valid in every month, or the frame of
    ``loan_type_columns``; then a column is NULL in months that do not have the type.
    """
    if not isinstance(vocabulary, list):
        stored = store_vocabulary(vocabulary)
        if stored.few(FEW_TYPES):
            return wide_loan_types(df, stored)
        return widen_loan_types(with_loan_types(df, stored), stored).drop(LOAN_TYPES_PRESENT)
    contains = {name: F.contains(F.col(TEXT), F.lit(t)) for name, t in listed_columns(vocabulary).items()}
    return df.withColumns({name: F.coalesce(flag.cast("int"), F.lit(0)) for name, flag in contains.items()})


def one_hot_loans_long(
    df: DataFrame,
    vocabulary: DataFrame,
    columns: list[str],
    few_types: int = FEW_TYPES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(``columns``, loan_type): one row per row and loan type of its month found in its text.

    A few types per month are tested row by row. More are matched on distinct texts only,
    so the cost does not grow with the types of the month.
    """
    stored = store_vocabulary(vocabulary.select(SNAPSHOT, "loan_type").distinct())
    if stored.few(few_types):
        by_month = stored.frame.groupBy(SNAPSHOT).agg(F.collect_set("loan_type").alias("_types"))
        found = F.filter("_types", lambda loan_type: F.contains(F.col(TEXT), loan_type))
        return df.join(F.broadcast(by_month), SNAPSHOT).select(*columns, F.explode(found).alias("loan_type"))
    rows, found, hot = _by_text(df, stored.frame, broadcast_bytes)
    joined = spread_left_join(rows, [found], [SNAPSHOT, "_text_id"], hot=hot)
    return joined.where(F.col("loan_type").isNotNull()).select(*columns, "loan_type")
