"""DataFrame operators on small frames, checked against plain Python."""

import datetime as dt
import gzip
from collections import Counter
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from riskloom.operators import dedup, indexing, joins, projection, snapshots, vocabulary
from riskloom.schemas import KEYS

JAN, FEB, MAR = (dt.date(2023, m, 1) for m in (1, 2, 3))


def bag(df):
    return Counter(map(tuple, df.collect()))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- snapshots -----------------------------------------------------------------------------


@pytest.mark.parametrize(
    "start,end,months",
    [
        ("2023-01-15", "2023-03-01", [JAN, FEB, MAR]),
        ("2023-01-15", "2023-02-28", [JAN, FEB]),
        ("2023-02-01", "2023-01-31", []),
        ("2022-12-31", "2023-01-01", [dt.date(2022, 12, 1), JAN]),
    ],
)
def test_calendar(spark, start, end, months):
    assert [r[0] for r in snapshots.snapshot_calendar(spark, start, end).collect()] == months


def test_slice(spark):
    df = spark.createDataFrame([(1, JAN), (2, FEB), (3, None)], "id int, snapshot_date date")
    assert [r.id for r in snapshots.slice_snapshot(df, JAN).collect()] == [1]
    assert [r.id for r in snapshots.slice_snapshot(df, ["2023-01-01", FEB]).orderBy("id").collect()] == [1, 2]
    assert snapshots.slice_snapshot(df, []).count() == 0


def test_slice_without_column(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    with pytest.raises(ValueError):
        snapshots.slice_snapshot(df, JAN)
    assert bag(snapshots.slice_snapshot(df, [JAN, FEB], required=False)) == Counter(
        [(1, JAN), (2, JAN), (1, FEB), (2, FEB)]
    )


# --- projection --------------------------------------------------------------------------------


def test_enforce_schema(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    from pyspark.sql import types as T

    types = {"a": T.IntegerType(), "c": T.DateType()}
    with pytest.raises(ValueError):
        projection.enforce_schema(df, types)
    out = projection.enforce_schema(df, types, strict=False)
    assert out.dtypes == [("a", "int"), ("b", "string")]


def test_fill_and_classify(spark):
    df = spark.createDataFrame([("c", JAN, None, None, None)], "Customer_ID string, snapshot_date date, t string, n int, d date")
    row = projection.fill_numeric(df).first()
    assert (row.t, row.n, row.d) == (None, 0, None)
    assert projection.classify_columns(df, KEYS) == (["t"], ["n", "d"])
    with pytest.raises(ValueError):
        projection.classify_columns(df.select(*KEYS), KEYS)
    assert projection.columns_with_prefix(df, "t") == ["t"]
    assert projection.select_except(df, ["t", "nowhere"]).columns == ["Customer_ID", "snapshot_date", "n", "d"]


def test_non_null_counts(spark):
    df = spark.createDataFrame([("a", None), ("b", None)], "x string, y string")
    assert bag(projection.non_null_counts(df, ["x", "y"])) == Counter([("x", 2), ("y", 0)])


# --- duplicates -----------------------------------------------------------------------------------

ATTR = "Customer_ID string, Name string, Age string, SSN string, Occupation string, snapshot_date date"


def test_one_row_per_customer_and_month(spark):
    rows = [
        ("a", "Z", "1", None, None, JAN),
        ("a", "B", None, None, None, JAN),
        ("a", "B", "2", None, None, JAN),
        ("a", "Q", "1", None, None, FEB),
        (None, "N1", "1", None, None, JAN),
        (None, "N2", "1", None, None, JAN),
    ]
    df = spark.createDataFrame(rows, ATTR)
    kept = bag(dedup.latest_per_customer(df).select("Customer_ID", "Name", "Age", "snapshot_date"))
    assert kept == Counter([("a", "B", "2", JAN), ("a", "Q", "1", FEB), (None, "N1", "1", JAN)])
    overall = bag(dedup.latest_per_customer(df, scope="all").select("Customer_ID", "Name"))
    assert overall == Counter([("a", "Q"), (None, "N1")])


def test_undated_rows_come_second(spark):
    df = spark.createDataFrame([("a", "A", "1", "", "", None), ("a", "B", "1", "", "", JAN), ("b", "C", "1", "", "", None)], ATTR)
    kept = bag(dedup.latest_per_customer(df, run_date=JAN).select("Customer_ID", "Name"))
    assert kept == Counter([("a", "B"), ("b", "C")])


def test_dedup_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", "A", "1", "", "", JAN)], ATTR)
    plan = plan_of(dedup.latest_per_customer(df))
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_duplicate_audits(spark):
    df = spark.createDataFrame([("a", JAN)] * 3 + [("a", FEB), (None, JAN), (None, JAN)], "Customer_ID string, snapshot_date date")
    groups = bag(dedup.duplicate_groups(df, "Customer_ID", "Customer_ID"))
    assert groups == Counter([(JAN, "a", 3), (JAN, None, 2)])
    assert bag(dedup.duplicate_summary(df, "Customer_ID", "Customer_ID")) == Counter([(JAN, 2, 3)])


# --- hot-key joins ----------------------------------------------------------------------------------


@pytest.fixture
def skewed(spark):
    """One customer has a third of the facts (many exact copies), NULL another part; the
    first feature table is hot in a second customer as well."""
    fact = [("hot", JAN, i % 3) for i in range(300)] + [(f"c{i}", JAN, i) for i in range(400)]
    fact += [(None, JAN, 1)] * 150 + [("busy", JAN, i) for i in range(4)] + [("hot", FEB, 1)]
    click = [("busy", JAN, i % 7) for i in range(200)] + [(f"c{i}", JAN, i) for i in range(0, 400, 5)]
    click += [("hot", JAN, 1), ("hot", JAN, 2), ("nobody", JAN, 1)] + [(None, JAN, 9)] * 50
    attr = [(f"c{i}", JAN, f"n{i}") for i in range(0, 400, 2)] + [("hot", JAN, "h"), ("hot", JAN, "h2")]
    make = spark.createDataFrame
    return (
        make(fact, "Customer_ID string, snapshot_date date, x int"),
        make(click, "Customer_ID string, snapshot_date date, fe int"),
        make(attr, "Customer_ID string, snapshot_date date, name string"),
    )


def test_hot_keys_are_found_exactly(spark, skewed):
    hot = joins.hot_keys(skewed, KEYS, min_rows=100, partitions=50)
    found = {row.Customer_ID: tuple(row)[2:] for row in hot.collect()}
    assert set(found) == {"hot", None, "busy"}
    assert found["hot"][0] > 1 and found["hot"][1:] == (1, 1)
    assert found["busy"][1] > 1 and found["busy"][0] == 1
    assert joins.hot_keys(skewed, KEYS) is None


def test_spread_join_equals_plain_join(skewed):
    fact, click, attr = skewed
    plain = fact.join(click, KEYS, "left").join(attr, KEYS, "left")
    hot = joins.hot_keys(skewed, KEYS, min_rows=100, partitions=50)
    spread = joins.spread_left_join(fact, [click, attr], KEYS, hot)
    assert spread.columns == plain.columns
    assert bag(spread) == bag(plain)
    assert bag(joins.spread_left_join(fact, [click, attr], KEYS)) == bag(plain)


def test_spread_join_when_a_key_is_hot_on_both_sides(spark):
    left = spark.createDataFrame([("h", JAN, i) for i in range(60)] + [("z", JAN, 0)], "Customer_ID string, snapshot_date date, x int")
    right = spark.createDataFrame([("h", JAN, i) for i in range(70)], "Customer_ID string, snapshot_date date, y int")
    hot = joins.hot_keys([left, right], KEYS, min_rows=10, partitions=20)
    out = joins.spread_left_join(left, [right], KEYS, hot)
    assert bag(out) == bag(left.join(right, KEYS, "left")) and out.count() == 60 * 70 + 1


def test_hot_rows_are_spread_even_if_identical(spark):
    fact = spark.createDataFrame([("h", JAN, 1)] * 4000, "Customer_ID string, snapshot_date date, x int").repartition(16)
    right = spark.createDataFrame([("h", JAN, 5)], "Customer_ID string, snapshot_date date, y int")
    hot = joins.hot_keys([fact, right], KEYS, min_rows=100, partitions=64)
    sliced = joins._with_slices(fact, 0, 2, KEYS, hot)
    per_slice = [r["count"] for r in sliced.groupBy("_slice0").count().collect()]
    assert max(per_slice) < 4000 / 3 and sum(per_slice) == 4000


def test_co_partitioned_joins_shuffle_the_fact_once(spark, skewed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(joins.spread_left_join(skewed[0], list(skewed[1:]), KEYS, None))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 3


# --- vocabulary ------------------------------------------------------------------------------------------


def fin_text(spark, *groups):
    rows = [("c", month, text) for month, text, n in groups for _ in range(n)]
    return spark.createDataFrame(rows, "Customer_ID string, snapshot_date date, Type_of_Loan string")


def test_vocabulary_counts_untrimmed_spellings(spark):
    df = fin_text(spark, (JAN, "Auto Loan", 6), (JAN, "X, Auto Loan", 6), (JAN, None, 20), (JAN, "", 20))
    assert bag(vocabulary.loan_type_vocabulary(df, 10)) == Counter()
    assert bag(vocabulary.loan_type_vocabulary(df, 6)) == Counter([(JAN, "Auto Loan"), (JAN, "X")])


def test_vocabulary_is_per_month(spark):
    df = fin_text(spark, (JAN, "A Loan", 10), (FEB, "A Loan", 9), (FEB, "B Loan", 12))
    assert bag(vocabulary.loan_type_vocabulary(df)) == Counter([(JAN, "A Loan"), (FEB, "B Loan")])
    hot = vocabulary.one_hot_loans(df, vocabulary.loan_type_columns(df))
    rows = set(map(tuple, hot.select("snapshot_date", "Type_of_Loan", "Loan_A_Loan", "Loan_B_Loan").collect()))
    assert rows == {(JAN, "A Loan", 1, None), (FEB, "A Loan", None, 0), (FEB, "B Loan", None, 1)}


def test_frequent_types_are_ordered(spark):
    df = fin_text(spark, (JAN, "B", 5), (JAN, "A", 5), (JAN, "C", 9))
    assert [r.loan_token for r in vocabulary.frequent_loan_types(df, 5, ordered=True).collect()] == ["C", "A", "B"]


def test_types_sharing_a_column_the_last_one_has_it(spark):
    df = fin_text(spark, (JAN, "Pay-Day", 12), (JAN, "Pay Day", 15), (JAN, "Tie-X", 11), (JAN, "Tie X", 11))
    columns = {r.column_name: r.loan_type for r in vocabulary.loan_type_columns(df).collect()}
    assert columns == {"Loan_Pay_Day": "Pay-Day", "Loan_Tie_X": "Tie-X"}


def test_one_hot_is_a_substring_test(spark):
    df = fin_text(spark, (JAN, "My Auto Loan Plus", 1), (JAN, None, 1), (JAN, "", 1))
    hot = vocabulary.one_hot_loans(df, ["Auto Loan"])
    assert {(r.Type_of_Loan, r.Loan_Auto_Loan) for r in hot.collect()} == {("My Auto Loan Plus", 1), (None, 0), ("", 0)}


LONG_ROUTES = [{}, {"few_types": 0}, {"few_types": 0, "broadcast_bytes": 0}]


@pytest.mark.parametrize("route", LONG_ROUTES)
def test_long_form_routes_agree(spark, route):
    df = fin_text(spark, (JAN, "Auto Loan and Auto", 3), (JAN, "xAutox", 2), (FEB, "Auto Loan", 2), (JAN, None, 2), (JAN, "", 1))
    words = spark.createDataFrame([(JAN, "Auto"), (JAN, "Auto Loan"), (FEB, "Loan")], "snapshot_date date, loan_type string")
    out = vocabulary.one_hot_loans_long(df, words, ["snapshot_date", "Type_of_Loan"], **route)
    assert bag(out) == Counter(
        [(JAN, "Auto Loan and Auto", "Auto")] * 3
        + [(JAN, "Auto Loan and Auto", "Auto Loan")] * 3
        + [(JAN, "xAutox", "Auto")] * 2
        + [(FEB, "Auto Loan", "Loan")] * 2
    )


@pytest.mark.parametrize("route", LONG_ROUTES)
def test_present_types_of_odd_texts(spark, route):
    """Types inside other types, at the ends of a text, of one character and of two sizes."""
    texts = ["a", "ab", "xabab", "éa", "Loan of a Loan", "x" * 5000 + "abc", "", None]
    df = fin_text(spark, *[(JAN, t, 2) for t in texts], (FEB, "ab", 1))
    types = ["a", "ab", "abab", "é", "Loan", "Loan of a Loan", "abc", "never"]
    words = spark.createDataFrame([(JAN, f"Loan_{t}", t) for t in types], "snapshot_date date, column_name string, loan_type string")
    found = vocabulary.with_loan_types(df, words, **route).collect()
    want = [(t, sorted(f"Loan_{w}" for w in types if t and w in t)) for t in texts for _ in (0, 1)] + [("ab", [])]
    assert Counter((r.Type_of_Loan, tuple(r.Loan_Types)) for r in found) == Counter((t, tuple(w)) for t, w in want)


def test_list_names_that_are_equal_but_for_case(spark):
    df = fin_text(spark, (JAN, "pay day", 1), (JAN, "Pay-Day", 1))
    hot = vocabulary.one_hot_loans(df, ["Pay-Day", "pay day"])
    assert hot.columns[-1] == "Loan_pay_day" and {(r.Type_of_Loan, r.Loan_pay_day) for r in hot.collect()} == {("pay day", 1), ("Pay-Day", 0)}


# --- index ------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("min_rows", [100, 10**6])
@pytest.mark.parametrize("hot_null", [True, False])
def test_given_hot_keys_lose_no_row(spark, min_rows, hot_null):
    """NULL keys on both sides, and given keys that a table does not have."""
    fact = spark.createDataFrame([("a", JAN, 1), ("b", JAN, 2), (None, JAN, 3), ("a", None, 4)], "Customer_ID string, snapshot_date date, x int")
    rows = [(None, JAN, i) for i in range(50)] + [("a", JAN, i) for i in range(200)] + [(None, None, 1)]
    click = spark.createDataFrame(rows, "Customer_ID string, snapshot_date date, fe int")
    plain = bag(fact.join(click, KEYS, "left"))
    counted = joins.hot_keys([fact, click], KEYS, min_rows=min_rows, partitions=50)
    assert bag(joins.spread_left_join(fact, [click], KEYS, counted)) == plain
    keys = [("b", JAN), ("a", JAN), ("nobody", JAN), ("a", FEB)] + ([(None, JAN), (None, None), ("a", None)] if hot_null else [])
    given = spark.createDataFrame([(*k, 3, 4) for k in keys], "Customer_ID string, snapshot_date date, _rows0 int, _rows1 int")
    assert bag(joins.spread_left_join(fact, [click], KEYS, given)) == plain


ROUTES = {"maps": {}, "broadcast": {"map_labels": 0}, "shuffle": {"map_labels": 0, "broadcast_bytes": 0}}


@pytest.mark.parametrize("route", ROUTES)
def test_string_index(spark, route):
    rows = [(JAN, v, None) for v in ["b", "a", "c", "c", None, ""]] + [(FEB, "a", "z"), (FEB, None, "z")]
    rows += [(None, v, None) for v in ["b", "b", None]]  # rows without a month are a month of their own
    df = spark.createDataFrame(rows, "snapshot_date date, v string, w string")
    out = indexing.string_index(df, ["v", "w"], **ROUTES[route])
    assert out.columns == ["snapshot_date", "v", "w", "v_index", "w_index"]
    assert dict(out.dtypes)["v_index"] == "int"
    assert bag(out.drop("w")) == Counter(
        [(JAN, "b", 3, None), (JAN, "a", 2, None), (JAN, "c", 0, None), (JAN, "c", 0, None), (JAN, None, 4, None)]
        + [(JAN, "", 1, None), (FEB, "a", 0, 0), (FEB, None, 1, 0)]
        + [(None, "b", 0, None), (None, "b", 0, None), (None, None, 1, None)]
    )


def test_index_routes_agree_on_many_labels(spark):
    values = F.concat(F.lit("v"), F.pmod(F.xxhash64("id"), F.lit(701)))
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 17 == 0, None).otherwise(values).alias("v"),
        F.when(F.col("id") % 2 == 0, F.lit(JAN)).otherwise(F.lit(FEB)).alias("snapshot_date"),
    )
    results = [bag(indexing.string_index(df, ["v"], **{"map_labels": 10**6, **o})) for o in ROUTES.values()]
    results.append(bag(indexing.string_index(df, ["v"], map_labels=0)))
    assert results[0] == results[1] == results[2] == results[3]


def test_index_equals_string_indexer(spark):
    from pyspark.ml.feature import StringIndexer

    df = spark.range(500).select(F.concat(F.lit("k"), (F.col("id") * F.col("id")) % 23).alias("v"), F.lit(JAN).alias("snapshot_date"))
    fitted = StringIndexer(inputCol="v", outputCol="expected", handleInvalid="keep").fit(df).transform(df)
    out = indexing.string_index(fitted, ["v"])
    assert out.where(F.col("v_index") != F.col("expected").cast("int")).count() == 0


def test_hot_values_of_the_shuffled_index_are_spread(spark):
    counts = spark.createDataFrame([(JAN, False, "x", 900), (JAN, False, "y", 5)], "d date, a boolean, t string, n long")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        hot = joins.hot_keys_from_counts(counts, ["d", "a", "t"], 2, min_rows=100).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert [(r.t, r["_rows0"], r["_rows1"]) for r in hot] == [("x", 50, 1)]
    assert joins.hot_keys_from_counts(counts, ["d", "a", "t"], 2) is None


def test_string_index_of_an_empty_frame(spark):
    df = spark.createDataFrame([], "snapshot_date date, v string")
    assert indexing.string_index(df, ["v"]).columns == ["snapshot_date", "v", "v_index"]
    assert indexing.string_index(df, ["v"]).count() == 0


def test_long_labels_are_not_broadcast(spark):
    """The bound is on bytes: few labels of great length take the shuffled route."""
    df = spark.createDataFrame([(JAN, "x" * 3000), (JAN, "y" * 3000), (JAN, None)], "snapshot_date date, v string")
    out = indexing.string_index(df, ["v"], broadcast_bytes=4000)
    assert "_codes0" not in plan_of(out)
    assert sorted(r.v_index for r in out.collect()) == [0, 1, 2]


def test_broadcast_tables_share_one_budget(spark):
    """Each column is small; together they exceed the budget, so some are joined by shuffles."""
    columns = [f"v{i}" for i in range(6)]
    df = spark.range(300).select(F.lit(JAN).alias("snapshot_date"), *[F.concat(F.lit(c), F.col("id") % 40).alias(c) for c in columns])
    one = 40 * (64 + 5)
    routes = [indexing.string_index(df, columns, map_labels=0, broadcast_bytes=b) for b in (one * 12, one * 3)]
    assert [plan_of(df).count("_combination") > 0 for df in routes] == [False, True]
    assert bag(routes[0]) == bag(routes[1])


def test_scratch_goes_with_its_scope(spark):
    from riskloom.operators import durable as kept

    with kept.scratch_scope(spark):
        path = kept.scratch_path(spark, "x")
        spark.range(3).write.parquet(path)
        assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


# --- shared index model -----------------------------------------------------------------------


@pytest.mark.parametrize("route", [{}, {"map_labels": 0}, {"broadcast_bytes": 0}])
def test_index_model_equals_the_estimator(spark, route):
    from pyspark.ml.feature import StringIndexer

    from riskloom.plans.index_model import IndexModel

    months = [dt.date(2023, m, 1) for m in (1, 2, 3)]
    rows = [(months[i % 2], f"v{i % 7 % (i % 5 + 1)}", ["a", "", None, "b"][i % 4]) for i in range(200)]
    fit = spark.createDataFrame(rows, "snapshot_date date, x string, y string")
    new = [(months[2], x, y) for x in ("v0", "v1", "v6", "unseen", None) for y in ("a", "", "b", None, "c")]
    apply = spark.createDataFrame(new, fit.schema)
    columns = ["x", "y"]
    model = IndexModel.fit(fit, columns)
    for handle in ("keep", "skip"):
        indexer = StringIndexer(inputCols=columns, outputCols=["x_index", "y_index"], handleInvalid=handle)
        want = indexer.fit(fit.dropna()).transform(apply) if handle == "skip" else indexer.fit(fit).transform(apply)
        got = model.transform(apply, handle, **route)
        if handle == "keep":
            assert Counter(map(tuple, got.collect())) == Counter((r[0], r[1], r[2], int(r[3]), int(r[4])) for r in want.collect())
        else:
            assert {(r.x, r.y) for r in got.collect()} == {(r.x, r.y) for r in want.collect()}
    with pytest.raises(Exception, match="no label of"):
        model.transform(apply, "error", **route).collect()
    seen = apply.where("x IN ('v0', 'v1') AND y IN ('a', 'b')")
    assert Counter(map(tuple, model.transform(seen, "error", **route).collect())) == Counter(
        map(tuple, model.transform(seen, "keep", **route).collect())
    )
    with pytest.raises(ValueError, match="unknown way"):
        model.transform(apply, "drop")


def test_index_model_grows_by_months(spark, tmp_path):
    from riskloom.plans.index_model import IndexModel

    jan, feb, mar = (dt.date(2023, m, 1) for m in (1, 2, 3))
    frame = lambda *rows: spark.createDataFrame(list(rows), "snapshot_date date, x string")
    first = frame((jan, "a"), (jan, "a"), (feb, "b"), (None, "c"))
    IndexModel.fit(first, ["x"]).save(str(tmp_path), "m")
    stored = IndexModel.load(spark, str(tmp_path), "m", ["x"])
    grown = stored.merge(IndexModel.fit(frame((feb, "b"), (feb, "b"), (feb, "b"), (mar, "d")), ["x"]))
    table = lambda model: {r.value: (r.n, r.code) for r in model.labels().collect()}
    assert table(stored) == {"a": (2, 0), "b": (1, 1), "c": (1, 2)}
    assert table(grown) == {"b": (3, 0), "a": (2, 1), "c": (1, 2), "d": (1, 3)}
    assert table(grown.merge(IndexModel.fit(frame(), ["x"]), [feb])) == {"a": (2, 0), "c": (1, 1), "d": (1, 2)}
    grown.save(str(tmp_path), "m", [mar])
    assert table(IndexModel.load(spark, str(tmp_path), "m", ["x"], [jan, mar])) == {"a": (2, 0), "d": (1, 1)}
    empty = IndexModel.fit(frame(), ["x"]).transform(first)
    assert {r.x_index for r in empty.collect()} == {0}


# --- raw headers --------------------------------------------------------------------------------


HEADERS = ["a,b,c", '"a","b, x",c', "a,,c", "a,A,b", "\ufeffa,b", 'a,"q\\"z",c', " a ,b ", "a,b,a,", "\u00e9,\u00fc", "a"]


def test_headers_are_named_as_the_reader_names_them(spark, tmp_path):
    from riskloom.sources import raw

    for i, header in enumerate(HEADERS):
        (tmp_path / f"f {i}%x.csv").write_text("\n\n" + header + "\n1,2,3,4\n", encoding="utf-8")
    with gzip.open(tmp_path / "z.csv.gz", "wt") as file:
        file.write("a,packed\n1,2\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "blank.csv").write_text("\n \n\n")
    (tmp_path / "unended.csv").write_text("a,unended")
    (tmp_path / "long.csv").write_text(",".join(f"column_{i}" for i in range(20_000)) + "\n1\n")
    files = [unquote(file) for file in spark.read.text(str(tmp_path)).inputFiles()]
    want = {file.split("/")[-1]: tuple(spark.read.option("header", True).csv(file).columns) for file in files}
    want = {file: columns for file, columns in want.items() if columns}
    groups = raw.files_by_header(spark, str(tmp_path))
    assert {file.split("/")[-1]: columns for columns, own in groups.items() for file in own} == want
    # The way for stores that only Spark opens finds the same.
    scanned = {row.file: raw.column_names(row.header) for row in raw._by_scan(spark, spark.read.text(str(tmp_path)).inputFiles())}
    assert {unquote(file).split("/")[-1]: columns for file, columns in scanned.items()} == want


def test_headers_of_many_files_are_one_job(spark, tmp_path):
    from riskloom.sources import raw

    for i in range(300):
        (tmp_path / f"{i}.csv").write_text(("a,b\n" if i % 2 else "b,a\n") + "1,2\n")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    groups = raw.files_by_header(spark, str(tmp_path))
    jobs = len(tracker.getJobIdsForGroup("headers"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {columns: len(files) for columns, files in groups.items()} == {("a", "b"): 150, ("b", "a"): 150}
    assert jobs <= 3  # listing, shuffle, headers


def test_latest_with_counts_keeps_the_same_rows(spark):
    rows = [(c, d, n, a) for c in ("x", None) for d in (dt.date(2023, 1, 1), dt.date(2023, 2, 1), None) for n in ("b", None, "a") for a in ("1", None)]
    df = spark.createDataFrame(rows, "Customer_ID string, snapshot_date date, Name string, Age string")
    for options in ({}, {"run_date": dt.date(2023, 1, 1)}, {"scope": "all"}):
        kept = dedup.latest_with_counts(df, **options)
        assert Counter(map(tuple, kept.drop("n_rows").collect())) == Counter(map(tuple, dedup.latest_per_customer(df, **options).collect()))
        assert kept.agg({"n_rows": "sum"}).first()[0] == len(rows)


@pytest.mark.parametrize("route", [{}, {"broadcast_bytes": 0}])
def test_types_within_tokens_and_across_separators(spark, route):
    """Substrings of whole texts, whatever the types look like, by the route for many types."""
    types = ["Loan", "Auto Loan", "Loan and", "an", "Loan, and Pay", "d Pay", " Loan", "o L", "and", "nd", "Brand", "a and b", ",", "Loan ", "x"]
    texts = ["Auto Loan and Payday Loan", "Auto Loan, and Payday Loan", "Brand Loan", "a and b and b", "and and Loan", "", None, "Loan", "no, and, and yes", " Loan ,x"]
    months = [JAN, FEB, None]
    words = spark.createDataFrame([(m, t) for m in months[:2] for t in types if m == JAN or len(t) > 3], "snapshot_date date, loan_type string")
    df = spark.createDataFrame([(i, m, t) for i, t in enumerate(texts) for m in months], "id int, snapshot_date date, Type_of_Loan string")
    got = bag(vocabulary.one_hot_loans_long(df, words, ["id", "snapshot_date"], few_types=0, **route))
    want = Counter((i, m, t) for i, text in enumerate(texts) for m, t in words.collect() if text and t in text)
    assert got == want
