"""Tables of the pipeline: quirks that must hold, and properties across months."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskloom import (
    attributes_gold,
    attributes_silver,
    backfill,
    clickstream_gold,
    clickstream_silver,
    combined_features,
    financials_gold,
    financials_silver,
    label_store,
    loan_silver,
)
from riskloom import schemas as S
from riskloom.plans import backfill as steps
from riskloom.plans.backfill import read_features
from riskloom.session import COMPILED_BYTES, METHOD_LIMIT, SPLIT_BYTES, SPLIT_LIMIT
from riskloom.sources.lake import read_layer, write_layer
from riskloom.sources.raw import read_raw, read_source

JAN, FEB, MAR, JUL = (dt.date(2023, m, 1) for m in (1, 2, 3, 7))


def bag(df):
    return Counter(tuple(tuple(v) if isinstance(v, list) else v for v in row) for row in df.collect())


def loan(spark, **values):
    base = {
        "loan_id": "L", "Customer_ID": "C", "loan_start_date": JAN, "tenure": 10, "installment_num": 6,
        "loan_amt": 1000.0, "due_amt": 100.0, "paid_amt": 0.0, "overdue_amt": 0.0, "balance": 1000.0,
        "snapshot_date": JUL,
    }
    return spark.createDataFrame([tuple({**base, **values}.values())], S.struct(S.LOAN_RAW))


@pytest.mark.parametrize(
    "values,missed,dpd,label",
    [
        ({"overdue_amt": 100.0}, 1, 30, 1),
        ({"overdue_amt": 100.0, "snapshot_date": MAR}, 1, 28, 0),
        ({"overdue_amt": 100.0, "due_amt": 0.0}, 0, None, 0),
        ({"overdue_amt": 100.0, "due_amt": None}, 0, None, 0),
        ({"overdue_amt": None}, 0, 0, 0),
        ({}, 0, 0, 0),
    ],
)
def test_days_past_due_and_label(spark, values, missed, dpd, label):
    silver = loan_silver(loan(spark, **values))
    row = silver.first()
    assert (row.installments_missed, row.dpd) == (missed, dpd)
    assert label_store(silver).first().label == label


def test_loan_numbers_are_filled_everywhere(spark):
    silver = loan_silver(loan(spark, tenure=None, installment_num=None, overdue_amt=None, balance=None, loan_id=None))
    row = silver.first()
    assert (row.tenure, row.installment_num, row.mob, row.overdue_amt, row.balance, row.loan_id) == (0, 0, 0, 0.0, 0.0, None)
    assert silver.schema.names == list(S.LOAN_SILVER) and [f.dataType for f in silver.schema] == list(S.LOAN_SILVER.values())


def test_label_parameters(spark):
    row = label_store(loan_silver(loan(spark, installment_num=3, overdue_amt=300.0)), dpd=60, mob=3).first()
    assert (row.label, row.label_def) == (1, "60dpd_3mob")
    assert label_store(loan_silver(loan(spark, installment_num=3))).count() == 0


def fin(spark, *rows):
    names = list(S.FINANCIALS_RAW)
    data = [tuple(row.get(n) for n in names) for row in rows]
    return spark.createDataFrame(data, S.struct(S.FINANCIALS_RAW))


def test_financial_schema_is_fixed_for_clean_and_dirty_text(spark):
    clean = financials_silver(fin(spark, {"Customer_ID": "c", "snapshot_date": JAN, "Num_Bank_Accounts": "3"}))
    dirty = financials_silver(fin(spark, {"Customer_ID": "c", "snapshot_date": JAN, "Num_Bank_Accounts": "3_"}))
    assert clean.schema == dirty.schema
    assert [(f.name, f.dataType) for f in clean.schema] == list(S.FINANCIALS_SILVER.items())
    assert clean.first() == dirty.first()
    assert [f.name for f in financials_gold(clean, []).schema] == list(S.FINANCIALS_GOLD)


def test_financial_row(spark):
    row = financials_silver(
        fin(
            spark,
            {
                "Customer_ID": "c", "snapshot_date": JAN, "Annual_Income": "120000_", "Monthly_Inhand_Salary": "8000",
                "Num_Bank_Accounts": "-1", "Interest_Rate": "34", "Num_of_Loan": "-100", "Delay_from_due_date": "200",
                "Num_Credit_Inquiries": "25.0", "Credit_Mix": "_", "Credit_Utilization_Ratio": "101.5",
                "Total_EMI_per_month": "-3", "Amount_invested_monthly": "__10000__", "Type_of_Loan": "A, B, and C",
                "Monthly_Balance": "-2.5", "Outstanding_Debt": "60000",
            },
        )
    ).first()
    assert (row.Num_Bank_Accounts, row.Interest_Rate, row.Num_of_Loan, row.Delay_from_due_date) == (0, None, 20, 180)
    assert (row.Num_Credit_Inquiries, row.Credit_Mix, row.Credit_Utilization_Ratio) == (20.0, "Unknown", 100.0)
    assert (row.Total_EMI_per_month, row.Extra_Income_Ratio, row.Income_Source_Category) == (0.0, 0.2, "Mixed Income")
    assert (row.Loan_Type_Count, row.Monthly_Income_Expense_Ratio, row.Monthly_Balance) == (4, 1.25, -2.5)


def test_silver_evaluates_each_pattern_once(spark):
    plan = financials_silver(fin(spark, {}))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(") <= 2 * 16  # nullif names its argument twice
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


@pytest.fixture(scope="module")
def sources(spark):
    fins = []
    for i in range(60):
        fins.append(
            {
                "Customer_ID": f"c{i % 20}", "snapshot_date": JAN if i % 3 else FEB, "Annual_Income": f"{1000 * i}",
                "Monthly_Inhand_Salary": f"{50 * i}", "Credit_Mix": ["Good", "Bad", "_", None][i % 4],
                "Type_of_Loan": ["Auto Loan", "Auto Loan and Pay Loan", None][i % 3 if i % 7 else 0],
                "Payment_of_Min_Amount": ["Yes", "No"][i % 2], "Credit_History_Age": f"{i} Years and 2 Months",
                "Payment_Behaviour": "!@9#%8", "Outstanding_Debt": "5",
            }
        )
    attrs = [(f"c{i}", f"n{i}", "x" if i == 0 else f"{20 + i}", None, "Writer" if i % 2 else "Pilot", m) for i in range(8) for m in (JAN, FEB)]
    clicks = [(f"c{i}", JAN, float(i), None) for i in range(10)] + [("c3", JAN, 99.0, 1.0)]
    return (
        fin(spark, *fins),
        spark.createDataFrame(clicks, "Customer_ID string, snapshot_date date, fe_1 double, fe_2 double"),
        spark.createDataFrame(attrs, S.struct(S.ATTRIBUTES_RAW)),
    )


def combine(fins, clicks, attrs, loan_types=("Auto Loan",)):
    return combined_features(
        financials_gold(financials_silver(fins), list(loan_types)),
        clickstream_gold(clickstream_silver(clicks)),
        attributes_gold(attributes_silver(attrs)),
    )


def test_combined_columns(sources):
    names = combine(*sources).columns
    assert names[:2] == S.KEYS
    kept = ["Type_of_Loan", "Credit_Mix", "Credit_History_Age", "Income_Source_Category"]
    indexes = ["Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour", "Income_Source_Category", "Age_Group", "Occupation"]
    dropped = ["Payment_of_Min_Amount", "Payment_Behaviour", "Payment_of_Min_Amount_Category", "Age_Group", "Occupation"]
    assert set(kept) <= set(names) and not set(dropped) & set(names)
    assert [n for n in names if n.endswith("_index")] == [f"{c}_index" for c in indexes]
    assert not {"Name", "SSN", "Type_of_Loan_index", "Credit_History_Age_index"} & set(names)


def test_combined_missing_customer(sources):
    """No attributes: zeros and the index behind all labels; unknown age: the oldest band."""
    rows = combine(*sources).where(F.col("snapshot_date") == F.lit(JAN)).collect()
    missing = next(r for r in rows if r.Customer_ID == "c19")
    unknown_age = next(r for r in rows if r.Customer_ID == "c0")
    assert (missing.Age, missing.Occupation_Risk_Score, missing.fe_1) == (0, 0, 0.0)
    groups = {r.Age_Group_index for r in rows}
    assert missing.Age_Group_index == max(groups) == len(groups) - 1
    assert (unknown_age.Age, unknown_age.Occupation_Risk_Score) == (0, 2)
    assert unknown_age.Age_Group_index < missing.Age_Group_index
    assert missing.Payment_Behaviour_index is None  # no label in the whole month


def test_combined_rows_fan_out_with_clickstream(sources):
    fins, clicks, _ = sources
    matches = clicks.groupBy(*S.KEYS).count()
    expected = fins.select(*S.KEYS).join(matches, S.KEYS, "left").agg(F.sum(F.coalesce("count", F.lit(1)))).first()[0]
    assert combine(*sources).count() == expected


def test_one_pass_equals_single_months(sources):
    whole = combine(*sources)
    parts = [combine(*[s.where(F.col("snapshot_date") == F.lit(m)) for s in sources]) for m in (JAN, FEB)]
    assert parts[0].schema == parts[1].schema == whole.schema
    assert bag(whole) == bag(parts[0].unionByName(parts[1]))


# --- lake and backfill ---------------------------------------------------------------------------------


def test_write_replaces_its_months_only(spark, tmp_path):
    df = spark.createDataFrame([(i, JAN if i < 5 else FEB) for i in range(8)], "id int, snapshot_date date")
    base = str(tmp_path)
    assert write_layer(df, base, "silver", "t", [JAN, FEB], rebalance=True) == {JAN: 5, FEB: 3}
    again = df.where("id = 6")
    assert write_layer(again, base, "silver", "t", [FEB]) == {FEB: 1}
    assert bag(read_layer(spark, base, "silver", "t").groupBy("snapshot_date").count()) == Counter([(JAN, 5), (FEB, 1)])


def test_month_that_lost_its_rows_is_emptied(spark, tmp_path):
    df = spark.createDataFrame([(1, JAN), (2, FEB)], "id int, snapshot_date date")
    write_layer(df, str(tmp_path), "silver", "t", [JAN, FEB])
    assert write_layer(df.where("id = 1"), str(tmp_path), "silver", "t", [JAN, FEB]) == {JAN: 1, FEB: 0}
    assert bag(read_layer(spark, str(tmp_path), "silver", "t").select("id")) == Counter([(1,)])


def test_reads_have_the_columns_of_all_their_months(spark, tmp_path):
    base = str(tmp_path)
    write_layer(spark.createDataFrame([(1, 5, JAN)], "id int, fe_1 int, snapshot_date date"), base, "gold", "t", [JAN])
    wider = spark.createDataFrame([(2, 2.5, "x", FEB)], "id int, fe_1 double, FE_2 string, snapshot_date date")
    write_layer(wider, base, "gold", "t", [FEB])
    both = read_layer(spark, base, "gold", "t")
    assert both.dtypes == [("id", "int"), ("fe_1", "double"), ("FE_2", "string"), ("snapshot_date", "date")]
    assert bag(both.select("id", "fe_1", "fe_2")) == Counter([(1, 5.0, None), (2, 2.5, "x")])
    assert read_layer(spark, base, "gold", "t", [JAN]).dtypes == [("id", "int"), ("fe_1", "int"), ("snapshot_date", "date")]
    # A month that is written again has its new columns alone.
    write_layer(wider.drop("FE_2"), base, "gold", "t", [FEB])
    assert "FE_2" not in read_layer(spark, base, "gold", "t").columns
    text = spark.createDataFrame([(3, "no number", MAR)], "id int, fe_1 string, snapshot_date date")
    with pytest.raises(ValueError, match="fe_1"):
        write_layer(text, base, "gold", "t", [MAR])
    assert read_layer(spark, base, "gold", "t").count() == 2


def test_tables_without_a_record_of_columns(spark, tmp_path):
    """Months that another program wrote: their footers are merged."""
    spark.createDataFrame([(1, JAN)], "a int, snapshot_date date").write.partitionBy("snapshot_date").parquet(f"{tmp_path}/gold/t")
    more = spark.createDataFrame([(2, FEB)], "b int, snapshot_date date")
    more.write.mode("append").partitionBy("snapshot_date").parquet(f"{tmp_path}/gold/t")
    assert bag(read_layer(spark, str(tmp_path), "gold", "t").select("a", "b")) == Counter([(1, None), (None, 2)])


def test_read_prunes_months(spark, tmp_path):
    df = spark.createDataFrame([(1, JAN), (2, FEB)], "id int, snapshot_date date")
    write_layer(df, str(tmp_path), "silver", "t")
    plan = read_layer(spark, str(tmp_path), "silver", "t", [JAN])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_raw_scan_by_name(spark, tmp_path):
    path = tmp_path / "clicks.csv"
    path.write_text("fe_2,Customer_ID,junk,fe_1,snapshot_date\n1.5,a,x,,2023-01-01\nbad,b,x,2,oops\n")
    df = read_source(spark, str(path), "clickstream")
    assert df.dtypes == [("Customer_ID", "string"), ("snapshot_date", "date"), ("fe_2", "double"), ("fe_1", "double")]
    assert bag(df) == Counter([("a", JAN, 1.5, None), ("b", None, None, 2.0)])
    with pytest.raises(ValueError, match="loan_id"):
        read_raw(spark, str(path), S.LOAN_RAW)


def test_files_of_a_directory_may_differ(spark, tmp_path):
    (tmp_path / "a b.csv").write_text("Customer_ID,snapshot_date,fe_1\na,2023-01-01,1\n")
    (tmp_path / "b.csv").write_text("fe_2,fe_1,snapshot_date,Customer_ID\n5,6,2023-02-01,b\n")
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_text("fe_1,Customer_ID\n7,c\n")
    df = read_source(spark, str(tmp_path), "clickstream").select("Customer_ID", "snapshot_date", "fe_1", "fe_2")
    assert bag(df) == Counter([("a", JAN, 1.0, None), ("b", FEB, 6.0, 5.0), ("c", None, 7.0, None)])
    (tmp_path / "e.csv").write_text("fe_1,snapshot_date\n1,2023-01-01\n")
    with pytest.raises(ValueError, match="Customer_ID"):
        read_source(spark, str(tmp_path), "clickstream")


def test_any_number_of_loan_types(spark, sources, tmp_path):
    """Thousands of types in a month are a longer vocabulary, not more columns."""
    fins, clicks, attrs = sources
    many = spark.range(5000).select(F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"), F.col("id")).select(
        F.concat(F.lit("m"), F.col("id")).alias("Customer_ID"), F.lit(JAN).alias("snapshot_date"),
        F.concat(F.lit("Type "), F.col("id"), F.lit(" Loan")).alias("Type_of_Loan"),
    )
    raw = write_csvs(spark, (fins.unionByName(many, allowMissingColumns=True), clicks, attrs), f"{tmp_path}/raw")
    base = f"{tmp_path}/lake"
    backfill(spark, raw, base, JAN, JAN, threshold=2)
    assert steps.read_loan_types(spark, base).count() >= 5000
    listed = read_features(spark, base).where("Customer_ID = 'm77'").select("Loan_Types").collect()
    assert [r.Loan_Types for r in listed] == [["Loan_Type_77_Loan"]] * 2


def test_a_fixed_list_replaces_the_months_vocabulary(spark, sources, tmp_path):
    raw = write_csvs(spark, sources, f"{tmp_path}/raw")
    base = f"{tmp_path}/lake"
    backfill(spark, raw, base, JAN, FEB, threshold=5)
    backfill(spark, raw, base, JAN, FEB, loan_types=["Pay Loan", "pay loan"])
    names = [c for c in read_features(spark, base, wide=True).columns if c.startswith("Loan_")]
    assert sorted(names) == ["Loan_Type_Count", "Loan_pay_loan"]


def write_csvs(spark, sources, base, undated_clicks=False):
    fins, clicks, attrs = sources
    ledger = loan(spark, overdue_amt=100.0, snapshot_date=JAN).unionByName(loan(spark, snapshot_date=MAR))
    frames = {"loans": ledger, "clickstream": clicks.drop("snapshot_date") if undated_clicks else clicks,
              "attributes": attrs, "financials": fins}
    for name, df in frames.items():
        df.write.csv(f"{base}/{name}", header=True)
    return {name: f"{base}/{name}" for name in frames}


def test_backfill(spark, sources, tmp_path):
    raw = write_csvs(spark, sources, f"{tmp_path}/raw")
    base = f"{tmp_path}/lake"
    audit = {tuple(r)[:3]: r.n for r in backfill(spark, raw, base, "2023-01-10", "2023-03-05", threshold=5).collect()}
    assert len(audit) == 19 * 3
    assert audit["audit", "attributes_repeated_keys", JAN] == 0
    assert audit["audit", "duplicate_customers", JAN] == audit["audit", "duplicate_ssn", JAN] == 0
    assert audit["bronze", "loans", JAN] == 1 and audit["gold", "label_store", FEB] == 0
    assert audit["silver", "financials", JAN] == 40 and audit["gold", "combined", FEB] == 20
    combined = read_layer(spark, base, "gold", "combined")
    assert combined.count() == audit["gold", "combined", JAN] + 20
    first = bag(combined)

    # Repeating one month changes nothing; the tables of the other months stay.
    lake = steps.Lake(spark, base, [FEB])
    steps.build_bronze(lake, raw)
    steps.build_silver(lake)
    steps.build_gold(lake, threshold=5)
    assert bag(read_layer(spark, base, "gold", "combined").select(*combined.columns)) == first


def test_columns_of_later_loan_types(spark, sources, tmp_path):
    """A type first frequent in a later month is 0 in the features of earlier months."""
    fins, clicks, attrs = sources
    later = F.when(F.col("snapshot_date") == F.lit(FEB), F.lit("New Loan")).otherwise(F.col("Type_of_Loan"))
    raw = write_csvs(spark, (fins.withColumn("Type_of_Loan", later), clicks, attrs), f"{tmp_path}/raw")
    base = f"{tmp_path}/lake"
    for month in ("2023-01-01", "2023-02-01"):
        backfill(spark, raw, base, month, month, threshold=5)
    features = read_features(spark, base, wide=True).groupBy("snapshot_date").agg(
        F.sum("Loan_New_Loan").alias("new"), F.sum("Loan_Auto_Loan").alias("auto"), F.count("*").alias("n")
    )
    rows = {r.snapshot_date: r for r in features.collect()}
    assert rows[JAN].new == 0 and rows[JAN].auto > 0
    assert rows[FEB].new == rows[FEB].n == 20 and rows[FEB].auto == 0
    money = read_features(spark, base, "financials", wide=True)
    assert {r[0] for r in money.where(F.col("snapshot_date") == F.lit(JAN)).select("Loan_New_Loan").collect()} == {None}


def test_source_without_snapshot_holds_for_every_month(spark, sources, tmp_path):
    raw = write_csvs(spark, sources, f"{tmp_path}/raw", undated_clicks=True)
    lake = steps.Lake(spark, f"{tmp_path}/lake", [JAN, FEB])
    steps.build_bronze(lake, raw)
    counts = {(table, day): n for layer, table, day, n in lake.audit}
    assert counts["clickstream", JAN] == counts["clickstream", FEB] == 11


def test_fixed_loan_types_and_months_without_any_row(spark, sources, tmp_path):
    raw = write_csvs(spark, sources, f"{tmp_path}/raw")
    base = f"{tmp_path}/lake"
    audit = backfill(spark, raw, base, JAN, FEB, loan_types=["Auto Loan", "Pay Loan"]).collect()
    assert {(r.table, r.n) for r in audit if r.layer == "gold" and r.snapshot_date == FEB} == {
        ("label_store", 0), ("attributes", 8), ("clickstream", 0), ("financials", 20), ("combined", 20)
    }
    features = read_features(spark, base, snapshots=[FEB], wide=True)
    assert {"Loan_Auto_Loan", "Loan_Pay_Loan", "fe_1"} <= set(features.columns) and features.count() == 20
    assert steps.Lake(spark, base, [FEB]).read("gold", "label_store").count() == 0


def test_two_runs_with_other_click_columns(spark, sources, tmp_path):
    fins, clicks, attrs = sources
    base = f"{tmp_path}/lake"
    backfill(spark, write_csvs(spark, sources, f"{tmp_path}/raw1"), base, JAN, JAN, threshold=5)
    newer = clicks.withColumn("snapshot_date", F.lit(FEB)).withColumn("fe_9", F.lit(4.0))
    backfill(spark, write_csvs(spark, (fins, newer, attrs), f"{tmp_path}/raw2"), base, FEB, FEB, threshold=5)
    for features in (read_features(spark, base), read_features(spark, base, wide=True)):
        values = features.groupBy("snapshot_date").agg(F.max("fe_9").alias("most"), F.max("fe_1").alias("one")).collect()
        assert {r.snapshot_date: r.most for r in values} == {JAN: None, FEB: 4.0} and all(r.one is not None for r in values)
    assert "fe_9" in read_layer(spark, base, "silver", "clickstream").columns
    assert "fe_9" not in read_layer(spark, base, "silver", "clickstream", [JAN]).columns


def test_resumed_backfill(spark, sources, tmp_path, monkeypatch):
    raw = write_csvs(spark, sources, f"{tmp_path}/raw")
    base = f"{tmp_path}/lake"
    whole = f"{tmp_path}/whole"
    run = lambda where=base: {tuple(r)[:3]: r.n for r in backfill(spark, raw, where, JAN, MAR, threshold=5, resume=True).collect()}

    def lost(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:  # stopped between silver and gold
        patch.setattr(steps, "build_gold", lost)
        with pytest.raises(RuntimeError, match="lost"):
            run()
    assert {layer for layer, *_ in run()} == {"gold", "audit"}
    assert run() == {}

    fins, clicks, attrs = sources  # one row of one month arrives
    fins.where(F.col("snapshot_date") == F.lit(FEB)).limit(1).write.mode("append").csv(raw["financials"], header=True)
    again = run()
    assert {day for _, _, day in again} == {FEB} and {layer for layer, *_ in again} == {"bronze", "silver", "gold", "audit"}
    assert again["gold", "financials", FEB] == 21

    with monkeypatch.context() as patch:  # stopped in the middle of silver
        patch.setattr(steps, "financials_silver", lost)
        fins.where(F.col("snapshot_date") == F.lit(JAN)).limit(2).write.mode("append").csv(raw["financials"], header=True)
        with pytest.raises(RuntimeError, match="lost"):
            run()
    assert {(layer, day) for layer, _, day in run() if layer != "audit"} == {("silver", JAN), ("gold", JAN)}
    backfill(spark, raw, whole, JAN, MAR, threshold=5)
    for table in ("combined", "financials", "label_store"):
        fresh = read_layer(spark, whole, "gold", table)
        assert bag(read_layer(spark, base, "gold", table).select(*fresh.columns)) == bag(fresh)
    # Other settings concern gold alone.
    changed = backfill(spark, raw, base, JAN, MAR, threshold=6, resume=True).collect()
    assert {r.layer for r in changed} == {"gold", "audit"} and {r.snapshot_date for r in changed} == {JAN, FEB, MAR}


def test_jobs_of_a_backfill_run_compiled_methods(spark, sources, tmp_path, monkeypatch):
    """Also in a session that has Spark's own limit, which it has again afterwards."""
    limits, build, before = [], steps.build_silver, spark.conf.get(METHOD_LIMIT)
    monkeypatch.setattr(steps, "build_silver", lambda lake: (limits.append(spark.conf.get(METHOD_LIMIT)), build(lake)))
    spark.conf.set(METHOD_LIMIT, "65535")
    try:
        backfill(spark, write_csvs(spark, sources, f"{tmp_path}/raw"), f"{tmp_path}/lake", JAN, JAN)
        assert (limits, spark.conf.get(METHOD_LIMIT)) == ([str(COMPILED_BYTES)], "65535")
    finally:
        spark.conf.set(METHOD_LIMIT, before)


def test_scans_of_a_backfill_have_short_splits(spark, sources, tmp_path, monkeypatch):
    limits, build, before = [], steps.build_silver, spark.conf.get(SPLIT_LIMIT)
    monkeypatch.setattr(steps, "build_silver", lambda lake: (limits.append(spark.conf.get(SPLIT_LIMIT)), build(lake)))
    raw = write_csvs(spark, sources, f"{tmp_path}/raw")
    try:
        for own in ("128m", "1m"):
            spark.conf.set(SPLIT_LIMIT, own)
            backfill(spark, raw, f"{tmp_path}/lake", JAN, JAN)
            assert spark.conf.get(SPLIT_LIMIT) == own
        assert limits == [str(SPLIT_BYTES), str(1 << 20)]
    finally:
        spark.conf.set(SPLIT_LIMIT, before)


def test_fingerprints_see_rows_and_values(spark):
    schema = "a string, b string, snapshot_date date"
    prints = lambda *rows: steps.month_fingerprints({"t": spark.createDataFrame(list(rows), schema)}, [JAN])[JAN]
    base = prints(("x", None, JAN), ("y", "z", JAN))
    assert base == prints(("y", "z", JAN), ("x", None, JAN))
    wider = spark.createDataFrame([("x", None, JAN, None), ("y", "z", JAN, None)], f"{schema}, c string")
    assert base == steps.month_fingerprints({"t": wider}, [JAN])[JAN]
    others = [prints((None, "x", JAN), ("y", "z", JAN)), prints(("x", None, JAN)), prints(("x", None, JAN), ("x", None, JAN), ("y", "z", JAN))]
    assert len({base, *others}) == 4


def test_fingerprints_are_exact_sums_of_longs(spark):
    """The sums of the row hashes, beyond the range of a long and negative, without decimals."""
    frame = spark.range(3000).select(F.col("id").cast("string").alias("a"), F.lit(JAN).alias("snapshot_date"))
    cells = [F.lit("a"), F.col("a"), F.lit("snapshot_date"), F.col("snapshot_date")]
    hashed = [(r.h, frame.where(F.col("a") == r.a)) for r in frame.select("a", F.xxhash64(*cells).alias("h")).limit(40).collect()]
    for rows in (frame, next(one for h, one in hashed if h < 0), next(one for h, one in hashed if h > 0)):
        total = sum(r.h for r in rows.select(F.xxhash64(*cells).alias("h")).collect())
        assert steps.month_fingerprints({"t": rows}, [JAN])[JAN] == f"{steps.RULES} t:{rows.count()}:{total}"
    for _ in range(3):  # hashes of one sign leave the range of a long
        frame = frame.unionAll(frame)
    signed = frame.where(F.xxhash64(*cells) > 0)
    total = sum(r.h * r.n for r in signed.groupBy(F.xxhash64(*cells).alias("h")).agg(F.count("*").alias("n")).collect())
    assert total > 2**63 and steps.month_fingerprints({"t": signed}, [JAN])[JAN].endswith(f":{total}")
    assert not [f for f in steps.hash_sums({"t": signed}).schema if f.dataType.typeName() == "decimal"]


def test_label_counts_of_the_joins(spark, sources):
    """Counted on the narrow tables: what the joined rows have, repeated keys and gaps included."""
    from riskloom.operators.indexing import label_counts, rank_labels
    from riskloom.plans import combined as steps_of

    fins, clicks, attrs = sources
    gold = financials_gold(financials_silver(fins), [])
    gold = gold.withColumn("Customer_ID", F.when(F.col("Num_of_Loan") != 3, F.col("Customer_ID")))
    attributes = attributes_gold(attributes_silver(attrs))
    twice = clickstream_gold(clickstream_silver(clicks)).withColumn("kind", F.concat(F.lit("k"), F.col("Customer_ID")))
    twice = twice.unionAll(twice).unionAll(twice.limit(3))
    for side in (twice, twice.dropDuplicates(["Customer_ID", "snapshot_date"])):
        features = {"clickstream": side, "attributes": attributes}
        joined = steps_of.joined_features(gold, side, attributes)
        columns = ["Credit_Mix", "Payment_Behaviour", "Age_Group", "Occupation", "kind"]
        counts = steps_of.joined_label_counts(gold, features, columns, steps_of.find_repeated(features))
        known = lambda df: bag(df.where("value IS NOT NULL").select("column_name", "snapshot_date", "value", "n"))
        plain = label_counts(joined, columns)
        assert known(counts) == known(plain)
        ranks = [bag(rank_labels(c).join(plain.select("column_name", "snapshot_date", "value"), ["column_name", "snapshot_date", "value"])) for c in (counts, plain)]
        assert ranks[0] == ranks[1]
        report = []
        steps_of.combined_features(gold, side, attributes, fan_out=report)
        n = side.groupBy("Customer_ID", "snapshot_date").count().where("count > 1")
        assert sum(r[2] for r in report if r[1] == "clickstream") == n.count()
        assert sum(r[3] for r in report) == gold.join(n, ["Customer_ID", "snapshot_date"]).count()


def test_month_groups_make_tasks_for_all_cores():
    from riskloom.sources.buckets import FEW_ROWS, JOINED_ROWS, MONTH_GROUPS, month_groups

    months = [dt.date(2020 + i // 12, i % 12 + 1, 1) for i in range(90)]
    for rows in ([1_000_000] * 90, [i * 40_000 for i in range(90)], [0] * 45 + [2_000_000] + [0] * 44):
        groups = month_groups(dict(zip(months, rows)), 8, 12)
        assert [day for group in groups for day in group] == months  # each once
        if max(rows) < sum(rows):
            largest = max(sum(rows[months.index(day)] for day in group) for group in groups)
            assert 8 * len(groups) >= 24 and largest <= max(8 * JOINED_ROWS, sum(rows) / MONTH_GROUPS) + 2 * max(rows)
    assert month_groups(dict.fromkeys(months, FEW_ROWS // 90), 8, 12) == [months]
    assert month_groups(dict.fromkeys(months, 0), 8, 12) == [months]
    assert month_groups({JAN: 10**9}, 8, 12) == [[JAN]]


def test_a_bucketed_backfill_joins_month_groups(spark, sources, tmp_path, monkeypatch):
    """The same tables and audit with a join for each month."""
    from riskloom.plans.combined import joined_features
    from riskloom.sources import buckets

    raw = write_csvs(spark, sources, f"{tmp_path}/raw")
    wanted = backfill(spark, raw, f"{tmp_path}/plain", JAN, MAR, threshold=5)
    seen = []
    monkeypatch.setattr(steps, "month_groups", lambda rows, *_: seen.append(rows) or [[day] for day in rows])
    audit = backfill(spark, raw, f"{tmp_path}/lake", JAN, MAR, threshold=5, buckets=4)
    assert bag(audit) == bag(wanted)
    assert list(seen[0]) == [JAN, FEB, MAR] and sum(seen[0].values()) == 60
    plain, grouped = (read_layer(spark, f"{tmp_path}/{name}", "gold", "combined") for name in ("plain", "lake"))
    assert bag(grouped.select(*plain.columns)) == bag(plain)
    # The join has as many tasks as the groups have buckets.
    lake, groups = steps.Lake(spark, f"{tmp_path}/lake", [JAN, FEB], 4), [[JAN], [FEB]]
    tables = [lake.read("gold", t) for t in ("financials", "clickstream", "attributes")]
    monkeypatch.setattr(buckets, "BROADCAST_BYTES", -64)  # sorted and merged, also this small
    with buckets.joins_use_buckets(spark):
        joined, grouped = (joined_features(*tables, hot=None, groups=g) for g in ([], groups))
        assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString()
        assert (joined.rdd.getNumPartitions(), grouped.rdd.getNumPartitions()) == (4, 8)
        hot = spark.createDataFrame([("c1", JAN, 3, 1, 1)], "Customer_ID string, snapshot_date date, _rows0 int, _rows1 int, _rows2 int")
        assert bag(grouped) == bag(joined) == bag(joined_features(*tables, hot=hot, groups=groups))


def test_bucketed_gold_is_joined_without_a_shuffle(spark, sources, tmp_path):
    from riskloom.plans import combined as steps_of
    from riskloom.sources.buckets import joins_use_buckets, read_bucketed

    raw = write_csvs(spark, sources, f"{tmp_path}/raw")
    plain, base = f"{tmp_path}/plain", f"{tmp_path}/lake"
    wanted = backfill(spark, raw, plain, JAN, MAR, threshold=5)
    assert bag(backfill(spark, raw, base, JAN, MAR, threshold=5, buckets=4)) == bag(wanted)
    for table in ("financials", "clickstream", "attributes", "combined"):
        rows = read_layer(spark, plain, "gold", table)
        assert bag(read_layer(spark, base, "gold", table).select(*rows.columns)) == bag(rows)
    lake = steps.Lake(spark, base, [JAN, FEB], 4)
    tables = [lake.read("gold", t) for t in ("financials", "clickstream", "attributes")]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with joins_use_buckets(spark):
            joined = steps_of.joined_features(*tables, hot=None)
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") >= 3
            assert joined.count() == read_layer(spark, plain, "gold", "combined", [JAN, FEB]).count()
            hot = spark.createDataFrame([("c1", JAN, 3, 1, 1)], "Customer_ID string, snapshot_date date, _rows0 int, _rows1 int, _rows2 int")
            sliced = steps_of.joined_features(*tables, hot=hot)
            assert bag(sliced) == bag(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # A month is replaced, or emptied; another number of buckets is refused.
    fins, clicks, attrs = sources
    fewer = (fins.where(F.col("snapshot_date") == F.lit(JAN)), clicks, attrs)
    backfill(spark, write_csvs(spark, fewer, f"{tmp_path}/raw2"), base, FEB, FEB, threshold=5, buckets=4)
    assert {r[0] for r in read_bucketed(spark, base, "gold", "financials", [JAN, FEB]).select("snapshot_date").distinct().collect()} == {JAN}
    with pytest.raises(ValueError, match="buckets"):
        backfill(spark, raw, base, JAN, JAN, buckets=8)
    with pytest.raises(ValueError, match="buckets"):
        backfill(spark, raw, base, JAN, JAN)
