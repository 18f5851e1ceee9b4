"""One query per operator, run over the whole demo tables.

Results use types every engine agrees on: 32-bit floats are widened, dates are ISO text.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import attributes as attr_rules
from riskloom.functions import cleaning as clean
from riskloom.functions import financials as fin_rules
from riskloom.functions import loans as loan_rules
from riskloom.operators import dedup, indexing, joins, projection, snapshots, vocabulary
from riskloom.operators.durable import scratch_path
from riskloom.plans import combined as combine
from riskloom.plans.attributes import attributes_gold, attributes_silver
from riskloom.plans.backfill import backfill, read_features
from riskloom.plans.clickstream import clickstream_gold, clickstream_silver
from riskloom.plans.financials import bound_financials, financials_gold, financials_silver, parse_financials
from riskloom.plans.index_model import IndexModel
from riskloom.plans.loans import label_store, loan_silver
from riskloom.schemas import ATTRIBUTES_RAW, FINANCIALS_RAW, KEYS, LOAN_TYPES, LOAN_TYPES_PRESENT, SNAPSHOT
from riskloom.sources import demo_views as views
from riskloom.sources.lake import read_layer, write_bronze, write_layer
from riskloom.sources.raw import read_raw, read_source

# Vocabulary of the demo data, for the queries that fix it.
LOAN_TYPE_LIST = [
    "Auto Loan",
    "Credit-Builder Loan",
    "Mortgage Loan",
    "Not Specified",
    "Payday Loan",
    "Student Loan",
]
INDEXED = [
    "Credit_Mix",
    "Payment_of_Min_Amount",
    "Payment_Behaviour",
    "Income_Source_Category",
    "Type_of_Loan",
    "Credit_History_Age",
    "Payment_of_Min_Amount_Category",
]
VOCABULARY_THRESHOLD = 30
RUN_DATE = "1998-01-01"
LATE_MONTH = "1998-03-01"  # whose clicks arrive twice
SECOND_RUN = "1998-06-01"  # from here on a second run has other click columns
FITTED_UNTIL = "1996-06-01"
RUN_DAY = dt.date(1998, 1, 1)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function name; the suffix only keeps it apart from the plan it runs."""
    REGISTRY[fn.__name__.removesuffix("_table")] = fn
    return fn


def flat(df: DataFrame) -> DataFrame:
    """Floats as doubles, dates as ISO text."""
    target = {T.FloatType(): "double", T.DateType(): "string"}
    return df.select(
        *[F.col(f.name).cast(target[f.dataType]).alias(f.name) if f.dataType in target else f.name for f in df.schema]
    )


def with_keys(df: DataFrame, keys: list[str], **columns: Column) -> DataFrame:
    return flat(df.select(*keys, *[c.alias(name) for name, c in columns.items()]))


# --- inputs: the layers in memory --------------------------------------------------------


def _fin_silver(spark, sf):
    return financials_silver(views.financials(spark, sf))


def _loan_types(spark, sf, threshold=vocabulary.THRESHOLD):
    return vocabulary.store_vocabulary(vocabulary.loan_type_columns(views.financials(spark, sf), threshold))


def _attr_gold(spark, sf):
    return attributes_gold(attributes_silver(views.attributes_with_copies(spark, sf)))


def _click_gold(spark, sf):
    return clickstream_gold(clickstream_silver(views.clickstream(spark, sf)))


def _fin_fixed(spark, sf):
    """Gold financials without the vocabulary pass."""
    return financials_gold(_fin_silver(spark, sf), loan_types=LOAN_TYPE_LIST)


# --- snapshots, scans and sinks -------------------------------------------------------------


@query
def snapshot_slice(spark, sf):
    return flat(snapshots.slice_snapshot(views.loans(spark, sf), "1998-03-01").select("loan_id", *KEYS))


@query
def snapshot_slice_optional(spark, sf):
    undated = views.attributes(spark, sf).select("Customer_ID", "Name").distinct()
    months = [f"1998-{m:02d}-01" for m in (1, 2, 3)]
    return flat(snapshots.slice_snapshot(undated, months, required=False))


@query
def snapshot_calendar(spark, sf):
    """Every month the ledger spans with its number of loans, empty months included."""
    ledger = views.loans(spark, sf)
    counts = snapshots.audit_counts(ledger, "loans").select(SNAPSHOT, "n")
    months = snapshots.calendar_of(ledger)
    return flat(months.join(counts, SNAPSHOT, "left").fillna(0, subset=["n"]))


@query
def snapshot_calendar_range(spark, sf):
    """Loans of the months between two days inside months."""
    months = snapshots.snapshot_calendar(spark, "1995-03-17", "1997-02-11")
    counts = snapshots.audit_counts(views.loans(spark, sf), "loans").select(SNAPSHOT, "n")
    return flat(months.join(counts, SNAPSHOT, "left").fillna(0, subset=["n"]))


@query
def snapshot_row_counts(spark, sf):
    tables = {
        "loans": views.loans,
        "financials": views.financials,
        "attributes": views.attributes,
        "clickstream": views.clickstream,
    }
    audits = [snapshots.audit_counts(view(spark, sf), name) for name, view in tables.items()]
    out = audits[0]
    for audit in audits[1:]:
        out = out.unionByName(audit)
    return flat(out)


@query
def raw_roundtrip(spark, sf):
    path = scratch_path(spark, "raw-financials")
    views.financials(spark, sf).write.csv(path, header=True)
    return flat(read_raw(spark, path, FINANCIALS_RAW))


@query
def raw_mixed_headers(spark, sf):
    """One directory of files whose columns differ in order and number."""
    path = scratch_path(spark, "raw-clicks")
    clicks = views.clickstream(spark, sf)
    new = F.col(SNAPSHOT) >= F.lit("1998-02-01").cast("date")
    clicks.where(~new).select("fe_3", "snapshot_date", "fe_1", "Customer_ID").write.csv(path, header=True)
    clicks.where(new).withColumn("other", F.lit("x")).write.mode("append").csv(path, header=True)
    return flat(read_source(spark, path, "clickstream"))


@query
def raw_many_files(spark, sf):
    """The ledger in some hundred files, half of them with the columns in another order."""
    path = scratch_path(spark, "raw-loans")
    loans = views.loans(spark, sf)
    even = F.pmod(F.xxhash64("loan_id"), F.lit(2)) == 0
    loans.where(even).repartition(150).write.csv(path, header=True)
    loans.where(~even).select(*reversed(loans.columns)).repartition(150).write.mode("append").csv(path, header=True)
    return flat(read_source(spark, path, "loans"))


@query
def bronze_roundtrip(spark, sf):
    base = scratch_path(spark, "bronze")
    write_bronze(views.loans(spark, sf), base, "loans")
    return flat(read_layer(spark, base, "bronze", "loans"))


@query
def idempotent_backfill(spark, sf):
    """Months written twice hold their rows once; the other months are untouched."""
    base = scratch_path(spark, "silver")
    silver = loan_silver(views.loans(spark, sf))
    write_layer(silver, base, "silver", "loans", rebalance=True)
    again = [f"1998-{m:02d}-01" for m in range(1, 13)]
    write_layer(snapshots.slice_snapshot(silver, again), base, "silver", "loans", again, rebalance=True)
    return flat(snapshots.audit_counts(read_layer(spark, base, "silver", "loans"), "loans"))


def write_raw_files(spark: SparkSession, sf: str, without_clicks: tuple[str, ...] = ()) -> dict[str, str]:
    """The four views as CSV directories, written side by side."""
    base = scratch_path(spark, "raw")
    sources = {
        "loans": views.loans(spark, sf),
        "clickstream": views.clickstream(spark, sf).drop(*without_clicks),
        "attributes": views.attributes_with_copies(spark, sf),
        "financials": views.financials(spark, sf),
    }
    submit = inheritable_thread_target(spark)(_write_raw)
    with ThreadPoolExecutor(max_workers=len(sources)) as pool:
        jobs = {name: pool.submit(submit, df, f"{base}/{name}") for name, df in sources.items()}
    return {name: job.result() for name, job in jobs.items()}


def _write_raw(df: DataFrame, path: str) -> str:
    writer = df.write.option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def _span(spark: SparkSession, sf: str) -> tuple[dt.date, dt.date]:
    """First and last month that any of the views has."""
    months = [view(spark, sf).select(SNAPSHOT) for view in (views.loans, views.financials)]
    return tuple(months[0].unionAll(months[1]).agg(F.min(SNAPSHOT), F.max(SNAPSHOT)).first())


def _backfilled(spark: SparkSession, sf: str, **options) -> tuple[str, DataFrame]:
    """Base path and audit of a backfill of all months."""
    base = scratch_path(spark, "lake")
    return base, backfill(spark, write_raw_files(spark, sf), base, *_span(spark, sf), **options)


@query
def monthly_backfill_counts(spark, sf):
    """CSV to gold for every month of the ledger; rows written per layer, table and month."""
    return flat(_backfilled(spark, sf)[1].where("layer <> 'audit'"))


@query
def backfill_duplicates(spark, sf):
    """Customers and SSNs that occur more than once, per month of a backfill."""
    audit = _backfilled(spark, sf)[1].where("layer = 'audit' AND table LIKE 'duplicate%'")
    return flat(audit.select("table", SNAPSHOT, "n"))


@query
def backfill_resumed(spark, sf):
    """Clicks of one month arrive a second time after a backfill: a run that resumes makes that
    month anew and no other. Its audit tells the rows, and what the repeated keys multiply."""
    base, raw = scratch_path(spark, "lake"), write_raw_files(spark, sf)
    backfill(spark, raw, base, *_span(spark, sf))
    late = snapshots.slice_snapshot(views.clickstream(spark, sf), LATE_MONTH)
    late.write.mode("append").csv(raw["clickstream"], header=True)
    return flat(backfill(spark, raw, base, *_span(spark, sf), resume=True))


# --- loans ---------------------------------------------------------------------------------------


@query
def loan_enforce_schema(spark, sf):
    return flat(projection.enforce_schema(views.loans(spark, sf), LOAN_TYPES))


@query
def attributes_enforce_schema(spark, sf):
    partial = views.attributes(spark, sf).drop("Occupation")
    return flat(projection.enforce_schema(partial, ATTRIBUTES_RAW, strict=False))


@query
def loan_installments_missed(spark, sf):
    typed = projection.enforce_schema(views.loans(spark, sf), LOAN_TYPES)
    return with_keys(
        typed,
        ["loan_id"],
        installments_missed=loan_rules.installments_missed(),
        installments_missed_exact=loan_rules.installments_missed(exact=True),
    )


@query
def loan_first_missed_date(spark, sf):
    silver = loan_silver(views.loans(spark, sf))
    return with_keys(
        silver, ["loan_id", SNAPSHOT, "installments_missed"], first_missed_date=loan_rules.first_missed_date()
    )


@query
def loan_dpd(spark, sf):
    silver = loan_silver(views.loans(spark, sf))
    return with_keys(silver, ["loan_id", SNAPSHOT], dpd=loan_rules.days_past_due())


@query
def loan_silver_table(spark, sf):
    return flat(loan_silver(views.loans(spark, sf)))



@query
def label_store_table(spark, sf):
    return flat(label_store(loan_silver(views.loans(spark, sf))))



@query
def label_summary(spark, sf):
    """Loans reaching 30 days past due at month six, per month: the flagship query."""
    labels = label_store(loan_silver(views.loans(spark, sf)))
    return flat(
        labels.groupBy(SNAPSHOT, "label_def").agg(
            F.count("*").alias("loans"), F.sum("label").alias("defaults")
        )
    )


# --- attributes -----------------------------------------------------------------------------------


@query
def attributes_dedup(spark, sf):
    return flat(dedup.latest_per_customer(views.attributes_with_copies(spark, sf)))


@query
def attributes_dedup_counts(spark, sf):
    """The same rows and how many each stands for, by one aggregate."""
    return flat(dedup.latest_with_counts(views.attributes_with_copies(spark, sf)))


@query
def attributes_latest_counts(spark, sf):
    return flat(dedup.latest_with_counts(views.attributes_with_copies(spark, sf), scope="all"))


@query
def attributes_latest(spark, sf):
    return flat(dedup.latest_per_customer(views.attributes_with_copies(spark, sf), scope="all"))


@query
def duplicate_customers(spark, sf):
    return flat(dedup.duplicate_summary(views.attributes_with_copies(spark, sf), "Customer_ID", "Customer_ID"))


@query
def duplicate_ssn(spark, sf):
    unique = dedup.latest_per_customer(views.attributes_with_copies(spark, sf))
    valid = unique.withColumn("SSN", attr_rules.clean_ssn("SSN")).where(F.col("SSN").isNotNull())
    return flat(dedup.duplicate_groups(valid, "SSN", "SSN"))


ATTR_KEYS = ["Customer_ID", SNAPSHOT]


@query
def attributes_age(spark, sf):
    return with_keys(views.attributes(spark, sf), ATTR_KEYS, Age=attr_rules.clean_age("Age"))


@query
def attributes_ssn(spark, sf):
    return with_keys(views.attributes(spark, sf), ATTR_KEYS, SSN=attr_rules.clean_ssn("SSN"))


@query
def ssn_special_chars(spark, sf):
    return with_keys(views.attributes(spark, sf), ATTR_KEYS, special=attr_rules.has_special_chars("SSN").cast("int"))


@query
def attributes_occupation(spark, sf):
    return with_keys(
        views.attributes(spark, sf), ATTR_KEYS, Occupation=attr_rules.clean_occupation("Occupation")
    )


@query
def attributes_age_group(spark, sf):
    return with_keys(
        attributes_silver(views.attributes(spark, sf)), ATTR_KEYS, Age_Group=attr_rules.age_group("Age")
    )


@query
def attributes_occupation_risk(spark, sf):
    return with_keys(
        attributes_silver(views.attributes(spark, sf)),
        ATTR_KEYS,
        Occupation_Risk_Score=attr_rules.occupation_risk("Occupation"),
    )


@query
def attributes_silver_table(spark, sf):
    """Undated rows belong to the run month, behind the dated rows of the same customer."""
    raw = views.attributes_with_copies(spark, sf)
    undated = F.when(~F.col("Name").endswith(" Jr"), F.col(SNAPSHOT))
    first_month = F.col(SNAPSHOT) == F.lit(RUN_DATE).cast("date")
    raw = raw.withColumn(SNAPSHOT, F.when(first_month, undated).otherwise(F.col(SNAPSHOT)))
    return flat(attributes_silver(raw, run_date=RUN_DATE))



@query
def attributes_gold_table(spark, sf):
    return flat(_attr_gold(spark, sf))



# --- financials -------------------------------------------------------------------------------------


@query
def financials_parse_decimal(spark, sf):
    names = ["Annual_Income", "Monthly_Inhand_Salary", "Outstanding_Debt", "Amount_invested_monthly"]
    return with_keys(views.financials(spark, sf), KEYS, **{n: clean.parse_decimal(n) for n in names})


@query
def financials_parse_signed(spark, sf):
    names = ["Changed_Credit_Limit", "Monthly_Balance"]
    return with_keys(views.financials(spark, sf), KEYS, **{n: clean.parse_decimal(n, signed=True) for n in names})


@query
def financials_clamp(spark, sf):
    return with_keys(
        views.financials(spark, sf),
        KEYS,
        Num_Bank_Accounts=clean.clamp("Num_Bank_Accounts", 0, 10),
        Num_Credit_Card=clean.clamp("Num_Credit_Card", 0, 15),
        Num_Credit_Inquiries=clean.clamp("Num_Credit_Inquiries", 0, 20),
    )


@query
def financials_interest_rate(spark, sf):
    rate = clean.null_outside("Interest_Rate", 2, 30)
    return with_keys(views.financials(spark, sf), KEYS, Interest_Rate=rate)


@query
def financials_parse_count(spark, sf):
    return with_keys(
        views.financials(spark, sf),
        KEYS,
        Num_of_Loan=clean.parse_count("Num_of_Loan", 20),
        Num_of_Delayed_Payment=clean.parse_count("Num_of_Delayed_Payment", 50),
    )


@query
def financials_delay_cap(spark, sf):
    delay = clean.cap("Delay_from_due_date", 180)
    return with_keys(views.financials(spark, sf), KEYS, Delay_from_due_date=delay)


def _bounded(spark, sf):
    return bound_financials(parse_financials(views.financials(spark, sf)))


@query
def financials_credit_mix(spark, sf):
    return with_keys(views.financials(spark, sf), KEYS, Credit_Mix=clean.replace_value("Credit_Mix", "_", "Unknown"))


@query
def financials_utilization(spark, sf):
    return flat(_bounded(spark, sf).select(*KEYS, "Credit_Utilization_Ratio"))


@query
def financials_credit_history(spark, sf):
    text = "Credit_History_Age"
    return with_keys(
        views.financials(spark, sf),
        KEYS,
        Credit_History_Years=fin_rules.history_years(text),
        Credit_History_Months=fin_rules.history_months(text),
        Credit_History_Age_Years=fin_rules.credit_history_years(text),
    )


@query
def financials_payment_min(spark, sf):
    category = fin_rules.min_payment_category("Payment_of_Min_Amount")
    return with_keys(views.financials(spark, sf), KEYS, Payment_of_Min_Amount_Category=category)


@query
def financials_emi(spark, sf):
    return with_keys(
        views.financials(spark, sf), KEYS, Total_EMI_per_month=F.round(clean.floor_at("Total_EMI_per_month", 0), 2)
    )


@query
def financials_payment_behaviour(spark, sf):
    behaviour = clean.whitelist("Payment_Behaviour", fin_rules.PAYMENT_BEHAVIOURS)
    return with_keys(views.financials(spark, sf), KEYS, Payment_Behaviour=behaviour)


@query
def financials_extra_income(spark, sf):
    ratio = fin_rules.extra_income_ratio("Annual_Income", "Monthly_Inhand_Salary")
    return with_keys(_bounded(spark, sf), KEYS, Extra_Income_Ratio=ratio)


@query
def financials_income_source(spark, sf):
    return flat(_fin_silver(spark, sf).select(*KEYS, "Extra_Income_Ratio", "Income_Source_Category"))


@query
def financials_loan_type_count(spark, sf):
    return with_keys(
        views.financials(spark, sf),
        KEYS,
        Loan_Type_Count=fin_rules.loan_type_count("Type_of_Loan"),
        Loan_Type_Count_exact=fin_rules.loan_type_count("Type_of_Loan", exact=True),
    )


@query
def financials_expense_ratio(spark, sf):
    ratio = fin_rules.expense_ratio("Total_EMI_per_month", "Amount_invested_monthly", "Monthly_Inhand_Salary")
    return with_keys(_bounded(spark, sf), KEYS, Monthly_Income_Expense_Ratio=ratio)


@query
def financials_dti(spark, sf):
    return with_keys(
        _fin_silver(spark, sf),
        KEYS,
        Debt_To_Income_Ratio=fin_rules.debt_to_income("Outstanding_Debt", "Annual_Income"),
    )


@query
def financials_behavior_score(spark, sf):
    score = fin_rules.credit_behavior_score(
        "Credit_Mix", "Payment_of_Min_Amount_Category", "Credit_Utilization_Ratio"
    )
    return with_keys(_fin_silver(spark, sf), KEYS, Credit_Behavior_Score=F.round(score, 4))


@query
def financials_silver_table(spark, sf):
    return flat(_fin_silver(spark, sf))



def _rounded_score(df: DataFrame) -> DataFrame:
    return df.withColumn("Credit_Behavior_Score", F.round("Credit_Behavior_Score", 4))


@query
def financials_gold_table(spark, sf):
    loan_types = _loan_types(spark, sf, VOCABULARY_THRESHOLD)
    return flat(_rounded_score(financials_gold(_fin_silver(spark, sf), loan_types, wide=True)))



# --- loan types ----------------------------------------------------------------------------------------


@query
def loan_type_tokens(spark, sf):
    return flat(vocabulary.loan_type_tokens(views.financials(spark, sf)))


@query
def loan_type_counts(spark, sf):
    return flat(vocabulary.loan_type_counts(views.financials(spark, sf)))


@query
def loan_type_frequent(spark, sf):
    return flat(vocabulary.frequent_loan_types(views.financials(spark, sf), VOCABULARY_THRESHOLD, ordered=True))


@query
def loan_type_vocabulary(spark, sf):
    return flat(vocabulary.loan_type_vocabulary(views.financials(spark, sf), VOCABULARY_THRESHOLD))


@query
def loan_type_columns(spark, sf):
    return flat(vocabulary.loan_type_columns(views.financials(spark, sf), VOCABULARY_THRESHOLD))


@query
def loan_one_hot(spark, sf):
    raw = views.financials(spark, sf).select(*KEYS, "Type_of_Loan")
    return flat(vocabulary.one_hot_loans(raw, LOAN_TYPE_LIST))


def _one_hot_long(spark, sf, **options):
    raw = views.financials(spark, sf)
    words = vocabulary.loan_type_vocabulary(raw, VOCABULARY_THRESHOLD)
    return flat(vocabulary.one_hot_loans_long(raw, words, KEYS, **options))


@query
def loan_one_hot_long(spark, sf):
    return _one_hot_long(spark, sf)


@query
def loan_one_hot_long_shuffled(spark, sf):
    """The same pairs by the route for many types, with a vocabulary too large to broadcast."""
    return _one_hot_long(spark, sf, few_types=0, broadcast_bytes=0)


@query
def loan_types_present(spark, sf):
    """Indicator names per row as one text, by the route for many types."""
    raw = views.financials(spark, sf).select(*KEYS, "Type_of_Loan")
    loan_types = vocabulary.loan_type_columns(raw, VOCABULARY_THRESHOLD)
    listed = vocabulary.with_loan_types(raw, loan_types, few_types=0)
    return flat(listed.select(*KEYS, F.array_join(LOAN_TYPES_PRESENT, ",").alias("present")))


# --- clickstream ------------------------------------------------------------------------------------------


@query
def clickstream_silver_table(spark, sf):
    return flat(clickstream_silver(views.clickstream(spark, sf)))



@query
def clickstream_gold_table(spark, sf):
    return flat(_click_gold(spark, sf))



# --- encoding ------------------------------------------------------------------------------------------------


@query
def string_index_credit_mix(spark, sf):
    indexed = indexing.string_index(_fin_silver(spark, sf).select(*KEYS, "Credit_Mix"), ["Credit_Mix"])
    return flat(indexed)


def _index_all(spark, sf, **options):
    indexed = indexing.string_index(_fin_silver(spark, sf).select(*KEYS, *INDEXED), INDEXED, **options)
    return flat(indexed.select(*KEYS, *[f"{c}_index" for c in INDEXED]))


@query
def string_index_all(spark, sf):
    return _index_all(spark, sf)


@query
def string_index_broadcast(spark, sf):
    """The same codes by the route for many labels per month."""
    return _index_all(spark, sf, map_labels=0)


@query
def string_index_shuffled(spark, sf):
    """The same codes by the route for label tables too large to broadcast."""
    return _index_all(spark, sf, broadcast_bytes=0)


def _index_without_month(spark, sf, **options):
    """Rows of a NULL month among the others; they are a month of their own."""
    rows = _fin_silver(spark, sf).select(*KEYS, *INDEXED)
    rows = rows.withColumn(SNAPSHOT, F.expr("case when Credit_Mix <> 'Bad' then snapshot_date end"))
    indexed = indexing.string_index(rows, INDEXED, **options)
    return flat(indexed.select(*KEYS, *[f"{c}_index" for c in INDEXED]))


@query
def string_index_null_month(spark, sf):
    return _index_without_month(spark, sf)


@query
def string_index_null_month_broadcast(spark, sf):
    return _index_without_month(spark, sf, map_labels=0)


@query
def string_index_null_month_shuffled(spark, sf):
    return _index_without_month(spark, sf, broadcast_bytes=0)


def _index_model(spark, sf) -> tuple[IndexModel, DataFrame]:
    """A model fitted on early months, stored, and grown by the counts of the next half year; rows
    of one credit mix are left out, so that applying it meets unknown labels."""
    silver = _fin_silver(spark, sf).select(*KEYS, *INDEXED)
    fitted = silver.where("Credit_Mix IS DISTINCT FROM 'Bad'")
    early = f"snapshot_date < add_months(date '{FITTED_UNTIL}', -5)"
    base = scratch_path(spark, "model")
    IndexModel.fit(fitted.where(early), INDEXED).save(base, "financials")
    late = IndexModel.fit(fitted.where(f"NOT {early} AND snapshot_date <= '{FITTED_UNTIL}'"), INDEXED)
    IndexModel.load(spark, base, "financials", INDEXED).merge(late).save(base, "grown")
    return IndexModel.load(spark, base, "grown", INDEXED), silver


@query
def string_index_model(spark, sf):
    """Codes that all months share; what the model does not know comes behind its labels."""
    model, rows = _index_model(spark, sf)
    return flat(model.transform(rows).select(*KEYS, *[f"{c}_index" for c in INDEXED]))


@query
def string_index_model_skip(spark, sf):
    """The rows whose values are all known to the model."""
    model, rows = _index_model(spark, sf)
    known = IndexModel(model.counts, ["Credit_Mix", "Payment_Behaviour"])
    return flat(known.transform(rows, "skip").select(*KEYS, "Credit_Mix_index", "Payment_Behaviour_index"))


@query
def string_index_model_labels(spark, sf):
    return flat(_index_model(spark, sf)[0].labels())


# --- combination ------------------------------------------------------------------------------------------------


JOIN_COLUMNS = [*KEYS, "Outstanding_Debt", "Loan_Type_Count"]


@query
def combined_join_clickstream(spark, sf):
    return flat(combine.join_clickstream(_fin_silver(spark, sf).select(*JOIN_COLUMNS), _click_gold(spark, sf)))


@query
def combined_join_attributes(spark, sf):
    return flat(combine.join_attributes(_fin_silver(spark, sf).select(*JOIN_COLUMNS), _attr_gold(spark, sf)))


def _forced(spark: SparkSession, keys: list[tuple]) -> DataFrame:
    """The given keys treated as hot in all three tables."""
    rows = [(*key, 4, 3, 2) for key in keys]
    return spark.createDataFrame(rows, "Customer_ID string, snapshot_date date, _rows0 int, _rows1 int, _rows2 int")


@query
def combined_join_sliced(spark, sf):
    """Financials with both feature tables, the 8 most frequent keys treated as hot everywhere."""
    fin = _fin_silver(spark, sf).select(*JOIN_COLUMNS)
    often = fin.groupBy(*KEYS).count().orderBy(F.desc("count"), *KEYS).limit(8).collect()
    hot = _forced(spark, [(row.Customer_ID, row[SNAPSHOT]) for row in often])
    return flat(joins.spread_left_join(fin, [_click_gold(spark, sf), _attr_gold(spark, sf)], KEYS, hot))


def _with_gaps(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Financials and clicks with NULL customers; every click row of a customer occurs twice."""
    fin = _fin_silver(spark, sf).select(*JOIN_COLUMNS)
    fin = fin.withColumn("Customer_ID", F.expr("case when Loan_Type_Count <> 2 then Customer_ID end"))
    clicks = _click_gold(spark, sf)
    unknown = clicks.withColumn("Customer_ID", F.lit(None).cast("string"))
    return fin, clicks.unionAll(clicks).unionAll(unknown)


@query
def combined_join_null_keys(spark, sf):
    """NULL keys match nothing and lose nothing; repeated feature rows fan out."""
    fin, clicks = _with_gaps(spark, sf)
    return flat(combine.join_clickstream(fin, clicks))


@query
def combined_join_null_keys_sliced(spark, sf):
    """The same rows with given hot keys, counted on both sides and NULL among them."""
    fin, clicks = _with_gaps(spark, sf)
    months = fin.where("Customer_ID IS NULL").select(SNAPSHOT).distinct().orderBy(SNAPSHOT).limit(100).collect()
    hot = _forced(spark, [(None, row[SNAPSHOT]) for row in months] + [("CUS_1", RUN_DAY), (None, None)])
    return flat(combine.join_clickstream(fin, clicks, hot=hot.drop("_rows2")))


@query
def join_fan_out(spark, sf):
    """Per month, the click keys with several rows and the financial rows they multiply."""
    fin, clicks = _with_gaps(spark, sf)
    return flat(joins.fan_out(fin, clicks, KEYS, SNAPSHOT))


def _joined(spark, sf):
    return combine.joined_features(_fin_fixed(spark, sf), _click_gold(spark, sf), _attr_gold(spark, sf))


@query
def categorical_non_null(spark, sf):
    joined = _joined(spark, sf)
    categorical, _ = projection.classify_columns(joined, KEYS)
    return flat(projection.non_null_counts(joined, categorical))


@query
def column_classification(spark, sf):
    joined = _joined(spark, sf)
    categorical, numeric = projection.classify_columns(joined, KEYS)
    counts = projection.non_null_counts(joined, categorical + numeric)
    kind = F.when(F.col("column_name").isin(categorical), "categorical").otherwise("numeric")
    return flat(counts.withColumn("kind", kind))


@query
def combined_features_table(spark, sf):
    gold = financials_gold(_fin_silver(spark, sf), loan_types=[])
    combined = combine.combined_features(gold, _click_gold(spark, sf), _attr_gold(spark, sf))
    return flat(_rounded_score(vocabulary.wide_loan_types(combined, _loan_types(spark, sf), fill=0)))


@query
def backfill_features(spark, sf):
    """The values of ``combined`` that a backfill writes, from CSV to gold, for all months."""
    base = _backfilled(spark, sf)[0]
    return flat(_rounded_score(read_features(spark, base, wide=True)))


@query
def backfill_two_runs(spark, sf):
    """Two runs, each with a click column that the other lacks: reads have both, NULL in the
    months without."""
    (first, last), base = _span(spark, sf), scratch_path(spark, "lake")
    change = dt.date.fromisoformat(SECOND_RUN)
    raw = write_raw_files(spark, sf, without_clicks=("fe_5",))
    backfill(spark, raw, base, first, change - dt.timedelta(days=1))
    clicks = _write_raw(views.clickstream(spark, sf).drop("fe_1"), scratch_path(spark, "raw-clicks"))
    backfill(spark, {**raw, "clickstream": clicks}, base, change, last)
    return flat(_rounded_score(read_features(spark, base, wide=True)))


@query
def backfill_bucketed(spark, sf):
    """The same features from gold tables in buckets of customers, joined where they lie."""
    base = _backfilled(spark, sf, buckets=8)[0]
    return flat(_rounded_score(read_features(spark, base, wide=True)))
