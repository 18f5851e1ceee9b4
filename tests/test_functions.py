"""Edge values of every rule, one list per rule."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import attributes as attr
from riskloom.functions import cleaning as clean
from riskloom.functions import financials as fin
from riskloom.functions import loans

CASES = [
    ("age", "string", attr.clean_age, ["25_", "-500", "8698", " 30", "18", "80", "17", "81", "99999999999", "", None],
     [25, None, None, None, 18, 80, None, None, None, None, None]),
    ("ssn", "string", attr.clean_ssn, ["821-00-0265", "#F%$D@*&8", "12345678", "821000265", "1-2345-6789", None],
     ["821000265", None, None, "821000265", "123456789", None]),
    ("special", "string", attr.has_special_chars, ["821-00-0265", "#F%$D@*&8", "a", None], [False, True, False, False]),
    ("occupation", "string", attr.clean_occupation,
     ["_______", "  ___ ", " Lawyer ", "  ", None, "___", " _______ ", "\tDoctor", ""],
     [None, "___", "Lawyer", None, None, None, None, "\tDoctor", None]),
    ("age_group", "int", attr.age_group, [24, 25, 34, 35, 49, 50, 64, 65, None],
     ["Young", "Young_Adult", "Young_Adult", "Middle_Aged", "Middle_Aged", "Senior", "Senior", "Elderly", "Elderly"]),
    ("risk", "string", attr.occupation_risk, ["Writer", "Manager", "Doctor", "Pilot", "writer", None], [3, 2, 1, 2, 2, 2]),
    ("decimal", "string", clean.parse_decimal,
     ["19114.12_", "-5", "_", "24198062.0", None, "__10000__", "7.", "x12.345y6", ""],
     [19114.12, 5.0, None, 24198062.0, None, 10000.0, 7.0, 12.35, None]),
    ("signed", "string", lambda c: clean.parse_decimal(c, signed=True),
     ["-4.5", "_", "__-333333333333333333333333333__", "+2", None],
     [-4.5, None, pytest.approx(-3.333333333333333e26), 2.0, None]),
    ("clamp", "int", lambda c: clean.clamp(c, 0, 10), [-1, 0, 5, 1798, None], [0, 0, 5, 10, None]),
    ("clamp double", "double", lambda c: clean.clamp(c, 0, 20), [-1.5, 3.25, 21.0, None], [0.0, 3.25, 20.0, None]),
    ("interest", "int", lambda c: clean.null_outside(c, 2, 30), [1, 2, 30, 31, None], [None, 2, 30, None, None]),
    ("count", "string", lambda c: clean.parse_count(c, 20), ["3_", "-100", "1.5", "1496", "_", "-3", "99999999999", None],
     [3, 20, 1, 20, None, 3, None, None]),
    ("delay", "int", lambda c: clean.cap(c, 180), [-40, 180, 181, None], [-40, 180, 180, None]),
    ("emi", "double", lambda c: F.round(clean.floor_at(c, 0), 2), [-0.5, 12.344, None], [0.0, 12.34, None]),
    ("mix", "string", lambda c: clean.replace_value(c, "_", "Unknown"), ["_", "Good", None, "__"],
     ["Unknown", "Good", None, "__"]),
    ("history", "string", fin.credit_history_years,
     ["22 Years and 1 Months", "NA", None, "5 Months", "1 Year and 6 Months", "3 Years"],
     [22.08, 0.0, 0.0, 0.42, 1.5, 3.0]),
    ("min payment", "string", fin.min_payment_category, ["Yes", "No", "NM", "yes", None], ["1", "0", "-1", None, None]),
    ("behaviour", "string", lambda c: clean.whitelist(c, fin.PAYMENT_BEHAVIOURS),
     ["Low_spent_Small_value_payments", "!@9#%8", None], ["Low_spent_Small_value_payments", None, None]),
    ("income source", "double", fin.income_source, [None, -0.5, 0.09, 0.1, 0.29, 0.3],
     ["Unknown", "Primarily Salary", "Primarily Salary", "Mixed Income", "Mixed Income", "Significant Non-Salary Income"]),
    ("loan count", "string", fin.loan_type_count, [None, "", "Auto Loan", "A and B", "A, B, and C"], [0, 0, 1, 2, 4]),
    ("loan count exact", "string", lambda c: fin.loan_type_count(c, exact=True), [None, "", "A and B", "A, B, and C"],
     [0, 0, 2, 3]),
    ("tokens", "string", fin.loan_tokens, ["A, B, and C", None, ""], [["A", " B", "", "C"], None, [""]]),
    ("loan column", "string", fin.loan_column_name, ["Credit-Builder Loan"], ["Loan_Credit_Builder_Loan"]),
    ("text to int", "string", lambda c: clean.number_from(c, T.StringType(), T.IntegerType()),
     ["-1", "10.0", "3_", "1.5", "x", None], [-1, 10, 3, 1, None, None]),
    ("text to double", "string", lambda c: clean.number_from(c, T.StringType(), T.DoubleType()),
     ["1.2E-5", "-3.5_", "x", None], [1.2e-05, -3.5, None, None]),
    ("strict text to int", "string", lambda c: clean.read_as(c, T.StringType(), T.IntegerType()),
     ["10", "10.0", "3_", "", None], [10, 10, None, None, None]),
]


@pytest.mark.parametrize("dtype,rule,values,expected", [c[1:] for c in CASES], ids=[c[0] for c in CASES])
def test_rule(column, dtype, rule, values, expected):
    assert column(values, dtype, rule) == expected


@pytest.mark.parametrize(
    "income,salary,ratio,source",
    [
        (120000.0, 10000.0, 0.0, "Primarily Salary"),
        (120000.0, 8000.0, 0.2, "Mixed Income"),
        (120000.0, 5000.0, 0.5, "Significant Non-Salary Income"),
        (120000.0, 20000.0, -1.0, "Primarily Salary"),
        (None, 5000.0, None, "Unknown"),
        (0.0, 5000.0, None, "Unknown"),
        (120000.0, 0.0, None, "Unknown"),
    ],
)
def test_income(spark, income, salary, ratio, source):
    df = spark.createDataFrame([(income, salary)], "income double, salary double")
    df = df.select(fin.extra_income_ratio("income", "salary").alias("r"))
    assert tuple(df.select("r", fin.income_source("r")).first()) == (ratio, source)


def test_expense_and_debt_ratio(spark):
    rows = [(50.0, 25.0, 300.0), (50.0, None, 300.0), (50.0, 25.0, 0.0), (50.0, 25.0, None)]
    df = spark.createDataFrame(rows, "emi double, invested double, salary double")
    assert [r[0] for r in df.select(fin.expense_ratio("emi", "invested", "salary")).collect()] == [0.25, None, None, None]
    assert [r[0] for r in df.select(fin.debt_to_income("emi", "salary")).collect()] == [50 / 300, 50 / 300, None, None]


def test_behavior_score(spark):
    rows = [("Good", "1", 20.0, 3.0), (None, None, None, 1.3), ("Bad", "0", 30.0, 1.4), ("Unknown", "-1", 70.0, 1.45)]
    df = spark.createDataFrame(rows, "mix string, pay string, used double, expected double")
    for row in df.select(fin.credit_behavior_score("mix", "pay", "used").alias("score"), "expected").collect():
        assert row.score == pytest.approx(row.expected, abs=1e-9)


def test_missed_instalments(spark):
    rows = [(300.3, 100.1), (60.9, 20.3), (100.0, 0.0), (None, 100.0), (100.0, None), (-5.0, 100.0)]
    df = spark.createDataFrame(rows, "over float, due float")
    default = [r[0] for r in df.select(loans.installments_missed("over", "due")).collect()]
    exact = [r[0] for r in df.select(loans.installments_missed("over", "due", exact=True)).collect()]
    assert default == [3, 4, 0, 0, 0, 0]
    assert exact == [3, 3, 0, 0, 0, 0]


def test_first_missed_date_is_clamped_to_the_month(spark):
    df = spark.createDataFrame([(dt.date(2023, 3, 31), 1), (dt.date(2023, 3, 31), 0)], "day date, n int")
    dates = [r[0] for r in df.select(loans.first_missed_date("day", "n")).collect()]
    assert dates == [dt.date(2023, 2, 28), None]


def test_default_date(column):
    day = dt.date(2023, 5, 1)
    assert column([None, day], "date", lambda c: clean.default_date(c, "2023-01-01")) == [dt.date(2023, 1, 1), day]
    assert column([None], "date", lambda c: clean.default_date(c, None)) == [None]


def test_rules_hold_under_ansi_mode(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
