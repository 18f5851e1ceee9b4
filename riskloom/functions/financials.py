"""Credit history, ratios, categories, scores and loan-type text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.functions.cleaning import _col, first_match, recode

# Fixed values of the financial rules.
YEARS_PATTERN = r"(\d+) Years?"
MONTHS_PATTERN = r"(\d+) Months?"
UNKNOWN = "Unknown"
MIN_PAYMENT_CODES = {"Yes": "1", "No": "0", "NM": "-1"}
PAYMENT_BEHAVIOURS = [
    "High_spent_Small_value_payments",
    "High_spent_Medium_value_payments",
    "High_spent_Large_value_payments",
    "Low_spent_Small_value_payments",
    "Low_spent_Medium_value_payments",
    "Low_spent_Large_value_payments",
]
INCOME_SOURCES = [(0.1, "Primarily Salary"), (0.3, "Mixed Income")]
OTHER_INCOME_SOURCE = "Significant Non-Salary Income"
MIX_SCORES = {"Good": 3.0, "Standard": 2.0, "Bad": 1.0}
MIN_PAYMENT_SCORES = {"1": 3.0, "0": 1.0, "-1": 2.0}
UNKNOWN_SCORE = 1.5
UTILIZATION_SCORES = [(30, 3.0), (70, 2.0)]
HIGH_UTILIZATION_SCORE = 1.0
SCORE_WEIGHTS = {"mix": 0.3, "min_payment": 0.3, "utilization": 0.4}
LOAN_CONJUNCTION = " and "
LOAN_SEPARATOR = ","
LOAN_COLUMN_PREFIX = "Loan_"
# Whitespace removed around a loan type before it names a column.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


# --- credit history -----------------------------------------------------------------


def history_years(c: Column | str) -> Column:
    return first_match(c, YEARS_PATTERN, "int")


def history_months(c: Column | str) -> Column:
    return first_match(c, MONTHS_PATTERN, "int")


def history_age(years: Column | str, months: Column | str) -> Column:
    """Years with two places. A missing part counts as 0, so unknown history is 0, not NULL."""
    years, months = F.coalesce(_col(years), F.lit(0)), F.coalesce(_col(months), F.lit(0))
    return F.round(years + months / F.lit(12), 2)


def credit_history_years(c: Column | str) -> Column:
    return history_age(history_years(c), history_months(c))


# --- ratios ---------------------------------------------------------------------------


def extra_income_ratio(income: Column | str, salary: Column | str) -> Column:
    """Share of the income that twelve salaries do not explain; may be negative."""
    income, salary = _col(income), _col(salary)
    ratio = F.try_divide(income - salary * 12, income)
    return F.round(F.when((income > 0) & (salary > 0), ratio), 2)


def income_source(ratio: Column | str) -> Column:
    """Category of the rounded ratio."""
    ratio = _col(ratio)
    out = F.when(ratio.isNull(), F.lit(UNKNOWN))
    for upper, name in INCOME_SOURCES:
        out = out.when(ratio < upper, F.lit(name))
    return out.otherwise(F.lit(OTHER_INCOME_SOURCE))


def expense_ratio(emi: Column | str, invested: Column | str, salary: Column | str) -> Column:
    salary = _col(salary)
    return F.round(F.when(salary > 0, F.try_divide(_col(emi) + _col(invested), salary)), 2)


def debt_to_income(debt: Column | str, income: Column | str) -> Column:
    """Not rounded."""
    income = _col(income)
    return F.when(income > 0, F.try_divide(_col(debt), income))


# --- categories and scores --------------------------------------------------------------


def min_payment_category(c: Column | str) -> Column:
    return recode(c, MIN_PAYMENT_CODES)


def credit_behavior_score(mix: Column | str, min_payment: Column | str, utilization: Column | str) -> Column:
    """Weighted sum of three sub-scores, added left to right in double precision."""
    utilization = _col(utilization)
    by_use = F
    for upper, score in UTILIZATION_SCORES:
        by_use = by_use.when(utilization < upper, F.lit(score))
    return (
        recode(mix, MIX_SCORES, UNKNOWN_SCORE) * F.lit(SCORE_WEIGHTS["mix"])
        + recode(min_payment, MIN_PAYMENT_SCORES, UNKNOWN_SCORE) * F.lit(SCORE_WEIGHTS["min_payment"])
        + by_use.otherwise(F.lit(HIGH_UTILIZATION_SCORE)) * F.lit(SCORE_WEIGHTS["utilization"])
    )


# --- loan-type text -----------------------------------------------------------------------


def loan_tokens(c: Column | str) -> Column:
    """Loan types named in the text. Tokens keep their blanks; ``A, B, and C`` has four."""
    listed = F.replace(_col(c), F.lit(LOAN_CONJUNCTION), F.lit(LOAN_SEPARATOR))
    return F.split(listed, LOAN_SEPARATOR)


def loan_type_count(c: Column | str, exact: bool = False) -> Column:
    """Number of tokens, 0 for missing text. ``exact=True`` leaves blank tokens out."""
    tokens = loan_tokens(c)
    if exact:
        tokens = F.filter(tokens, lambda token: F.btrim(token, F.lit(WHITESPACE)) != "")
        return F.coalesce(F.size(tokens), F.lit(0))
    return F.when(_col(c) != "", F.size(tokens)).otherwise(F.lit(0))


def loan_type_name(token: Column | str) -> Column:
    return F.btrim(_col(token), F.lit(WHITESPACE))


def loan_column_name(loan_type: Column | str) -> Column:
    """Name of the indicator column: blanks and hyphens become underscores."""
    return F.concat(F.lit(LOAN_COLUMN_PREFIX), F.translate(_col(loan_type), " -", "__"))


def mentions(c: Column | str, loan_type: str) -> Column:
    """1 if the text contains the loan type anywhere, else 0, also for missing text."""
    return F.coalesce(F.contains(_col(c), F.lit(loan_type)).cast("int"), F.lit(0))
