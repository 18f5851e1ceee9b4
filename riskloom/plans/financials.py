"""Customer financials -> silver -> gold.

Silver is four projections: read the text, bound the numbers, derive the ratios, name
the categories. A regular expression is the argument of one later projection only, so
Spark evaluates it once per row; the whole layer is map-only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import cleaning as clean
from riskloom.functions import financials as rules
from riskloom.operators.projection import enforce_schema, select_except
from riskloom.operators.vocabulary import (
    THRESHOLD,
    StoredVocabulary,
    loan_type_columns,
    one_hot_loans,
    with_loan_types,
)
from riskloom.schemas import CUSTOMER, DATE, FINANCIALS_CLEAN, FINANCIALS_SILVER, SNAPSHOT, STRING

# The permitted range of each field.
UNSIGNED_AMOUNTS = ["Annual_Income", "Monthly_Inhand_Salary", "Outstanding_Debt", "Amount_invested_monthly"]
SIGNED_AMOUNTS = ["Changed_Credit_Limit", "Monthly_Balance"]
COUNT_CAPS = {"Num_of_Loan": 20, "Num_of_Delayed_Payment": 50}
CLAMPS = {"Num_Bank_Accounts": (0, 10), "Num_Credit_Card": (0, 15), "Num_Credit_Inquiries": (0, 20)}
INTEREST_RANGE = (2, 30)
MAX_DELAY_DAYS = 180
UTILIZATION_RANGE = (0, 100)
MISSING_MIX = "_"

NUMBERS = [*CLAMPS, "Interest_Rate", "Delay_from_due_date", "Credit_Utilization_Ratio", "Total_EMI_per_month"]
TEMPORARY = ["loan_types_array", "Credit_History_Years", "Credit_History_Months"]


def parse_financials(raw: DataFrame) -> DataFrame:
    """Text to numbers; ranges are not applied yet. Fields that are numbers already stay."""
    number = lambda name: clean.number_from(name, raw.schema[name].dataType, FINANCIALS_CLEAN[name])
    typed = enforce_schema(raw, {CUSTOMER: STRING, SNAPSHOT: DATE})
    return typed.withColumns(
        {
            **{name: clean.parse_decimal(F.col(name).cast("string")) for name in UNSIGNED_AMOUNTS},
            **{name: clean.parse_decimal(F.col(name).cast("string"), signed=True) for name in SIGNED_AMOUNTS},
            **{name: clean.parse_digits(F.col(name).cast("string")) for name in COUNT_CAPS},
            **{name: number(name) for name in NUMBERS},
            "Credit_History_Years": rules.history_years("Credit_History_Age"),
            "Credit_History_Months": rules.history_months("Credit_History_Age"),
            "Loan_Type_Count": rules.loan_type_count("Type_of_Loan"),
        }
    )


def bound_financials(parsed: DataFrame) -> DataFrame:
    """Clamp, cap and blank out numbers beyond their range; normalise the categories."""
    return parsed.withColumns(
        {
            **{name: clean.clamp(name, lo, hi) for name, (lo, hi) in CLAMPS.items()},
            **{name: clean.cap(name, hi) for name, hi in COUNT_CAPS.items()},
            "Interest_Rate": clean.null_outside("Interest_Rate", *INTEREST_RANGE),
            "Delay_from_due_date": clean.cap("Delay_from_due_date", MAX_DELAY_DAYS),
            "Credit_Mix": clean.replace_value("Credit_Mix", MISSING_MIX, rules.UNKNOWN),
            "Credit_Utilization_Ratio": F.round(clean.clamp("Credit_Utilization_Ratio", *UTILIZATION_RANGE), 2),
            "Total_EMI_per_month": F.round(clean.floor_at("Total_EMI_per_month", 0), 2),
            "Payment_Behaviour": clean.whitelist("Payment_Behaviour", rules.PAYMENT_BEHAVIOURS),
            "Credit_History_Age_Years": rules.history_age("Credit_History_Years", "Credit_History_Months"),
            "Payment_of_Min_Amount_Category": rules.min_payment_category("Payment_of_Min_Amount"),
        }
    )


def financials_silver(raw: DataFrame) -> DataFrame:
    """Cleaned financials with history, income and expense features, in a fixed column order."""
    ratios = bound_financials(parse_financials(raw)).withColumns(
        {
            "Extra_Income_Ratio": rules.extra_income_ratio("Annual_Income", "Monthly_Inhand_Salary"),
            "Monthly_Income_Expense_Ratio": rules.expense_ratio(
                "Total_EMI_per_month", "Amount_invested_monthly", "Monthly_Inhand_Salary"
            ),
        }
    )
    named = ratios.withColumn("Income_Source_Category", rules.income_source("Extra_Income_Ratio"))
    extra = [name for name in raw.columns if name not in FINANCIALS_SILVER]
    return named.select(*FINANCIALS_SILVER, *extra)


def financials_gold(
    silver: DataFrame,
    loan_types: list[str] | DataFrame | StoredVocabulary | None = None,
    threshold: int = THRESHOLD,
    wide: bool = False,
) -> DataFrame:
    """Debt ratio, behaviour score and the loan types of each row.

    A list of ``loan_types`` asks for one 0/1 column per type, alike in every month. By
    default the types of each month are counted from ``silver``, or taken from a frame of
    ``loan_type_columns``, and kept as the array ``Loan_Types``, which holds any number.
    ``wide`` asks for the month's 0/1 columns instead, NULL where the month lacks the type.
    """
    scored = silver.withColumns(
        {
            "Debt_To_Income_Ratio": rules.debt_to_income("Outstanding_Debt", "Annual_Income"),
            "Credit_Behavior_Score": rules.credit_behavior_score(
                "Credit_Mix", "Payment_of_Min_Amount_Category", "Credit_Utilization_Ratio"
            ),
        }
    )
    vocabulary = loan_type_columns(silver, threshold) if loan_types is None else loan_types
    if wide or isinstance(vocabulary, list):
        return select_except(one_hot_loans(scored, vocabulary), TEMPORARY)
    return select_except(with_loan_types(scored, vocabulary), TEMPORARY)
