"""Column types of every table, stated once.

Raw fields that arrive dirty are text: they are parsed in the silver layer, never
guessed by schema inference, so a month with clean values and a month with stray
characters give the same column types.
"""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, FLOAT, DOUBLE, DATE = (
    T.StringType(),
    T.IntegerType(),
    T.FloatType(),
    T.DoubleType(),
    T.DateType(),
)

SNAPSHOT = "snapshot_date"
CUSTOMER = "Customer_ID"
KEYS = [CUSTOMER, SNAPSHOT]
FEATURE_PREFIX = "fe_"


def struct(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


# --- loan ledger -----------------------------------------------------------------

LOAN_MONEY = ["loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance"]

LOAN_RAW = {
    "loan_id": STRING,
    CUSTOMER: STRING,
    "loan_start_date": DATE,
    "tenure": INT,
    "installment_num": INT,
    **{name: DOUBLE for name in LOAN_MONEY},
    SNAPSHOT: DATE,
}
# Money is 32-bit from silver on; days-past-due depends on that precision.
LOAN_TYPES = {**LOAN_RAW, **{name: FLOAT for name in LOAN_MONEY}}
LOAN_SILVER = {
    **LOAN_TYPES,
    "mob": INT,
    "installments_missed": INT,
    "first_missed_date": DATE,
    "dpd": INT,
}
LABEL_STORE = {"loan_id": STRING, CUSTOMER: STRING, "label": INT, "label_def": STRING, SNAPSHOT: DATE}

# --- clickstream (any number of fe_ columns follows the keys) -----------------------

CLICK_KEYS = {CUSTOMER: STRING, SNAPSHOT: DATE}

# --- customer attributes ----------------------------------------------------------

ATTRIBUTES_RAW = {
    CUSTOMER: STRING,
    "Name": STRING,
    "Age": STRING,
    "SSN": STRING,
    "Occupation": STRING,
    SNAPSHOT: DATE,
}
ATTRIBUTES_SILVER = {**ATTRIBUTES_RAW, "Age": INT}
# No name or SSN past silver. The snapshot stays as the table's partition key.
ATTRIBUTES_GOLD = {
    CUSTOMER: STRING,
    "Age": INT,
    "Age_Group": STRING,
    "Occupation": STRING,
    "Occupation_Risk_Score": INT,
    SNAPSHOT: DATE,
}

# --- customer financials ----------------------------------------------------------

FINANCIALS_CLEAN = {
    CUSTOMER: STRING,
    "Annual_Income": DOUBLE,
    "Monthly_Inhand_Salary": DOUBLE,
    "Num_Bank_Accounts": INT,
    "Num_Credit_Card": INT,
    "Interest_Rate": INT,
    "Num_of_Loan": INT,
    "Type_of_Loan": STRING,
    "Delay_from_due_date": INT,
    "Num_of_Delayed_Payment": INT,
    "Changed_Credit_Limit": DOUBLE,
    "Num_Credit_Inquiries": DOUBLE,
    "Credit_Mix": STRING,
    "Outstanding_Debt": DOUBLE,
    "Credit_Utilization_Ratio": DOUBLE,
    "Credit_History_Age": STRING,
    "Payment_of_Min_Amount": STRING,
    "Total_EMI_per_month": DOUBLE,
    "Amount_invested_monthly": DOUBLE,
    "Payment_Behaviour": STRING,
    "Monthly_Balance": DOUBLE,
    SNAPSHOT: DATE,
}
FINANCIALS_RAW = {name: DATE if name == SNAPSHOT else STRING for name in FINANCIALS_CLEAN}
FINANCIALS_SILVER = {
    **FINANCIALS_CLEAN,
    "Credit_History_Years": INT,
    "Credit_History_Months": INT,
    "Credit_History_Age_Years": DOUBLE,
    "Payment_of_Min_Amount_Category": STRING,
    "Extra_Income_Ratio": DOUBLE,
    "Income_Source_Category": STRING,
    "Loan_Type_Count": INT,
    "Monthly_Income_Expense_Ratio": DOUBLE,
}
FINANCIALS_GOLD = {
    **{k: v for k, v in FINANCIALS_SILVER.items() if k not in ("Credit_History_Years", "Credit_History_Months")},
    "Debt_To_Income_Ratio": DOUBLE,
    "Credit_Behavior_Score": DOUBLE,
}

LOAN_TYPES_PRESENT = "Loan_Types"  # gold: sorted indicator names of the types a row mentions

# Vocabulary of the one-hot columns of gold financials, one row per month and column.
LOAN_TYPE_COLUMNS = {SNAPSHOT: DATE, "column_name": STRING, "loan_type": STRING}
