"""The four raw tables as projections of the TPC-H-like demo tables.

The column expressions are plain SQL that Spark and other engines read alike, so that
an independent engine can compute expected results from the same definitions. ``k`` is
the order key, ``p`` the whole price, ``c`` the customer key, ``month(...)`` etc. are
spelled with standard functions. Moving a date by months is the one function whose
name differs between engines; it is written ADDM(date, months).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DUE = "(floor(price / 10) + cast('0.1' as double))"

LOAN = {
    "loan_id": "cast(k as string)",
    "Customer_ID": "concat('CUS_', cust)",
    "loan_start_date": "cast(ordered as date)",
    "tenure": "10",
    "installment_num": "case when k % 83 <> 0 then cast(k % 11 as int) end",
    "loan_amt": "price",
    "due_amt": f"case when k % 97 = 0 then cast(0 as double) else {DUE} end",
    "paid_amt": f"case when status = 'F' then cast(0 as double) else {DUE} end",
    "overdue_amt": f"""case when k % 89 = 0 then cast(null as double) when status = 'F' then {DUE} * (k % 4)
        when status = 'P' then {DUE} / 2 else cast(0 as double) end""",
    "balance": "price * (10 - k % 11)",
}

ATTRIBUTES = {
    "Customer_ID": "concat('CUS_', c)",
    "Name": "name",
    "Age": """case c % 10 when 0 then '-500' when 1 then concat(15 + c % 70, '_') when 2 then '8698'
        when 3 then cast(null as string) else cast(15 + c % 70 as string) end""",
    "SSN": """case when c % 13 = 0 then '#F%$D@*&8' when c % 17 = 0 then cast(null as string)
        when c % 7 = 0 then lpad(cast(c as string), 9, '0')
        else concat('821-00-', lpad(cast(c % 1000 as string), 4, '0')) end""",
    "Occupation": """case when c % 9 = 0 then '_______' when c % 11 = 0 then cast(null as string)
        when c % 12 = 0 then '  ' when segment = 'HOUSEHOLD' then ' Writer '
        when segment = 'FURNITURE' then 'Developer' when segment = 'MACHINERY' then 'Engineer'
        when segment = 'BUILDING' then 'Lawyer' else 'Pilot' end""",
}

FINANCIALS = {
    "Customer_ID": "concat('CUS_', cust)",
    "Annual_Income": """case when k % 41 = 0 then '_' when k % 43 = 0 then '24198062.0'
        when k % 7 = 0 then concat(p, '.25_') else concat(p, '.25') end""",
    "Monthly_Inhand_Salary": """case when k % 19 = 0 then cast(null as string)
        else concat(cast(floor(p * (7 + k % 4) / 120) as bigint), '.5') end""",
    "Num_Bank_Accounts": "cast(k % 14 - 1 as int)",
    "Num_Credit_Card": "cast(k % 19 - 1 as int)",
    "Interest_Rate": "cast(k % 40 as int)",
    "Num_of_Loan": """case when k % 23 = 0 then cast(null as string) when k % 11 = 0 then '-100'
        when k % 5 = 0 then concat(k % 9, '_') else cast(k % 25 as string) end""",
    "Type_of_Loan": """case k % 7 when 0 then cast(null as string) when 1 then '' when 2 then 'Auto Loan'
        when 3 then 'Auto Loan and Payday Loan'
        when 4 then 'Auto Loan, Payday Loan, and Credit-Builder Loan'
        when 5 then 'Not Specified' else 'Student Loan, and Mortgage Loan' end""",
    "Delay_from_due_date": "cast(k % 230 - 30 as int)",
    "Num_of_Delayed_Payment": """case when k % 31 = 0 then cast(null as string)
        when k % 8 = 0 then concat(k % 60, '_') when k % 9 = 0 then '-3' else cast(k % 60 as string) end""",
    "Changed_Credit_Limit": """case when k % 13 = 0 then '_' when k % 3 = 0 then concat('-', k % 9, '.75')
        else concat(k % 30, '.5') end""",
    "Num_Credit_Inquiries": "cast(k % 30 - 2 as double)",
    "Credit_Mix": """case k % 5 when 0 then '_' when 1 then 'Good' when 2 then 'Standard' when 3 then 'Bad'
        else cast(null as string) end""",
    "Outstanding_Debt": "concat(k % 5000, case when k % 10 = 0 then '.5_' else '.5' end)",
    "Credit_Utilization_Ratio": "cast(k % 130 - 10 as double) + cast('0.25' as double)",
    "Credit_History_Age": """case when k % 29 = 0 then cast(null as string) when k % 17 = 0 then 'NA'
        else concat(k % 34, ' Years and ', k % 12, ' Months') end""",
    "Payment_of_Min_Amount": """case k % 4 when 0 then 'Yes' when 1 then 'No' when 2 then 'NM'
        else cast(null as string) end""",
    "Total_EMI_per_month": "cast(k % 300 - 5 as double) + cast('0.5' as double)",
    "Amount_invested_monthly": """case when k % 37 = 0 then cast(null as string) when k % 15 = 0 then '__10000__'
        else concat(k % 900, '.75') end""",
    "Payment_Behaviour": """case k % 8 when 0 then 'High_spent_Small_value_payments'
        when 1 then 'Low_spent_Large_value_payments' when 2 then 'Low_spent_Medium_value_payments'
        when 3 then 'High_spent_Medium_value_payments' when 4 then 'Low_spent_Small_value_payments'
        when 5 then 'High_spent_Large_value_payments' when 6 then '!@9#%8' else cast(null as string) end""",
    "Monthly_Balance": """case when k % 101 = 0 then '__-333333333333333333333333333__'
        when k % 6 = 0 then concat('-', k % 400, '.5') else concat(k % 400, '.25') end""",
}

ORDER_COLUMNS = {
    "k": "o_orderkey",
    "cust": "o_custkey",
    "price": "o_totalprice",
    "p": "cast(floor(o_totalprice) as bigint)",
    "status": "o_orderstatus",
    "ordered": "o_orderdate",
}
CUSTOMER_COLUMNS = {"c": "c_custkey", "name": "c_name", "segment": "c_mktsegment"}
CLICK_EVENTS = {"fe_1": "click", "fe_2": "error", "fe_3": "purchase", "fe_4": "signup", "fe_5": "view"}


ORDER_MONTH = "cast(date_trunc('month', ordered) as date)"
SNAPSHOTS = {
    "loans": (ORDER_MONTH, "cast(k % 11 as int)"),
    "financials": (ORDER_MONTH, "0"),
    "attributes": ("date '1998-01-01'", "cast(v as int)"),
    "clickstream": ("date '1998-01-01'", "cast(day(ts) - 1 as int)"),
}


def select_list(columns: dict[str, str]) -> list[str]:
    return [f"{expr} AS {name}" for name, expr in columns.items()]


def snapshot_of(view: str) -> str:
    day, months = SNAPSHOTS[view]
    return f"add_months({day}, {months})"


def _project(df: DataFrame, view: str, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*select_list({**columns, "snapshot_date": snapshot_of(view)}))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(*select_list(ORDER_COLUMNS))


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(_orders(spark, sf_dir), "loans", LOAN)


def financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(_orders(spark, sf_dir), "financials", FINANCIALS)


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two months: every customer in the first, every sixth again in the second."""
    customers = _table(spark, sf_dir, "customer").selectExpr(*select_list(CUSTOMER_COLUMNS))
    months = F.expr("explode(case when c % 6 = 0 then array(0, 1) else array(0) end)")
    return _project(customers.withColumn("v", months), "attributes", ATTRIBUTES)


def attributes_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``attributes`` and, for every fifth customer, a second row under another name."""
    customers = _table(spark, sf_dir, "customer").selectExpr(*select_list(CUSTOMER_COLUMNS))
    months = F.expr("explode(case when c % 6 = 0 then array(0, 1) else array(0) end)")
    names = F.expr("explode(case when c % 5 = 0 then array(name, concat(name, ' Jr')) else array(name) end)")
    return _project(customers.withColumn("v", months).withColumn("name", names), "attributes", ATTRIBUTES)


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user and day of the event month, the largest value of each event type."""
    events = _table(spark, sf_dir, "events")
    largest = [F.max(F.when(F.col("event_type") == e, F.col("value"))).alias(f) for f, e in CLICK_EVENTS.items()]
    keys = [
        F.concat(F.lit("CUS_"), F.col("user_id")).alias("Customer_ID"),
        F.expr(snapshot_of("clickstream")).alias("snapshot_date"),
    ]
    return events.groupBy(*keys).agg(*largest)
