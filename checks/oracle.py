"""Expected results as SQL over the demo tables, for an independent engine (DuckDB).

Every statement is a list of common table expressions followed by a SELECT; ``CTE``
holds the building blocks and ``_with`` picks the ones a statement needs.
"""

from __future__ import annotations

import re

from checks.queries import (
    FITTED_UNTIL,
    INDEXED,
    LATE_MONTH,
    LOAN_TYPE_LIST,
    RUN_DATE,
    SECOND_RUN,
    VOCABULARY_THRESHOLD,
)
from riskloom.sources import demo_views as views

KEYS = "Customer_ID, cast(snapshot_date as varchar) AS snapshot_date"
TEXT_DATE = "cast(snapshot_date as varchar) AS snapshot_date"


# --- the four views ------------------------------------------------------------------------


def _snapshot(view: str) -> str:
    day, months = views.SNAPSHOTS[view]
    return f"cast({day} + to_months({months}) as date) AS snapshot_date"


def _items(columns: dict[str, str]) -> str:
    return ", ".join(views.select_list(columns))


_ORDERS = f"(SELECT {_items(views.ORDER_COLUMNS)} FROM orders)"
_CUSTOMERS = f"(SELECT {_items(views.CUSTOMER_COLUMNS)} FROM customer)"
_MONTHS = "(VALUES (0), (1)) m(v)"
_ATTR = f"SELECT {_items(views.ATTRIBUTES)}, {_snapshot('attributes')}"
_CLICK_MAX = ", ".join(f"max(value) FILTER (WHERE event_type = '{e}') AS {f}" for f, e in views.CLICK_EVENTS.items())

CTE: dict[str, str] = {
    "v_loan": f"SELECT {_items(views.LOAN)}, {_snapshot('loans')} FROM {_ORDERS}",
    "v_fin": f"SELECT {_items(views.FINANCIALS)}, {_snapshot('financials')} FROM {_ORDERS}",
    "v_attr": f"{_ATTR} FROM {_CUSTOMERS}, {_MONTHS} WHERE v = 0 OR c % 6 = 0",
    "v_attr_copies": f"""SELECT * FROM v_attr UNION ALL
        {_ATTR} FROM (SELECT * REPLACE (name || ' Jr' AS name) FROM {_CUSTOMERS}), {_MONTHS}
        WHERE (v = 0 OR c % 6 = 0) AND c % 5 = 0""",
    "v_click": f"""SELECT 'CUS_' || user_id AS Customer_ID, {_snapshot('clickstream')}, {_CLICK_MAX}
        FROM events GROUP BY ALL""",
}

# --- loans ------------------------------------------------------------------------------------

_MONEY = ["loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance"]
_INTS = ["tenure", "installment_num"]

CTE["loan_typed"] = f"""SELECT loan_id, Customer_ID, loan_start_date, snapshot_date,
    {', '.join(f'cast({c} as int) AS {c}' for c in _INTS)},
    {', '.join(f'cast({c} as float) AS {c}' for c in _MONEY)} FROM v_loan"""
CTE["loan_counted"] = """SELECT *, installment_num AS mob, cast(ceil(cast(overdue_amt as double)
    / nullif(cast(due_amt as double), 0)) as int) AS missed FROM loan_typed"""
CTE["loan_filled"] = f"""SELECT loan_id, Customer_ID, loan_start_date, snapshot_date,
    {', '.join(f'coalesce({c}, 0) AS {c}' for c in [*_INTS, 'mob', *_MONEY])},
    coalesce(missed, 0) AS installments_missed FROM loan_counted"""
CTE["loan_dated"] = """SELECT *, CASE WHEN installments_missed > 0
    THEN cast(snapshot_date - to_months(installments_missed) as date) END AS first_missed_date FROM loan_filled"""
CTE["loan"] = """SELECT *, CASE WHEN overdue_amt > 0
    THEN cast(date_diff('day', first_missed_date, snapshot_date) as int) ELSE 0 END AS dpd FROM loan_dated"""
CTE["labels"] = """SELECT loan_id, Customer_ID, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label,
    '30dpd_6mob' AS label_def, snapshot_date FROM loan WHERE mob = 6"""

_LOAN_SELECT = f"""loan_id, Customer_ID, cast(loan_start_date as varchar) AS loan_start_date, {TEXT_DATE},
    {', '.join(_INTS)}, {', '.join(f'cast({c} as double) AS {c}' for c in _MONEY)}"""

# --- attributes -----------------------------------------------------------------------------------

AGE = r"CASE WHEN try_cast(regexp_extract(Age, '^(\d+)', 1) as int) BETWEEN 18 AND 80 THEN try_cast(regexp_extract(Age, '^(\d+)', 1) as int) END"
SSN = r"CASE WHEN regexp_full_match(replace(SSN, '-', ''), '\d{9}') THEN replace(SSN, '-', '') END"
OCCUPATION = """CASE WHEN Occupation IS NULL OR trim(Occupation) IN ('', '_______')
    OR regexp_full_match(Occupation, '_+') THEN NULL ELSE trim(Occupation) END"""
AGE_GROUP = """CASE WHEN Age < 25 THEN 'Young' WHEN Age < 35 THEN 'Young_Adult' WHEN Age < 50 THEN 'Middle_Aged'
    WHEN Age < 65 THEN 'Senior' ELSE 'Elderly' END"""
RISK = """CASE WHEN Occupation IN ('Entrepreneur', 'Writer', 'Musician') THEN 3
    WHEN Occupation IN ('Lawyer', 'Architect', 'Engineer', 'Accountant', 'Scientist', 'Teacher', 'Doctor') THEN 1
    ELSE 2 END"""
_TIES = "Name NULLS LAST, Age NULLS LAST, SSN NULLS LAST, Occupation NULLS LAST"

CTE["attr_unique"] = f"""SELECT * FROM v_attr_copies QUALIFY row_number()
    OVER (PARTITION BY snapshot_date, Customer_ID ORDER BY {_TIES}) = 1"""
_CLEAN = f"Customer_ID, Name, {AGE} AS Age, {SSN} AS SSN, {OCCUPATION} AS Occupation, snapshot_date"
CTE["attr_clean"] = f"SELECT {_CLEAN} FROM v_attr"
CTE["attr"] = f"SELECT {_CLEAN} FROM attr_unique"
CTE["attr_gold"] = f"""SELECT Customer_ID, snapshot_date, Age, Occupation, {AGE_GROUP} AS Age_Group,
    {RISK} AS Occupation_Risk_Score FROM attr"""

# --- financials -------------------------------------------------------------------------------------


def _decimal(column: str, pattern: str = r"(\d+\.?\d*)") -> str:
    return f"round(try_cast(regexp_extract(replace({column}, '_', ''), '{pattern}', 1) as double), 2)"


def _signed(column: str) -> str:
    return _decimal(column, r"([+-]?\d+\.?\d*)")


def _count(column: str, cap: int) -> str:
    digits = rf"try_cast(regexp_extract(replace({column}, '_', ''), '(\d+)', 1) as int)"
    return f"CASE WHEN {digits} > {cap} THEN {cap} ELSE {digits} END"


def _clamp(column: str, lo: int, hi: int) -> str:
    return f"CASE WHEN {column} < {lo} THEN {lo} WHEN {column} > {hi} THEN {hi} ELSE {column} END"


def _tokens(column: str = "Type_of_Loan") -> str:
    return f"string_split(replace({column}, ' and ', ','), ',')"


_UNSIGNED = ["Annual_Income", "Monthly_Inhand_Salary", "Outstanding_Debt", "Amount_invested_monthly"]
_CLAMPED = {"Num_Bank_Accounts": (0, 10), "Num_Credit_Card": (0, 15), "Num_Credit_Inquiries": (0, 20)}
_CAPPED = {"Num_of_Loan": 20, "Num_of_Delayed_Payment": 50}
YEARS = r"try_cast(regexp_extract(Credit_History_Age, '(\d+) Years?', 1) as int)"
MONTHS = r"try_cast(regexp_extract(Credit_History_Age, '(\d+) Months?', 1) as int)"
HISTORY = f"round(coalesce({YEARS}, 0) + cast(coalesce({MONTHS}, 0) as double) / 12, 2)"
LOAN_COUNT = f"CASE WHEN coalesce(Type_of_Loan, '') = '' THEN 0 ELSE cast(len({_tokens()}) as int) END"
MIN_PAYMENT = """CASE Payment_of_Min_Amount WHEN 'Yes' THEN '1' WHEN 'No' THEN '0' WHEN 'NM' THEN '-1' END"""
INTEREST = "CASE WHEN Interest_Rate BETWEEN 2 AND 30 THEN Interest_Rate END"
DELAY = "CASE WHEN Delay_from_due_date > 180 THEN 180 ELSE Delay_from_due_date END"
MIX = "CASE WHEN Credit_Mix = '_' THEN 'Unknown' ELSE Credit_Mix END"
UTILIZATION = f"round({_clamp('Credit_Utilization_Ratio', 0, 100)}, 2)"
EMI = "round(CASE WHEN Total_EMI_per_month < 0 THEN 0 ELSE Total_EMI_per_month END, 2)"
BEHAVIOUR = """CASE WHEN Payment_Behaviour IN ('High_spent_Small_value_payments', 'Low_spent_Large_value_payments',
    'Low_spent_Medium_value_payments', 'High_spent_Medium_value_payments', 'Low_spent_Small_value_payments',
    'High_spent_Large_value_payments') THEN Payment_Behaviour END"""

CTE["fin_bounded"] = f"""SELECT Customer_ID, snapshot_date, Type_of_Loan, Credit_History_Age, Payment_of_Min_Amount,
    {', '.join(f'{_decimal(c)} AS {c}' for c in _UNSIGNED)},
    {_signed('Changed_Credit_Limit')} AS Changed_Credit_Limit, {_signed('Monthly_Balance')} AS Monthly_Balance,
    {', '.join(f'{_count(c, hi)} AS {c}' for c, hi in _CAPPED.items())},
    {', '.join(f'{_clamp(c, *r)} AS {c}' for c, r in _CLAMPED.items())},
    {INTEREST} AS Interest_Rate, {DELAY} AS Delay_from_due_date, {MIX} AS Credit_Mix,
    {UTILIZATION} AS Credit_Utilization_Ratio, {EMI} AS Total_EMI_per_month, {BEHAVIOUR} AS Payment_Behaviour,
    {YEARS} AS Credit_History_Years, {MONTHS} AS Credit_History_Months, {HISTORY} AS Credit_History_Age_Years,
    {MIN_PAYMENT} AS Payment_of_Min_Amount_Category, {LOAN_COUNT} AS Loan_Type_Count FROM v_fin"""
EXTRA_INCOME = """round(CASE WHEN Annual_Income > 0 AND Monthly_Inhand_Salary > 0
    THEN (Annual_Income - Monthly_Inhand_Salary * 12) / Annual_Income END, 2)"""
EXPENSE = """round(CASE WHEN Monthly_Inhand_Salary > 0
    THEN (Total_EMI_per_month + Amount_invested_monthly) / Monthly_Inhand_Salary END, 2)"""
SOURCE = """CASE WHEN Extra_Income_Ratio IS NULL THEN 'Unknown'
    WHEN Extra_Income_Ratio < cast('0.1' as double) THEN 'Primarily Salary'
    WHEN Extra_Income_Ratio < cast('0.3' as double) THEN 'Mixed Income' ELSE 'Significant Non-Salary Income' END"""
CTE["fin_ratios"] = f"""SELECT *, {EXTRA_INCOME} AS Extra_Income_Ratio, {EXPENSE} AS Monthly_Income_Expense_Ratio
    FROM fin_bounded"""
CTE["fin"] = f"SELECT *, {SOURCE} AS Income_Source_Category FROM fin_ratios"
DTI = "CASE WHEN Annual_Income > 0 THEN Outstanding_Debt / Annual_Income END"
SCORE = """round(
    cast(CASE Credit_Mix WHEN 'Good' THEN 3 WHEN 'Standard' THEN 2 WHEN 'Bad' THEN 1 ELSE 1.5 END as double)
        * cast('0.3' as double)
    + cast(CASE Payment_of_Min_Amount_Category WHEN '1' THEN 3 WHEN '0' THEN 1 WHEN '-1' THEN 2 ELSE 1.5 END as double)
        * cast('0.3' as double)
    + cast(CASE WHEN Credit_Utilization_Ratio < 30 THEN 3 WHEN Credit_Utilization_Ratio < 70 THEN 2 ELSE 1 END as double)
        * cast('0.4' as double), 4)"""

# --- loan types -----------------------------------------------------------------------------------------

CTE["tokens"] = f"SELECT snapshot_date, unnest({_tokens()}) AS loan_token FROM v_fin WHERE Type_of_Loan IS NOT NULL"
CTE["token_counts"] = "SELECT snapshot_date, loan_token, count(*) AS n FROM tokens GROUP BY ALL"


def _vocabulary(threshold: int) -> str:
    return f"""SELECT DISTINCT snapshot_date, trim(loan_token) AS loan_type FROM token_counts
        WHERE n >= {threshold} AND trim(loan_token) <> ''"""


CTE["vocabulary"] = _vocabulary(VOCABULARY_THRESHOLD)
CTE["vocabulary_default"] = _vocabulary(10)
CTE["months_of_vocabulary"] = "SELECT snapshot_date, list(loan_type) AS types FROM vocabulary GROUP BY ALL"
CTE["months_of_default"] = "SELECT snapshot_date, list(loan_type) AS types FROM vocabulary_default GROUP BY ALL"


def _column(loan_type: str) -> str:
    return "Loan_" + re.sub("[ -]", "_", loan_type)


def _contains(loan_type: str) -> str:
    return f"CASE WHEN contains(coalesce(Type_of_Loan, ''), '{loan_type}') THEN 1 ELSE 0 END"


def _monthly_flags() -> str:
    return ", ".join(
        f"CASE WHEN list_contains(types, '{t}') THEN {_contains(t)} END AS {_column(t)}" for t in LOAN_TYPE_LIST
    )


_GOLD = "SELECT fin.* EXCLUDE (Credit_History_Years, Credit_History_Months), {dti} AS Debt_To_Income_Ratio, {score} AS Credit_Behavior_Score, {flags} FROM fin LEFT JOIN {months} USING (snapshot_date)"
CTE["fin_gold"] = _GOLD.format(dti=DTI, score=SCORE, flags=_monthly_flags(), months="months_of_vocabulary")
CTE["fin_gold_default"] = _GOLD.format(dti=DTI, score=SCORE, flags=_monthly_flags(), months="months_of_default")
CTE["fin_gold_fixed"] = f"""SELECT * EXCLUDE (Credit_History_Years, Credit_History_Months),
    {DTI} AS Debt_To_Income_Ratio, {SCORE} AS Credit_Behavior_Score,
    {', '.join(f'{_contains(t)} AS {_column(t)}' for t in LOAN_TYPE_LIST)} FROM fin"""

# --- clickstream, joins, encoding -----------------------------------------------------------------------------

_FE = list(views.CLICK_EVENTS)
CTE["click"] = f"""SELECT Customer_ID, snapshot_date,
    {', '.join(f'cast(coalesce(cast({c} as float), 0) as double) AS {c}' for c in _FE)} FROM v_click"""


def _joined(fin: str) -> str:
    return f"""SELECT * FROM {fin} LEFT JOIN click USING (Customer_ID, snapshot_date)
        LEFT JOIN attr_gold USING (Customer_ID, snapshot_date)"""


CTE["fin_gaps"] = "SELECT * REPLACE (CASE WHEN Loan_Type_Count <> 2 THEN Customer_ID END AS Customer_ID) FROM fin"
CTE["click_twice"] = "SELECT * FROM click UNION ALL SELECT * FROM click"
CTE["fin_undated"] = "SELECT * REPLACE (CASE WHEN Credit_Mix <> 'Bad' THEN snapshot_date END AS snapshot_date) FROM fin"
CTE["joined"] = _joined("fin_gold_fixed")
CTE["joined_default"] = _joined("fin_gold_default")


def _indexed(source: str, columns: list[str]) -> tuple[str, str]:
    """(select items, FROM clause) that add ``<column>_index`` to the rows of ``source``, named s.

    The code is the dense rank of the value in its month by falling count, then value;
    NULL comes behind all labels, and has no code in a month without labels.
    """
    counts = ", ".join(f"count(*) OVER (PARTITION BY snapshot_date, {c}) AS n_{c}" for c in columns)
    ranks = ", ".join(
        f"dense_rank() OVER (PARTITION BY snapshot_date ORDER BY {c} IS NULL, n_{c} DESC, {c}) - 1 AS r_{c}"
        for c in columns
    )
    items = ", ".join(
        f"CASE WHEN s.{c} IS NOT NULL OR s.r_{c} > 0 THEN cast(s.r_{c} as int) END AS {c}_index" for c in columns
    )
    return items, f"(SELECT *, {ranks} FROM (SELECT *, {counts} FROM {source})) s"


# Columns of the joined table by kind.
_CATEGORICAL = [
    "Type_of_Loan",
    "Credit_Mix",
    "Credit_History_Age",
    "Payment_of_Min_Amount",
    "Payment_Behaviour",
    "Payment_of_Min_Amount_Category",
    "Income_Source_Category",
    "Age_Group",
    "Occupation",
]
_FLAGS = [_column(t) for t in LOAN_TYPE_LIST]
_NUMERIC = [
    *_UNSIGNED,
    "Changed_Credit_Limit",
    "Monthly_Balance",
    *_CAPPED,
    *_CLAMPED,
    "Interest_Rate",
    "Delay_from_due_date",
    "Credit_Utilization_Ratio",
    "Total_EMI_per_month",
    "Credit_History_Age_Years",
    "Loan_Type_Count",
    "Extra_Income_Ratio",
    "Monthly_Income_Expense_Ratio",
    "Debt_To_Income_Ratio",
    "Credit_Behavior_Score",
    *_FLAGS,
    *_FE,
    "Age",
    "Occupation_Risk_Score",
]
_COMBINED_INDEXES = [
    "Credit_Mix",
    "Payment_of_Min_Amount",
    "Payment_Behaviour",
    "Income_Source_Category",
    "Age_Group",
    "Occupation",
]
_KEPT_TEXT = ["Type_of_Loan", "Credit_Mix", "Credit_History_Age", "Income_Source_Category"]


def _non_null(columns: dict[str, str], with_kind: bool) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {f'{chr(39)}{kind}{chr(39)} AS kind, ' if with_kind else ''}count({c}) AS non_null FROM joined"
        for c, kind in columns.items()
    )


def _combined() -> str:
    items, rows = _indexed("joined_default", _COMBINED_INDEXES)
    numbers = ", ".join(f"coalesce(s.{c}, 0) AS {c}" for c in _NUMERIC)
    texts = ", ".join(f"s.{c}" for c in _KEPT_TEXT)
    return f"""SELECT s.Customer_ID, cast(s.snapshot_date as varchar) AS snapshot_date, {numbers}, {texts}, {items}
        FROM {rows}"""


def _index_query(columns: list[str], keep: list[str], source: str = "fin") -> str:
    items, rows = _indexed(source, columns)
    kept = "".join(f"s.{c}, " for c in keep)
    return f"""SELECT s.Customer_ID, cast(s.snapshot_date as varchar) AS snapshot_date, {kept}{items}
        FROM {rows}"""


# --- row counts of a full backfill -------------------------------------------------------------------------------

_BACKFILL = {
    ("bronze", "loans"): "v_loan",
    ("bronze", "clickstream"): "v_click",
    ("bronze", "attributes"): "v_attr_copies",
    ("bronze", "financials"): "v_fin",
    ("silver", "loans"): "v_loan",
    ("silver", "clickstream"): "v_click",
    ("silver", "attributes"): "attr_unique",
    ("silver", "financials"): "v_fin",
    ("gold", "label_store"): "labels",
    ("gold", "attributes"): "attr_unique",
    ("gold", "clickstream"): "v_click",
    ("gold", "financials"): "v_fin",
    ("gold", "combined"): "joined",
}
CTE["calendar"] = """SELECT cast(unnest(generate_series(min(snapshot_date), max(snapshot_date), INTERVAL 1 MONTH)) as date)
    AS snapshot_date FROM v_loan"""
CTE["both_months"] = "SELECT snapshot_date FROM v_loan UNION ALL SELECT snapshot_date FROM v_fin"
CTE["run_months"] = """SELECT cast(unnest(generate_series(min(snapshot_date), max(snapshot_date), INTERVAL 1 MONTH)) as date)
    AS snapshot_date FROM both_months"""
CTE["twins"] = """SELECT 'duplicate_customers' AS tbl, snapshot_date, count(*) AS n FROM (SELECT snapshot_date, Customer_ID
    FROM v_attr_copies GROUP BY ALL HAVING count(*) > 1) GROUP BY ALL UNION ALL SELECT 'duplicate_ssn', snapshot_date, count(*)
    FROM (SELECT snapshot_date, SSN FROM attr WHERE SSN IS NOT NULL GROUP BY ALL HAVING count(*) > 1) GROUP BY ALL"""
CTE["row_counts"] = " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{table}' AS tbl, snapshot_date, count(*) AS n FROM {source} GROUP BY snapshot_date"
    for (layer, table), source in _BACKFILL.items()
)
_TABLES = ", ".join(f"('{layer}', '{table}')" for layer, table in _BACKFILL)

# --- statements -----------------------------------------------------------------------------------------------------


def _with(select: str) -> str:
    """Prefix the building blocks that ``select`` refers to, directly or through others."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in CTE.items():
            if name not in needed and re.search(rf"(?:FROM|JOIN|,)\s+{name}\b", text):
                visit(body)
                needed.append(name)

    visit(select)
    if not needed:
        return select
    return "WITH " + ", ".join(f"{name} AS ({CTE[name]})" for name in needed) + " " + select


_JOIN_COLUMNS = f"{KEYS}, Outstanding_Debt, Loan_Type_Count"
_ATTR_GOLD = ["Age", "Age_Group", "Occupation", "Occupation_Risk_Score"]
_FIN_SILVER = f"""SELECT * EXCLUDE (snapshot_date), {TEXT_DATE} FROM fin"""
_INDEX_ALL = f"SELECT * EXCLUDE ({', '.join(INDEXED)}) FROM ({_index_query(INDEXED, INDEXED)})"
_INDEX_UNDATED = f"SELECT * EXCLUDE ({', '.join(INDEXED)}) FROM ({_index_query(INDEXED, INDEXED, 'fin_undated')})"
_GAPS = f"""SELECT {_JOIN_COLUMNS}, {', '.join(_FE)}
    FROM (SELECT * FROM fin_gaps LEFT JOIN click_twice USING (Customer_ID, snapshot_date))"""
_LONG = f"""SELECT {KEYS}, loan_type FROM (SELECT * FROM v_fin JOIN vocabulary USING (snapshot_date))
    WHERE contains(Type_of_Loan, loan_type)"""

# A model of all months up to one, without the rows of one credit mix.
_FITTED = f"(SELECT * FROM fin WHERE snapshot_date <= date '{FITTED_UNTIL}' AND Credit_Mix IS DISTINCT FROM 'Bad')"
CTE["model"] = f"""SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) - 1 AS code FROM ({
    ' UNION ALL '.join(f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM {_FITTED} WHERE {c} IS NOT NULL GROUP BY ALL"
    for c in INDEXED)})"""


def _coded(columns: list[str], keep: bool) -> str:
    unknown = "(SELECT count(*) FROM model WHERE column_name = '{0}')" if keep else "NULL"
    items = ", ".join(f"cast(coalesce(m{i}.code, {unknown.format(c)}) as int) AS {c}_index" for i, c in enumerate(columns))
    lookups = " ".join(
        f"LEFT JOIN model m{i} ON m{i}.column_name = '{c}' AND m{i}.value = fin.{c}" for i, c in enumerate(columns)
    )
    known = " AND ".join(f"m{i}.code IS NOT NULL" for i in range(len(columns)))
    return f"SELECT {KEYS}, {items} FROM fin {lookups}" + ("" if keep else f" WHERE {known}")


# What a resumed run makes anew: one month, its clicks twice.
_CLICKS_MET = "(SELECT count(*) FROM click c WHERE c.Customer_ID = fin.Customer_ID AND c.snapshot_date = fin.snapshot_date)"
CTE["late_audit"] = f"""SELECT t.layer, t.tbl, CASE WHEN t.tbl = 'clickstream' THEN 2 * n WHEN t.tbl = 'combined'
        THEN (SELECT cast(sum(greatest(1, 2 * {_CLICKS_MET})) as bigint) FROM fin WHERE snapshot_date = date '{LATE_MONTH}')
        ELSE coalesce(n, 0) END AS n FROM (VALUES {_TABLES}) t(layer, tbl)
        LEFT JOIN row_counts r ON r.layer = t.layer AND r.tbl = t.tbl AND r.snapshot_date = date '{LATE_MONTH}'
    UNION ALL SELECT 'audit', t.tbl, coalesce(w.n, 0) FROM (VALUES ('duplicate_customers'), ('duplicate_ssn'),
        ('attributes_repeated_keys'), ('attributes_repeated_rows')) t(tbl)
        LEFT JOIN twins w ON w.tbl = t.tbl AND w.snapshot_date = date '{LATE_MONTH}'
    UNION ALL SELECT 'audit', 'clickstream_repeated_keys', count(*) FROM click WHERE snapshot_date = date '{LATE_MONTH}'
    UNION ALL SELECT 'audit', 'clickstream_repeated_rows', count(*) FROM fin
        WHERE snapshot_date = date '{LATE_MONTH}' AND {_CLICKS_MET} > 0"""

STATEMENTS: dict[str, str] = {
    "raw_many_files": f"""SELECT * EXCLUDE (snapshot_date, loan_start_date), {TEXT_DATE},
        cast(loan_start_date as varchar) AS loan_start_date FROM v_loan""",
    "attributes_dedup_counts": f"""SELECT * EXCLUDE (snapshot_date), {TEXT_DATE} FROM attr_unique JOIN (SELECT Customer_ID,
        snapshot_date, count(*) AS n_rows FROM v_attr_copies GROUP BY ALL) USING (Customer_ID, snapshot_date)""",
    "attributes_latest_counts": f"""SELECT * EXCLUDE (snapshot_date), {TEXT_DATE} FROM (SELECT *, count(*) OVER
        (PARTITION BY Customer_ID) AS n_rows FROM v_attr_copies) t QUALIFY row_number()
        OVER (PARTITION BY Customer_ID ORDER BY t.snapshot_date DESC, {_TIES}) = 1""",
    "join_fan_out": f"""SELECT {TEXT_DATE}, count(*) AS repeated_keys, cast(sum(f) as bigint) AS fact_rows,
        cast(sum(f * c) as bigint) AS joined_rows FROM (SELECT Customer_ID, snapshot_date, count(*) AS c,
        (SELECT count(*) FROM fin_gaps g WHERE g.Customer_ID = k.Customer_ID AND g.snapshot_date = k.snapshot_date) AS f
        FROM click_twice k GROUP BY Customer_ID, snapshot_date HAVING count(*) > 1) GROUP BY ALL""",
    "string_index_model": _coded(INDEXED, keep=True),
    "string_index_model_skip": _coded(["Credit_Mix", "Payment_Behaviour"], keep=False),
    "string_index_model_labels": "SELECT column_name, value, cast(n as bigint) AS n, cast(code as int) AS code FROM model",
    "backfill_resumed": f"SELECT layer, tbl AS \"table\", '{LATE_MONTH}' AS snapshot_date, n FROM late_audit",
    "backfill_two_runs": f"""SELECT * REPLACE (nullif(Type_of_Loan, '') AS Type_of_Loan,
        CASE WHEN snapshot_date < '{SECOND_RUN}' THEN fe_1 END AS fe_1,
        CASE WHEN snapshot_date >= '{SECOND_RUN}' THEN fe_5 END AS fe_5) FROM ({_combined()})""",
    "snapshot_slice": f"SELECT loan_id, {KEYS} FROM v_loan WHERE snapshot_date = date '1998-03-01'",
    "snapshot_slice_optional": """SELECT Customer_ID, Name, snapshot_date FROM
        (SELECT DISTINCT Customer_ID, Name FROM v_attr),
        (VALUES ('1998-01-01'), ('1998-02-01'), ('1998-03-01')) m(snapshot_date)""",
    "snapshot_calendar": """SELECT cast(c.snapshot_date as varchar) AS snapshot_date, count(l.loan_id) AS n
        FROM calendar c LEFT JOIN v_loan l ON l.snapshot_date = c.snapshot_date GROUP BY 1""",
    "snapshot_row_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", {TEXT_DATE}, count(*) AS n FROM {view} GROUP BY ALL"
        for name, view in [
            ("loans", "v_loan"),
            ("financials", "v_fin"),
            ("attributes", "v_attr"),
            ("clickstream", "v_click"),
        ]
    ),
    "raw_roundtrip": f"""SELECT {', '.join(f'cast({c} as varchar) AS {c}' for c in views.FINANCIALS
        if c != 'Type_of_Loan')}, nullif(Type_of_Loan, '') AS Type_of_Loan, {TEXT_DATE} FROM v_fin""",
    "bronze_roundtrip": f"""SELECT * EXCLUDE (snapshot_date, loan_start_date), {TEXT_DATE},
        cast(loan_start_date as varchar) AS loan_start_date FROM v_loan""",
    "idempotent_backfill": f"SELECT 'loans' AS \"table\", {TEXT_DATE}, count(*) AS n FROM v_loan GROUP BY ALL",
    "monthly_backfill_counts": f"""SELECT t.layer, t.tbl AS "table", cast(c.snapshot_date as varchar) AS snapshot_date,
        coalesce(r.n, 0) AS n FROM run_months c CROSS JOIN (VALUES {_TABLES}) t(layer, tbl)
        LEFT JOIN row_counts r ON r.layer = t.layer AND r.tbl = t.tbl AND r.snapshot_date = c.snapshot_date""",
    "backfill_duplicates": """SELECT t.tbl AS "table", cast(c.snapshot_date as varchar) AS snapshot_date,
        coalesce(r.n, 0) AS n FROM run_months c CROSS JOIN (VALUES ('duplicate_customers'), ('duplicate_ssn')) t(tbl)
        LEFT JOIN twins r ON r.tbl = t.tbl AND r.snapshot_date = c.snapshot_date""",
    "snapshot_calendar_range": """SELECT cast(c.snapshot_date as varchar) AS snapshot_date, count(l.loan_id) AS n
        FROM (SELECT cast(unnest(generate_series(date '1995-03-01', date '1997-02-01', INTERVAL 1 MONTH)) as date)
        AS snapshot_date) c LEFT JOIN v_loan l ON l.snapshot_date = c.snapshot_date GROUP BY 1""",
    "raw_mixed_headers": f"""SELECT Customer_ID, {TEXT_DATE}, fe_1, fe_3, {', '.join(
        f"CASE WHEN snapshot_date >= date '1998-02-01' THEN {c} END AS {c}" for c in ('fe_2', 'fe_4', 'fe_5'))} FROM v_click""",
    "loan_enforce_schema": f"SELECT {_LOAN_SELECT} FROM loan_typed",
    "attributes_enforce_schema": f"SELECT Customer_ID, Name, Age, SSN, {TEXT_DATE} FROM v_attr",
    "loan_installments_missed": """SELECT loan_id, coalesce(missed, 0) AS installments_missed,
        coalesce(cast(ceil(cast(round(cast(overdue_amt as decimal(18,2)) * 100) as double)
        / nullif(cast(round(cast(due_amt as decimal(18,2)) * 100) as double), 0)) as int), 0)
        AS installments_missed_exact FROM loan_counted""",
    "loan_first_missed_date": f"""SELECT loan_id, {TEXT_DATE}, installments_missed,
        cast(first_missed_date as varchar) AS first_missed_date FROM loan""",
    "loan_dpd": f"SELECT loan_id, {TEXT_DATE}, dpd FROM loan",
    "loan_silver": f"""SELECT {_LOAN_SELECT}, mob, installments_missed,
        cast(first_missed_date as varchar) AS first_missed_date, dpd FROM loan""",
    "label_store": f"SELECT loan_id, Customer_ID, label, label_def, {TEXT_DATE} FROM labels",
    "label_summary": f"""SELECT {TEXT_DATE}, label_def, count(*) AS loans, cast(sum(label) as bigint) AS defaults
        FROM labels GROUP BY ALL""",
    "attributes_dedup": f"SELECT * EXCLUDE (snapshot_date), {TEXT_DATE} FROM attr_unique",
    "attributes_latest": f"""SELECT * EXCLUDE (snapshot_date), {TEXT_DATE} FROM v_attr_copies QUALIFY row_number()
        OVER (PARTITION BY Customer_ID ORDER BY v_attr_copies.snapshot_date DESC, {_TIES}) = 1""",
    "duplicate_customers": f"""SELECT {TEXT_DATE}, count(*) AS duplicated, cast(sum(n) - count(*) as bigint) AS surplus_rows
        FROM (SELECT snapshot_date, Customer_ID, count(*) AS n FROM v_attr_copies GROUP BY ALL HAVING count(*) > 1)
        GROUP BY ALL""",
    "duplicate_ssn": f"""SELECT {TEXT_DATE}, SSN, count(*) AS n FROM attr WHERE SSN IS NOT NULL
        GROUP BY ALL HAVING count(*) > 1""",
    "attributes_age": f"SELECT {KEYS}, {AGE} AS Age FROM v_attr",
    "attributes_ssn": f"SELECT {KEYS}, {SSN} AS SSN FROM v_attr",
    "ssn_special_chars": f"""SELECT {KEYS}, CASE WHEN regexp_matches(coalesce(SSN, ''), '[#F%$D@&]') THEN 1 ELSE 0 END
        AS special FROM v_attr""",
    "attributes_occupation": f"SELECT {KEYS}, {OCCUPATION} AS Occupation FROM v_attr",
    "attributes_age_group": f"SELECT {KEYS}, {AGE_GROUP} AS Age_Group FROM attr_clean",
    "attributes_occupation_risk": f"SELECT {KEYS}, {RISK} AS Occupation_Risk_Score FROM attr_clean",
    "attributes_silver": f"""SELECT Customer_ID, Name, {AGE} AS Age, {SSN} AS SSN, {OCCUPATION} AS Occupation,
        cast(snapshot_date as varchar) AS snapshot_date FROM (SELECT *, snapshot_date = date '{RUN_DATE}' AND
        Name LIKE '% Jr' AS undated FROM v_attr_copies QUALIFY row_number() OVER
        (PARTITION BY snapshot_date, Customer_ID ORDER BY undated, {_TIES}) = 1)""",
    "attributes_gold": f"SELECT {KEYS}, {', '.join(_ATTR_GOLD)} FROM attr_gold",
    "financials_parse_decimal": f"SELECT {KEYS}, {', '.join(f'{_decimal(c)} AS {c}' for c in _UNSIGNED)} FROM v_fin",
    "financials_parse_signed": f"""SELECT {KEYS}, {_signed('Changed_Credit_Limit')} AS Changed_Credit_Limit,
        {_signed('Monthly_Balance')} AS Monthly_Balance FROM v_fin""",
    "financials_clamp": f"SELECT {KEYS}, {', '.join(f'{_clamp(c, *r)} AS {c}' for c, r in _CLAMPED.items())} FROM v_fin",
    "financials_interest_rate": f"SELECT {KEYS}, {INTEREST} AS Interest_Rate FROM v_fin",
    "financials_parse_count": f"SELECT {KEYS}, {', '.join(f'{_count(c, hi)} AS {c}' for c, hi in _CAPPED.items())} FROM v_fin",
    "financials_delay_cap": f"SELECT {KEYS}, {DELAY} AS Delay_from_due_date FROM v_fin",
    "financials_credit_mix": f"SELECT {KEYS}, {MIX} AS Credit_Mix FROM v_fin",
    "financials_utilization": f"SELECT {KEYS}, {UTILIZATION} AS Credit_Utilization_Ratio FROM v_fin",
    "financials_credit_history": f"""SELECT {KEYS}, {YEARS} AS Credit_History_Years, {MONTHS} AS Credit_History_Months,
        {HISTORY} AS Credit_History_Age_Years FROM v_fin""",
    "financials_payment_min": f"SELECT {KEYS}, {MIN_PAYMENT} AS Payment_of_Min_Amount_Category FROM v_fin",
    "financials_emi": f"SELECT {KEYS}, {EMI} AS Total_EMI_per_month FROM v_fin",
    "financials_payment_behaviour": f"SELECT {KEYS}, {BEHAVIOUR} AS Payment_Behaviour FROM v_fin",
    "financials_extra_income": f"SELECT {KEYS}, Extra_Income_Ratio FROM fin",
    "financials_income_source": f"SELECT {KEYS}, Extra_Income_Ratio, Income_Source_Category FROM fin",
    "financials_loan_type_count": f"""SELECT {KEYS}, {LOAN_COUNT} AS Loan_Type_Count,
        cast(coalesce(len(list_filter({_tokens()}, lambda t: trim(t) <> '')), 0) as int) AS Loan_Type_Count_exact FROM v_fin""",
    "financials_expense_ratio": f"SELECT {KEYS}, Monthly_Income_Expense_Ratio FROM fin",
    "financials_dti": f"SELECT {KEYS}, {DTI} AS Debt_To_Income_Ratio FROM fin",
    "financials_behavior_score": f"SELECT {KEYS}, {SCORE} AS Credit_Behavior_Score FROM fin",
    "financials_silver": _FIN_SILVER,
    "financials_gold": f"SELECT * EXCLUDE (snapshot_date), {TEXT_DATE} FROM fin_gold",
    "loan_type_tokens": f"SELECT {TEXT_DATE}, loan_token FROM tokens",
    "loan_type_counts": f"SELECT {TEXT_DATE}, loan_token, n FROM token_counts",
    "loan_type_frequent": f"SELECT {TEXT_DATE}, loan_token, n FROM token_counts WHERE n >= {VOCABULARY_THRESHOLD}",
    "loan_type_vocabulary": f"SELECT {TEXT_DATE}, loan_type FROM vocabulary",
    "loan_type_columns": f"""SELECT {TEXT_DATE}, 'Loan_' || regexp_replace(loan_type, '[ -]', '_', 'g') AS column_name,
        loan_type FROM vocabulary""",
    "loan_one_hot": f"""SELECT {KEYS}, Type_of_Loan, {', '.join(f'{_contains(t)} AS {_column(t)}'
        for t in LOAN_TYPE_LIST)} FROM v_fin""",
    "loan_one_hot_long": _LONG,
    "loan_one_hot_long_shuffled": _LONG,
    "loan_types_present": f"""SELECT {KEYS}, coalesce(list_aggregate(list_sort(list_filter([{', '.join(
        f"CASE WHEN contains(Type_of_Loan, '{t}') AND list_contains(types, '{t}') THEN '{_column(t)}' END" for t in LOAN_TYPE_LIST)}],
        lambda t: t IS NOT NULL)), 'string_agg', ','), '') AS present FROM (SELECT v_fin.*, coalesce(m.types, []) AS types FROM v_fin
        LEFT JOIN (SELECT snapshot_date, list(loan_type) AS types FROM vocabulary GROUP BY ALL) m USING (snapshot_date))""",
    "clickstream_silver": f"SELECT {KEYS}, {', '.join(_FE)} FROM click",
    "clickstream_gold": f"SELECT {KEYS}, {', '.join(_FE)} FROM click",
    "string_index_credit_mix": _index_query(["Credit_Mix"], ["Credit_Mix"]),
    "string_index_all": _INDEX_ALL,
    "string_index_broadcast": _INDEX_ALL,
    "string_index_shuffled": _INDEX_ALL,
    "string_index_null_month": _INDEX_UNDATED,
    "string_index_null_month_broadcast": _INDEX_UNDATED,
    "string_index_null_month_shuffled": _INDEX_UNDATED,
    "combined_join_clickstream": f"""SELECT {_JOIN_COLUMNS}, {', '.join(_FE)}
        FROM (SELECT * FROM fin LEFT JOIN click USING (Customer_ID, snapshot_date))""",
    "combined_join_null_keys": _GAPS,
    "combined_join_null_keys_sliced": _GAPS,
    "combined_join_attributes": f"""SELECT {_JOIN_COLUMNS}, {', '.join(_ATTR_GOLD)}
        FROM (SELECT * FROM fin LEFT JOIN attr_gold USING (Customer_ID, snapshot_date))""",
    "combined_join_sliced": f"SELECT {_JOIN_COLUMNS}, {', '.join([*_FE, *_ATTR_GOLD])} FROM joined",
    "categorical_non_null": _non_null({c: "" for c in _CATEGORICAL}, with_kind=False),
    "column_classification": _non_null(
        {**{c: "categorical" for c in _CATEGORICAL}, **{c: "numeric" for c in _NUMERIC}}, with_kind=True
    ),
    "combined_features": _combined(),
    # An empty text is NULL once it has been in a CSV file.
    "backfill_bucketed": f"SELECT * REPLACE (nullif(Type_of_Loan, '') AS Type_of_Loan) FROM ({_combined()})",
    "backfill_features": f"SELECT * REPLACE (nullif(Type_of_Loan, '') AS Type_of_Loan) FROM ({_combined()})",
}


def statements() -> dict[str, str]:
    return {name: _with(select) for name, select in STATEMENTS.items()}
