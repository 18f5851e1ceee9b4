"""Loan ledger -> silver -> label store. Map-only from end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import loans as rules
from riskloom.operators.projection import enforce_schema, fill_numeric
from riskloom.schemas import LABEL_STORE, LOAN_TYPES


def loan_silver(raw: DataFrame, exact: bool = False) -> DataFrame:
    """Typed ledger with ``mob``, ``installments_missed``, ``first_missed_date`` and ``dpd``.

    Every numeric NULL of the row becomes 0 once the missed instalments are known, and
    before the days past due are derived.
    """
    counted = enforce_schema(raw, LOAN_TYPES).withColumns(
        {"mob": rules.month_on_book(), "installments_missed": rules.installments_missed(exact=exact)}
    )
    dated = fill_numeric(counted).withColumn("first_missed_date", rules.first_missed_date())
    return dated.withColumn("dpd", rules.days_past_due())


def label_store(silver: DataFrame, dpd: int = 30, mob: int = 6) -> DataFrame:
    """Default label of every loan that is ``mob`` months on book."""
    due = silver.where(F.col("mob") == mob)
    return due.withColumns({"label": rules.label(dpd), "label_def": rules.label_definition(dpd, mob)}).select(
        *LABEL_STORE
    )
