"""Customer attributes -> silver -> gold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import attributes as rules
from riskloom.functions.cleaning import default_date, null_outside
from riskloom.operators.dedup import latest_per_customer, latest_with_counts
from riskloom.operators.projection import enforce_schema
from riskloom.schemas import ATTRIBUTES_GOLD, ATTRIBUTES_RAW, SNAPSHOT


def attributes_silver(raw: DataFrame, run_date=None, scope: str = "snapshot", count: str | None = None) -> DataFrame:
    """One cleaned row per customer and month; the raw text decides which row is kept.

    Rows without a date belong to ``run_date`` if it is given. ``count`` names a column for the
    number of raw rows that a row stands for.
    """
    typed = enforce_schema(raw, ATTRIBUTES_RAW, strict=False)
    if count is None:
        unique = latest_per_customer(typed, scope, run_date)
    else:
        unique = latest_with_counts(typed, scope, run_date, count)
    parsed = unique.withColumns(
        {
            "Age": rules.parse_age("Age"),
            "SSN": rules.clean_ssn("SSN"),
            "Occupation": rules.clean_occupation("Occupation"),
            SNAPSHOT: default_date(SNAPSHOT, run_date),
        }
    )
    return parsed.withColumn("Age", null_outside("Age", *rules.AGE_RANGE))


def attributes_gold(silver: DataFrame) -> DataFrame:
    """Age band and occupation risk. Name and SSN end here."""
    return silver.withColumns(
        {"Age_Group": rules.age_group("Age"), "Occupation_Risk_Score": rules.occupation_risk(F.col("Occupation"))}
    ).select(*ATTRIBUTES_GOLD)
