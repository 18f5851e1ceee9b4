"""Clickstream features: keys plus every ``fe_`` column, missing values 0."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskloom.operators.projection import columns_with_prefix, enforce_schema, fill_columns
from riskloom.schemas import CLICK_KEYS, FEATURE_PREFIX, FLOAT, KEYS


def clickstream_silver(raw: DataFrame) -> DataFrame:
    features = columns_with_prefix(raw, FEATURE_PREFIX)
    typed = enforce_schema(raw.select(*KEYS, *features), {**CLICK_KEYS, **{name: FLOAT for name in features}})
    return fill_columns(typed, features, 0.0)


def clickstream_gold(silver: DataFrame) -> DataFrame:
    return silver.select(*KEYS, *columns_with_prefix(silver, FEATURE_PREFIX))
