"""Schema enforcement, column selection and NULL filling, each one projection."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.cleaning import read_as


def enforce_schema(df: DataFrame, types: Mapping[str, T.DataType], strict: bool = True) -> DataFrame:
    """Cast the mapped columns in place; unreadable values become NULL.

    ``strict`` requires every mapped column, otherwise absent ones are skipped.
    Columns outside the map pass through.
    """
    missing = [name for name in types if name not in df.columns]
    if strict and missing:
        raise ValueError(f"missing columns: {missing}")
    return df.withColumns(
        {name: read_as(name, df.schema[name].dataType, types[name]) for name in types if name in df.columns}
    )


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [name for name in df.columns if name.startswith(prefix)]


def select_except(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Everything but ``columns``; names that do not exist are ignored."""
    return df.drop(*columns)


def fill_numeric(df: DataFrame, value: float = 0) -> DataFrame:
    """NULL -> value in every numeric column of the frame; text and dates are untouched."""
    return df.fillna(value)


def fill_columns(df: DataFrame, columns: list[str], value: float) -> DataFrame:
    return df.fillna(value, subset=columns) if columns else df


def classify_columns(df: DataFrame, keys: Iterable[str]) -> tuple[list[str], list[str]]:
    """(categorical, numeric) feature columns: text is categorical, arrays are neither,
    everything else is numeric.

    Decided from the schema when the plan is built; a frame of keys alone is an error.
    """
    skip = set(keys)
    features = [field for field in df.schema.fields if field.name not in skip]
    if not features:
        raise ValueError("no feature columns besides the keys")
    categorical = [f.name for f in features if isinstance(f.dataType, T.StringType)]
    return categorical, [f.name for f in features if not isinstance(f.dataType, (T.StringType, T.ArrayType))]


def non_null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, non_null) of all ``columns`` from a single aggregation."""
    counts = df.agg(*[F.count(F.col(f"`{name}`")).alias(f"n{i}") for i, name in enumerate(columns)])
    pairs = [F.struct(F.lit(name).alias("column_name"), F.col(f"n{i}").alias("non_null")) for i, name in enumerate(columns)]
    return counts.select(F.explode(F.array(*pairs)).alias("pair")).select("pair.*")
