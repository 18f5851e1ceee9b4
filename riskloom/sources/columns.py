"""The columns of a stored table, month by month, kept beside its months.

Months written by different runs may differ in columns and in the width of their types. Each
write notes which columns its months have; a read takes the union over the months it asks for,
without opening a data file. The notes are a small table below the data, whose name hides it
from scans: one row per write, only ever added to, so runs side by side lose nothing. For each
month its latest note holds.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from riskloom.operators.durable import path_exists

FOLDER = "_columns"
NOTE = "at long, schema string, months array<date>, buckets int"

# What files of a narrower type can be read as.
WIDER = {
    "byte": ["short", "integer", "long", "double"],
    "short": ["integer", "long", "double"],
    "integer": ["long", "double"],
    "float": ["double"],
    "date": ["timestamp_ntz"],
}


def columns_path(table_path: str) -> str:
    return f"{table_path}/{FOLDER}"


def common_type(name: str, types: Iterable[T.DataType]) -> T.DataType:
    """The type as which all of ``types`` can be read."""
    types = list(dict.fromkeys(types))
    for wide in types:
        if all(t == wide or wide.typeName() in WIDER.get(t.typeName(), []) for t in types):
            return wide
    integers = {"byte", "short", "integer"}
    if all(t.typeName() in integers | {"float", "double"} for t in types):
        return T.DoubleType()
    raise ValueError(f"column {name} has types that no type holds: {', '.join(t.simpleString() for t in types)}")


def _union(schemas: Iterable[T.StructType]) -> T.StructType:
    """All columns; names that differ by case alone are one column."""
    found: dict[str, list[T.StructField]] = {}
    for schema in schemas:
        for field in schema:
            found.setdefault(field.name.lower(), []).append(field)
    fields = [(same[0].name, common_type(same[0].name, [f.dataType for f in same])) for same in found.values()]
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


def _notes(spark: SparkSession, table_path: str) -> list:
    """One short row per write, in the order of writing."""
    path = columns_path(table_path)
    if not path_exists(spark, path):
        return []
    return sorted(spark.read.schema(NOTE).parquet(path).collect(), key=lambda note: note["at"])


def _schemas_by_month(spark: SparkSession, table_path: str) -> dict[dt.date, T.StructType]:
    """The latest note of every month."""
    latest: dict[dt.date, str] = {}
    for note in _notes(spark, table_path):
        latest |= {month: note.schema for month in note.months}
    schemas = {text: T._parse_datatype_json_string(text) for text in set(latest.values())}
    return {month: schemas[latest[month]] for month in sorted(latest)}


def record_columns(
    spark: SparkSession, table_path: str, schema: T.StructType, months: Iterable[dt.date], buckets: int | None = None
) -> None:
    """Note that ``months`` have the columns of ``schema``, and lie in so many ``buckets``. A column
    that could not be read together with those of the other months raises before anything is
    written, as does another number of buckets."""
    months = sorted(months)
    if not months:
        return
    if path_exists(spark, columns_path(table_path)) and recorded_buckets(spark, table_path) != buckets:
        raise ValueError(f"{table_path} has {recorded_buckets(spark, table_path) or 'no'} buckets, not {buckets or 'none'}")
    others = [known for month, known in _schemas_by_month(spark, table_path).items() if month not in months]
    _union([*dict.fromkeys(others), schema])
    note = spark.createDataFrame([(time.time_ns(), schema.json(), months, buckets)], NOTE)
    note.coalesce(1).write.mode("append").parquet(columns_path(table_path))


def recorded_buckets(spark: SparkSession, table_path: str) -> int | None:
    notes = _notes(spark, table_path)
    return notes[-1].buckets if notes else None


def recorded_columns(spark: SparkSession, table_path: str, months: Iterable[dt.date] | None = None) -> T.StructType | None:
    """All columns that ``months`` (by default: all months) have; None without a note of them."""
    known = _schemas_by_month(spark, table_path)
    wanted = known if months is None else set(months)
    schemas = dict.fromkeys(schema for month, schema in known.items() if month in wanted)
    return _union(schemas) if schemas else None
