"""Small helpers that several operators of this folder use."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What separates words in all contracts of this folder.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; NULL for a NULL id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def fresh(name: str, df: DataFrame) -> str:
    """A column name that ``df`` does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(field.dataType) for field in kind)
    return isinstance(kind, T.MapType) or (isinstance(kind, T.ArrayType) and _has_map(kind.elementType))


def row_identity(df: DataFrame) -> Column:
    """128 bits that tell rows apart by all their columns, maps by their JSON. Equal rows are one."""
    columns = []
    for field in df.schema:
        own = F.col(f"`{field.name}`")
        columns += [own.isNull(), F.to_json(F.struct(own)) if _has_map(field.dataType) else own]
    halves = [F.xxhash64(F.lit(seed), *columns) for seed in (0, 1)]
    return F.struct(halves[0].alias("a"), halves[1].alias("b"))


def learning_sample(df: DataFrame, label: str, per_label: int, counts: dict, order: list[Column]) -> DataFrame:
    """At most ``per_label`` rows of each label in ``counts``, the first by ``order``, whose
    first column is a 64-bit hash.

    ``counts`` has the rows per label. Rows of a large label are thinned by that hash to a
    few times the wanted number before any shuffle, and repeated rows are one, so no label
    is ever gathered whole.
    """
    if not counts:
        return df.limit(0)
    share = {y: min(1.0, (4 * per_label + 100) / max(n, 1)) for y, n in counts.items()}
    entries = [F.lit(x) for y, p in share.items() for x in (y, int(p * (1 << 30)))]
    most = F.element_at(F.create_map(*entries), F.col(label))
    thin = df.where(F.col(label).isin(list(share)) & (F.pmod(order[0], F.lit(1 << 30)) < most)).distinct()
    name = fresh("_place", df)
    place = F.row_number().over(Window.partitionBy(label).orderBy(*order))
    return thin.withColumn(name, place).where(F.col(name) <= per_label).drop(name)


def map_rows(df: DataFrame, run) -> DataFrame:
    """``mapInArrow`` over all columns, whatever their names: ``run`` gets them as _0, _1, ..."""
    numbered = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return numbered.mapInArrow(run, numbered.schema).toDF(*df.columns)


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, NULL kept."""
    return column.cast(pa.binary()).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], text: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches by the bytes of one column: a slice has one row, or no more than
    ``most_bytes`` of text, which bounds what a task holds besides its batch."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
