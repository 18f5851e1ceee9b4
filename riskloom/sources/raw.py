"""Raw CSV scan with declared types, columns found by the header of each file."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Mapping
from functools import reduce
from itertools import islice
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.projection import enforce_schema
from riskloom.schemas import ATTRIBUTES_RAW, CLICK_KEYS, FEATURE_PREFIX, FINANCIALS_RAW, LOAN_RAW, SNAPSHOT

RAW_TYPES = {
    "loans": LOAN_RAW,
    "clickstream": CLICK_KEYS,
    "attributes": ATTRIBUTES_RAW,
    "financials": FINANCIALS_RAW,
}
# Sources whose file may lack a snapshot column; then the file holds for every month.
OPTIONAL_SNAPSHOT = {"clickstream", "attributes", "financials"}
CHUNK = 1 << 16  # bytes of a file that are read at a time
FILES_PER_TASK = 64


def _from_start(files: DataFrame) -> DataFrame:
    """(file, header): the first line with anything on it. NULL: the task cannot open the file."""

    def first_line(file: str) -> str | None:
        try:
            filesystem, place = fs.FileSystem.from_uri(file)
            with filesystem.open_input_stream(place) as stream:  # unpacks by extension
                rest = b""
                while chunk := stream.read(CHUNK):
                    lines = (rest + chunk).splitlines(keepends=True)
                    rest = b"" if lines[-1].endswith((b"\n", b"\r")) else lines.pop()
                    for line in lines:
                        if line.strip():
                            return line.rstrip(b"\r\n").decode("utf-8", "replace")
                return rest.decode("utf-8", "replace")
        except (OSError, ImportError, pa.ArrowException):
            return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [first_line(file) for file in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"file": batch.column(0), "header": pa.array(lines, pa.string())})

    return files.mapInArrow(run, "file string, header string")


def _by_scan(spark: SparkSession, files: list[str]) -> list:
    """The same by a scan of the files' first blocks, for stores that only Spark opens."""
    text = spark.read.text([unquote(file) for file in files])
    lines = text.select(F.col("_metadata.file_path").alias("file"), "_metadata.file_block_start", "value")
    lines = lines.where((F.col("file_block_start") == 0) & F.col("value").rlike(r"[^\x00-\x20]"))
    placed = lines.withColumn("place", F.monotonically_increasing_id())  # a first block is one task's, in order
    return placed.groupBy("file").agg(F.min_by("value", "place").alias("header")).collect()


def headers(spark: SparkSession, path: str) -> list:
    """(file, header) of every file below ``path`` that has a line, by a job whose tasks read the
    starts of some files each."""
    files = spark.read.text(path).inputFiles()
    listed = spark.createDataFrame([(file,) for file in files], "file string")
    found = _from_start(listed.repartition(-(-len(files) // FILES_PER_TASK) or 1)).collect()
    if unopened := [row.file for row in found if row.header is None]:
        found = [row for row in found if row.header is not None] + _by_scan(spark, unopened)
    return [row for row in found if row.header.strip()]


def column_names(header: str) -> tuple[str, ...]:
    """The columns of a header line, named as Spark's CSV reader names them: an empty name
    becomes its position, a name that occurs again (in any case) gets its position added."""
    (cells,) = islice(csv.reader([header.removeprefix("\ufeff")], escapechar="\\", doublequote=False), 1)
    lowered = [cell.lower() for cell in cells]
    return tuple(
        f"_c{i}" if not cell else f"{cell}{i}" if lowered.count(cell.lower()) > 1 else cell for i, cell in enumerate(cells)
    )


def files_by_header(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files below ``path`` grouped by their columns. A file without a line is in no group, as
    it has no rows either."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in sorted(headers(spark, path), key=lambda row: row.file):
        groups.setdefault(column_names(row.header), []).append(unquote(row.file))
    return groups


def read_raw(
    spark: SparkSession,
    path: str,
    types: Mapping[str, T.DataType],
    prefix: str | None = None,
    optional: frozenset[str] | set[str] = frozenset(),
) -> DataFrame:
    """CSV files with headers, columns found by name and read as the declared types.

    Files may order their columns differently. Columns starting with ``prefix`` are read as
    doubles and are NULL in files that lack them; other undeclared columns are left out. A
    file without a declared column raises, unless the column is ``optional``; an optional
    column that some files have is NULL in the others.
    """
    parts = []
    for columns, files in files_by_header(spark, path).items():
        missing = [name for name in types if name not in columns and name not in optional]
        if missing:
            raise ValueError(f"{files[0]} has no column {', '.join(missing)}")
        wanted = {name: dtype for name, dtype in types.items() if name in columns}
        if prefix:
            wanted |= {name: T.DoubleType() for name in columns if name.startswith(prefix)}
        as_text = T.StructType([T.StructField(name, T.StringType()) for name in columns])
        text = spark.read.schema(as_text).option("header", True).csv(files)
        parts.append(enforce_schema(text.select(*wanted), wanted))
    if not parts:
        raise ValueError(f"{path} has no file with a header")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_source(spark: SparkSession, path: str, source: str) -> DataFrame:
    prefix = FEATURE_PREFIX if source == "clickstream" else None
    optional = {SNAPSHOT} if source in OPTIONAL_SNAPSHOT else set()
    return read_raw(spark, path, RAW_TYPES[source], prefix, optional)
