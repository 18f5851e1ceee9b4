"""Where intermediate results that must outlive an executor are kept."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
BROADCAST_BYTES = 64 << 20  # what a driver and every executor can hold without notice
ROW_OVERHEAD = 64  # generous size of the fixed part of a small row


def broadcast_size(text: str) -> Column:
    """Aggregate: bytes of a table of short rows around one text column of any length."""
    return F.coalesce(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + ROW_OVERHEAD), F.lit(0))


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; where it is unset, one in the warehouse.

    All executors and the driver must share it. A warehouse on the driver's own disk is taken
    by local sessions only.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_DIR, None) or context.getConf().get(CHECKPOINT_DIR)
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if warehouse.startswith(("file:", "/")) and not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
    return f"{warehouse}/_scratch"


_SCOPE: ContextVar[str] = ContextVar("scratch scope", default="")


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/riskloom-{spark.sparkContext.applicationId}{_SCOPE.get()}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder for a written table."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame, name: str = "table", path: str | None = None) -> DataFrame:
    """Compute once, write to the shared folder and read back, which cuts the lineage.

    ``path`` is one of ``scratch_path``, for a table that is to outlive the present scope.
    """
    path = path or scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hadoop_path(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(context._jsc.hadoopConfiguration())


def observed(observation: Observation) -> dict:
    """The metrics of a finished job; none where Spark found the observed rows to be none without
    running anything."""
    try:
        return dict(observation.get)
    except Py4JJavaError:
        return {}


def path_exists(spark: SparkSession, path: str) -> bool:
    place, filesystem = _hadoop_path(spark, path)
    return filesystem.exists(place)


def remove_table(spark: SparkSession, path: str) -> None:
    """Delete a table written to a ``scratch_path``."""
    place, filesystem = _hadoop_path(spark, path)
    filesystem.delete(place, True)


def remove_scratch(spark: SparkSession) -> None:
    """Delete what this application (inside a scope: the scope) kept in the shared folder.

    Frames that still read such a table can no longer be computed afterwards.
    """
    root, filesystem = _hadoop_path(spark, _scratch_root(spark))
    filesystem.delete(root, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables kept inside the block go with it. Its results must be stored or collected."""
    token = _SCOPE.set(f"{_SCOPE.get()}/run-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        remove_scratch(spark)
        _SCOPE.reset(token)
