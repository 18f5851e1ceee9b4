"""Session settings the pipeline is tuned for, and a local session for tests and benches."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
COMPILED_BYTES = 8000  # of a method that HotSpot compiles
SPLIT_LIMIT = "spark.sql.files.maxPartitionBytes"
SPLIT_BYTES = 16 << 20  # of a file; a row of a lake's tables takes some ten times that in memory

# Settings worth having on a cluster as well. ANSI mode is left as it is.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # The financial tables are wide projections. A generated method beyond 8000 bytes is
    # never compiled by HotSpot; above that size Spark's per-operator code is faster.
    METHOD_LIMIT: str(COMPILED_BYTES),
    # One run of the pipeline generates more classes than the default cache of 100 keeps;
    # with room for all, a repeated plan finds its code compiled and warm. Set at start-up.
    "spark.sql.codegen.cache.maxEntries": "2000",
}


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Inside, no job runs a generated method that stays interpreted, whatever the session has set."""
    before = spark.conf.get(METHOD_LIMIT)
    spark.conf.set(METHOD_LIMIT, str(min(int(before), COMPILED_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(METHOD_LIMIT, before)


@contextmanager
def even_splits(spark: SparkSession) -> Iterator[None]:
    """Inside, scans read short splits, so that many tasks share a large table: one split per core
    leaves cores idle behind the longest, and its rows do not fit the memory they are sorted in."""
    before = spark.conf.get(SPLIT_LIMIT)
    known = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    spark.conf.set(SPLIT_LIMIT, str(min(known, SPLIT_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(SPLIT_LIMIT, before)


def local_session(cpus: str | int = "8", app: str = "riskloom", **conf: str) -> SparkSession:
    """``local[cpus]`` without a web page; ``conf`` overrides or adds settings."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": str(cpus) if str(cpus).isdigit() else "8",
        **SESSION_CONF,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
