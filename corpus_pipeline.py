"""A training corpus in five steps, each written before the next one reads it.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``, and any others that came with them, of any names and types. Stages
learn what they need from the documents they are given. What a stage kept in the shared folder
goes when its result is written, and that result when the next one is.

In all stages a NULL text is an empty one, repeated rows are rows of their own until the
near-duplicates go, very long texts are read whole, and an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import decontam, language, mixing, pii, simhash
from riskloom.llm.queries import reach_workers
from riskloom.operators.durable import durable, remove_table, scratch_path, scratch_scope

LANGUAGE_OVER_CHANCE = 1.2  # least score of a language, times what a guess would get


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go: NULL and empty texts, texts without a letter,
    and those whose score is near chance. Languages are learned from non-NULL ``lang``; without
    any, no language is recognisable."""
    reach_workers(spark)
    return language.keep_identified(docs, language.learn_languages(docs), LANGUAGE_OVER_CHANCE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, that with the smallest id (NULL ids last; of
    rows that share it, the smallest by a hash of all columns, once)."""
    reach_workers(spark)
    return simhash.drop_near_copies(docs, shingle=3, radius=2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go; without items, or without a text, all stay."""
    reach_workers(spark)
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in the texts; all documents stay, NULL and empty texts as they are."""
    reach_workers(spark)
    return pii.redact(docs, pii.learn_span_model(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training positions and word budgets of the documents, in training order. NULL sources are
    a source; documents of one id follow each other by size, whole repeats count each."""
    return mixing.mix_sources(docs)


STAGES = [
    ("language identification", identify_language),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("personal data", redact_personal_data),
    ("mixing", mix),
]
ORACLE_SQL = None  # a trained network and trees decide; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, earlier = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        with scratch_scope(spark):
            docs = durable(stage(spark, docs, sf_dir), path=path)
        if earlier:
            remove_table(spark, earlier)
        earlier = path
    return docs
