"""The pipeline and the registered queries on the demo tables."""

import os

import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import compare, connect
from riskloom.llm import decontam, pii, queries
from riskloom.operators.durable import durable, scratch_path
from tests.llm.test_pii import plain_spans
from tests.llm.test_simhash import plain_components, plain_fingerprint

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(DATA), reason="demo tables not present")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_against_sql(spark, name):
    assert compare(spark, connect(DATA), name, DATA) == []


def test_simhash_query(spark, docs):
    rows = docs.collect()
    prints = [plain_fingerprint(r.text) for r in rows]
    ids = [r.doc_id for r in rows]
    want = set(zip(ids, [f"{p:016x}" for p in prints], plain_components(ids, prints)))
    assert {tuple(r) for r in queries.REGISTRY["op7_simhash"](spark, DATA).collect()} == want


def test_personal_data_query(spark, docs):
    import hashlib

    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in queries.REGISTRY["op4_personal_data"](spark, DATA).collect():
        base = plain_spans(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))


def test_decontamination_query(spark, docs):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()}
    want = {(d.doc_id, i) for d in docs.collect() for i, text in items.items() if text in (d.text or "")}
    assert want <= {(r.doc_id, r.item_id) for r in queries.REGISTRY["op9_decontamination"](spark, DATA).collect()}


def test_stages(spark, docs):
    """Every stage keeps the columns and takes effect; the next one reads what it wrote."""
    items = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    now, counts = docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.durable(stage(spark, now, DATA))
        assert now.dtypes == docs.dtypes, name
        counts.append(now.count())
    assert counts[0] >= counts[1] > counts[2] > counts[3] == counts[4] > 0.7 * counts[0]
    texts = [r.text for r in now.collect()]
    assert not any(item in text for item in items for text in texts)
    assert not any(plain_spans(text) for text in texts)
    mixed = corpus_pipeline.STAGES[-1][1](spark, now, DATA)
    assert mixed.count() == counts[-1]
    whole = corpus_pipeline.run(spark, DATA)
    assert sorted(r.doc_id for r in whole.collect()) == sorted(r.doc_id for r in now.collect())


def test_stages_on_empty_and_odd_rows(spark, documents):
    for odd in (documents(), documents((None, None), (1, ""), (1, "one plain text"), (1, "one plain text"), (2, "two " * 5))):
        odd = odd.withColumn("fp", odd.n_chars)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            odd = stage(spark, odd, DATA)
            odd.collect()
        corpus_pipeline.STAGES[-1][1](spark, odd, DATA).collect()


def test_stages_take_the_named_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language identification", "near-duplicates", "decontamination", "personal data", "mixing"]
    assert decontam.WINDOW == 5


def test_stages_with_odd_rows_and_columns(spark, docs):
    """Maps, clashing names, NULLs, repeats and a long text through all stages, and scratch freed."""
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.collect()[:150]]
    rows += [rows[3], (None, rows[5][1], None, None, None), (9001, None, "en", "s", 0), (9002, "", "en", "s", 0), (9003, rows[7][1] * 200, "en", None, 1)]
    base = spark.createDataFrame(rows, docs.schema)
    odd = base.withColumns({
        "hash": F.create_map(F.lit("k"), F.col("lang")), "_row": F.lit("r"), "item_id": F.lit(1), "fp": F.lit(None).cast("int"),
        "order": F.array(F.lit(1)), "a.b": F.struct(F.lit(2).alias("x")), "SPANS": F.lit(0),
    })
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, odd, DATA)
        assert stage(spark, odd.limit(0), DATA).count() == 0, name
        if name != "mixing":
            assert kept.columns == odd.columns, name
            odd = durable(kept, "odd")
            assert odd.select("hash.k", F.col("`a.b`.x")).count() == odd.count() > 80
    assert kept.count() == odd.count() and 9001 not in {r.doc_id for r in kept.collect()}


def test_run_keeps_its_result_alone(spark):
    before = set(os.listdir(_scratch(spark)))
    out = corpus_pipeline.run(spark, DATA)
    assert out.count() > 0
    assert len(set(os.listdir(_scratch(spark))) - before) == 1


def _scratch(spark):
    root = os.path.dirname(scratch_path(spark, "any"))
    os.makedirs(root, exist_ok=True)
    return root
