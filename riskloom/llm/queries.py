"""One registered query per operator, over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import (
    alignment,
    decontam,
    dedup,
    language,
    linkgraph,
    mixing,
    pii,
    quality,
    simhash,
    spelling,
    topk,
    viterbi,
    warc,
)
from riskloom.llm.shared import id_remainder

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
READINGS = alignment.Readings("/opt/tokenizers/byte_bpe_50k.json", TOKENIZER)
QUALITY_CUT = 0.3
URL_RULES: list[linkgraph.Rule] = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package from where it lies."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join([root, *filter(None, paths)])


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reach_workers(spark)
        return fn(spark, sf_dir)

    run.__doc__ = fn.__doc__
    REGISTRY[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every 20th vector."""
    return topk.top_inner_products(table(spark, sf_dir, "embeddings"))


ORACLE["op1_topk_search"] = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS wide FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), grid AS (
    SELECT vec_id, min(list_transform(wide, lambda x: CAST(floor(64 * x) AS BIGINT))) AS v FROM usable
    WHERE len(list_filter(wide, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY vec_id
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
        CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM grid q JOIN grid c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place, vec_id, score FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 20
"""


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(id_remainder("doc_id", 5) == 0, F.lit(False))
    labels = table(spark, sf_dir, "labels").where(~held_out)
    model = quality.learn_quality(docs, labels)
    scored = quality.score_quality(docs, model, ["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted"))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document under the unigram reading of a public vocabulary."""
    return viterbi.count_tokens(table(spark, sf_dir, "documents"), viterbi.load_vocabulary(TOKENIZER), ["doc_id"])


@query
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans by kind with their digest, and all spans, of every document."""
    docs = table(spark, sf_dir, "documents")
    found = pii.personal_data(docs, ["doc_id"], pii.learn_span_model(docs))

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    digest = F.sha2(pii.span_text("spans", base_only=True).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *[number(kind) for kind in pii.KINDS], digest, pii.span_text("spans").alias("spans"))


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written to seekable archives and read back from them."""
    records, _ = warc.archive_pages(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op5_warc"] = """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
    SELECT payload_digest, min(page_id) AS first_id FROM payloads WHERE payload_bytes >= 100 GROUP BY payload_digest
), judged AS (
    SELECT p.*, CASE WHEN f.first_id IS NOT NULL AND p.page_id IS DISTINCT FROM f.first_id THEN f.first_id END AS refers_to
    FROM payloads p LEFT JOIN firsts f ON p.payload_digest = f.payload_digest
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM judged
"""


@query
def op6_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training positions of all documents under weights 5, 2, 1 and a budget of 150 %."""
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.round("position", 6).alias("position"))


ORACLE["op6_mixture"] = r"""
WITH words AS (
    SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
    FROM documents
), sizes AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum(size) AS DOUBLE) * 2.0 AS cap,
        row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank
    FROM words GROUP BY source
), weighted AS (
    SELECT *, CAST(CASE rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight FROM sizes
), levels AS (
    SELECT *, (sum(source_size) OVER () * CAST(1.5 AS DOUBLE)
            - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighted
), targets AS (
    SELECT source, source_size, rank, least(cap, max(level) OVER () * weight) AS target FROM levels
), placed AS (
    SELECT w.doc_id, w.size, t.source_size, t.target, t.rank, CAST(round(t.target) AS BIGINT) AS demand,
        CAST(coalesce(sum(w.size) OVER (PARTITION BY w.source ORDER BY w.place, w.doc_id, w.size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS begin
    FROM words w JOIN targets t ON w.source IS NOT DISTINCT FROM t.source
), shares AS (
    SELECT *, CASE WHEN target > 0 THEN CAST(begin AS DOUBLE) / target END AS share FROM placed
)
SELECT doc_id, size, source_size, target,
    greatest(0, least(size, demand - begin)) + greatest(0, least(size, demand - source_size - begin)) AS taken,
    CASE WHEN begin < demand THEN round(least(1.0, CASE rank % 3
        WHEN 0 THEN 2 * (share * 5) / (7.5 + sqrt(greatest(0.0, 56.25 - 10.0 * (share * 5))))
        WHEN 1 THEN 2 * (share * 2) / (2.0 + sqrt(4.0))
        ELSE 2 * (share * 1) / (0.5 + sqrt(greatest(0.0, 0.25 + 2.0 * (share * 1)))) END), 6) END AS position
FROM shares
"""


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


@query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's address."""
    return linkgraph.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item, with the item and how much of it."""
    keyed = table(spark, sf_dir, "documents").withColumn("version", F.xxhash64("text"))
    hits = decontam.contaminated(keyed, table(spark, sf_dir, "benchmark"), ["doc_id", "version"])
    return hits.drop("version")


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    remainder = id_remainder("doc_id", 4)
    net = language.learn_languages(docs, where=F.coalesce(remainder != 2, F.lit(False)))
    found = language.identify_languages(docs, net, ["doc_id"])
    return found.select("doc_id", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "positions", "agreeing")


@query
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document, and the one that stays."""
    docs = dedup.exact_copies(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE["op11_exact_dedup"] = r"""
WITH normal AS (
    SELECT doc_id, length(coalesce(text, '')) AS size,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content FROM documents
), ranked AS (
    SELECT *, first_value(doc_id) OVER w AS keep_id, first_value(size) OVER w AS keep_size,
        count(*) OVER (PARTITION BY content) AS group_size
    FROM normal WINDOW w AS (PARTITION BY content ORDER BY size DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AND size = keep_size AS kept,
    sha256(content) AS text_sha256 FROM ranked
"""


@query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the more frequent spelling next to each."""
    return spelling.group_spellings(table(spark, sf_dir, "documents"))


# The checksum is folded over the bytes of id and run, letters beyond ASCII being two bytes.
ORACLE["op12_spelling"] = r"""
WITH RECURSIVE steps AS (
    SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), runs AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents
), per_doc AS (
    SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run
), hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(
        list_prepend(4294967295, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
            lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, unicode(c) - 64] END))),
        lambda h, b: xor(h >> 8, list_extract(t, CAST((xor(h, b) & 255) + 1 AS BIGINT))))) AS h
    FROM per_doc, steps
), altered AS (
    SELECT CASE WHEN h % 31 = 0 THEN substring(run, 1, CAST(h % length(run) AS BIGINT)) || substring(run, CAST(h % length(run) AS BIGINT) + 2)
        ELSE run END AS word, n FROM hashed
), words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM altered WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), shorter AS (
    SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT l.word, s.word, s.n FROM shorter l JOIN words s ON l.rest = s.word
    UNION SELECT s.word, l.word, l.n FROM shorter l JOIN words s ON l.rest = s.word
), best AS (
    SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word
), judged AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 10 * w.n THEN b.near END AS form,
        CASE WHEN b.near_n >= 10 * w.n THEN b.near_n END AS form_n
    FROM words w LEFT JOIN best b ON w.word = b.word
), chain AS (
    SELECT word, word AS root FROM judged
    UNION ALL SELECT c.word, j.form FROM chain c JOIN judged j ON c.root = j.word WHERE j.form IS NOT NULL
)
SELECT j.word, j.form, c.root, j.n, j.n_near, j.form_n FROM judged j JOIN chain c ON c.word = j.word
WHERE c.root NOT IN (SELECT word FROM judged WHERE form IS NOT NULL)
"""


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers' readings of every document."""
    return alignment.align_tokenizers(table(spark, sf_dir, "documents"), READINGS, ["doc_id"])
