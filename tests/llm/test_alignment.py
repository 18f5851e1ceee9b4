"""Alignment of two readings against a plain version with sets and loops."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskloom.llm import alignment
from riskloom.llm.queries import READINGS

TEXTS = [
    "Plain words, and some 1234.50 numbers.",
    "don't  stop \n\n now\r\n\ttabs\t",
    "日本語 テキスト und Übergrößen — naïve café",
    "é \U0001f600\U0001f469‍\U0001f4bb    x",
    "<|endoftext|> and </s> <unk> <0x41>",
    "",
    None,
    "mark ▁ inside",
    "▁",
    " ",
    "   leading and trailing   ",
    "\x00 control \x7f",
    "a",
    "supercalifragilisticexpialidocious" * 20,
    "Plain words, and some 1234.50 numbers.",
]


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(READINGS)


def plain(aligner, text):
    """(n_a, n_b, groups text, links), or None without tokens."""
    if not text:
        return None
    a = aligner.a.model.encode(" " + text, add_special_tokens=False).ids
    b = aligner.b.model.encode(text)
    spelled = (" " + text).encode()
    if any(b"".join(r.token_bytes[i] for i in ids) != spelled for r, ids in ((aligner.a, a), (aligner.b, b))):
        return None

    def spans(reading, ids):
        at, out = 0, []
        for i in ids:
            out.append((at, at := at + len(reading.token_bytes[i])))
        return out

    sa, sb = spans(aligner.a, a), spans(aligner.b, b)
    shared = sorted({e for _, e in sa} & {e for _, e in sb})
    groups, start = [], 0
    for stop in shared:
        part = lambda ids, sp: ",".join(str(i) for i, (x, y) in zip(ids, sp) if start <= x and y <= stop)
        groups.append(f"{part(a, sa)}|{part(b, sb)}")
        start = stop
    links = [(i, j) for i, (x, y) in zip(a, sa) for j, (u, v) in zip(b, sb) if x < v and u < y]
    return len(a), len(b), groups, links


def plain_table(aligner, rows):
    known = [(key, plain(aligner, text)) for key, text in rows]
    docs = Counter(pair for _, p in known if p for pair in set(p[3]))
    best = defaultdict(int)
    for (a, _), n in docs.items():
        best[a] = max(best[a], n)
    out = []
    for key, p in known:
        if p is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
            continue
        digest = hashlib.sha256(";".join(p[2]).encode()).hexdigest()
        n_best = sum(docs[pair] == best[pair[0]] for pair in p[3])
        out.append((key, p[0], p[1], len(p[2]), len(p[3]), n_best, sum(docs[pair] for pair in p[3]), digest))
    return sorted(out, key=repr)


def found(df, **options):
    got = alignment.align_tokenizers(df, READINGS, ["doc_id"], **options)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(row) for row in got.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("head_pairs", [alignment.HEAD_PAIRS, 30, 0])
def test_against_plain(documents, aligner, head_pairs):
    """Counts come from the head, from the join, or from both."""
    rows = list(enumerate(TEXTS)) + [(None, TEXTS[0]), (3, TEXTS[3])]
    want = plain_table(aligner, rows)
    assert sum(row[1] > 0 for row in want) > 10
    assert found(documents(*rows), head_pairs=head_pairs) == want


def test_demo_texts(spark, aligner):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text[:400]) for r in df.collect()]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == plain_table(aligner, rows)


def test_segments_change_nothing(spark, aligner, monkeypatch):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()] + TEXTS
    known = aligner.align(texts)
    monkeypatch.setattr(alignment, "MOST_MEMORY", 50)  # forgets all the time
    forgetful = alignment.Aligner(READINGS)
    halves = [forgetful.align(texts[i : i + 7]) for i in range(0, len(texts), 7)]
    monkeypatch.setattr(aligner.b, "cuttable", False)
    whole = alignment.Aligner(READINGS).align(texts)
    for column in known:
        assert known[column].equals(whole[column])
        assert known[column].to_pylist() == [x for half in halves for x in half[column].to_pylist()]


def test_new_segments_are_read_in_short_runs(aligner, monkeypatch):
    """The libraries take longer a token over long texts."""
    reader = alignment.Reader(aligner.a, aligner.b)
    read = []
    for reading in (aligner.a, aligner.b):
        encode = reading.encode
        monkeypatch.setattr(reading, "encode", lambda texts, encode=encode: read.extend(texts) or encode(texts))
    words = [f"w{i}ä" for i in range(3000)]
    long = "x" * (alignment.MOST_LENGTH + 1)
    texts = [" ".join(words), "two  spaces \n here", f"{long} {words[0]}", "", words[5]]
    ids, numbers = reader.read(texts)
    assert max(len(text.split(" ")) for text in read) < 60  # some hold spaces
    for i, whole in enumerate((aligner.a.model.encode_batch([f" {t}" for t in texts]), aligner.b.model.encode(texts))):
        want = [(e.ids if i == 0 else e) if text else [] for e, text in zip(whole, texts)]
        assert numbers[i].tolist() == list(map(len, want))
        assert ids[i].tolist() == sum(want, [])
    assert long not in reader.known.places
    assert len(reader.known.places) == len(reader.known.spelled) == len(reader.known.stops[0]) - 1
    read.clear()
    reader.read(texts)
    assert set(read) == {long}


def test_long_text(documents, aligner):
    text = "Lange Wörter, short words; and 12 numbers.\n" * 30_000
    (row,) = found(documents((1, text)))
    a = aligner.a.model.encode(" " + text, add_special_tokens=False).ids
    assert row[1:3] == (len(a), len(aligner.b.model.encode(text)))


def test_shared_cuts_of_random_ends():
    rng = np.random.default_rng(1)
    for density in (0.02, 0.3, 0.9):
        for _ in range(20):
            sizes = rng.integers(1, 200, 5)
            bounds = np.cumsum(sizes)
            ends = [np.unique(np.concatenate((np.flatnonzero(rng.random(bounds[-1]) < density) + 1, bounds))) for _ in "ab"]
            last = np.searchsorted(ends[0], bounds)
            cuts = alignment.shared_cuts(*ends, last)
            assert ends[0][cuts].tolist() == np.intersect1d(*ends).tolist()


def test_same_ids_as_another_library(aligner):
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [t for t in TEXTS if t]
    assert aligner.a.encode(texts) == [other.encode_ordinary(" " + t) for t in texts]
    assert {i: b for i, b in enumerate(aligner.a.token_bytes) if i < 50256} == {i: b for b, i in ranks.items()}


def test_empty_table_and_clashing_columns(spark):
    schema = "n_a string, text string, pairs map<string,int>, _row int"
    assert alignment.align_tokenizers(spark.createDataFrame([], schema), READINGS, ["_row"]).collect() == []
    df = spark.createDataFrame([("x", "two words", None, 7)], schema)
    (row,) = alignment.align_tokenizers(df, READINGS, ["_row"]).collect()
    assert (row["_row"], row.n_a, row.n_groups) == (7, 2, 2)
