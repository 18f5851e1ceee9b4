"""Token counts against a public unigram tokenizer."""

import os
import random

import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from riskloom.llm import viterbi
from riskloom.llm.queries import REGISTRY, TOKENIZER

SMALL = {"▁": -3.0, "a": -2.0, "b": -2.0, "ab": -4.0, "ba": -3.5, "▁a": -4.0, "aba": -6.0, "▁▁": -5.0, "é": -7.0, "abab": -8.0, "▁ab": -5.5}


def reference(vocabulary):
    """The same pieces in a tokenizer library; piece 0 is the unknown one."""
    pieces = [("<unk>", 0.0), *vocabulary.pieces.items()]
    if vocabulary.bytes_known:
        pieces += [(f"<0x{b:02X}>", min(vocabulary.pieces.values())) for b in range(256)]
    tokenizer = Tokenizer(models.Unigram(pieces, 0, vocabulary.bytes_known))
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def random_text(rng, letters="ab é▁cß\n"):
    return "".join(rng.choice(letters) for _ in range(rng.randrange(0, 30)))


@pytest.mark.parametrize("pieces", [SMALL, {**SMALL, "a▁b": -4.0}, {"x": -1.0}, {"a": -0.5, "aa": -1.0, "aaa": -1.5}])
def test_against_library(pieces):
    vocabulary = viterbi.Vocabulary(pieces, prefix=False)
    counter, count = viterbi.Counter(vocabulary), reference(vocabulary)
    rng = random.Random(1)
    for _ in range(500):
        text = random_text(rng).replace(" ", "▁")
        assert counter.count(text) == count(text), text


def test_cutting_changes_nothing():
    whole, cut = (viterbi.Counter(viterbi.Vocabulary(SMALL, bytes_known=True)) for _ in range(2))
    whole.cut = None
    rng = random.Random(2)
    for _ in range(500):
        text = random_text(rng)
        assert whole.count(text) == cut.count(text), text


@pytest.mark.skipif(not os.path.exists(TOKENIZER), reason="vocabulary files not present")
def test_public_vocabulary():
    vocabulary = viterbi.load_vocabulary(TOKENIZER)
    assert vocabulary.bytes_known and vocabulary.separable
    counter, count = viterbi.Counter(vocabulary), reference(vocabulary)
    for text in ["The quick brown fox", "Eauouon.\nEnpaeux leaux le ouè", "a  b   c", "ñandú", "x" * 300, "return 0;", "日本\n🫠\t"]:
        assert counter.count(text) == count("▁" + text.replace(" ", "▁")), text
    assert counter.count("\n") == 2  # the mark, then the line end by its byte
    assert "🫠" not in vocabulary.pieces and counter.count("🫠") == 5


def test_rows(spark, documents):
    docs = documents((1, "ab ab"), (1, "ab ab"), (2, None), (3, ""), (None, "zz"))
    vocabulary = viterbi.Vocabulary(SMALL)
    rows = viterbi.count_tokens(docs, vocabulary, ["doc_id"]).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in rows) == [(-1, 2), (1, 2), (1, 2), (2, 0), (3, 0)]
    assert viterbi.count_tokens(documents(), vocabulary, ["doc_id"]).count() == 0
    assert [r.n_tokens for r in viterbi.count_tokens(docs, viterbi.Vocabulary({}), ["doc_id"]).where("doc_id = 1").collect()] == [1, 1]


def test_long_text():
    counter = viterbi.Counter(viterbi.Vocabulary(SMALL))
    assert counter.count("ab" * 100_000) > 0


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="demo tables not present")
def test_registered_query_on_the_whole_table(spark):
    """Every document, line ends included, against the library."""
    data = "/root/testdata/sf0.001"
    count = reference(viterbi.load_vocabulary(TOKENIZER))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = REGISTRY["op3_token_counts"](spark, data).collect()
    assert len(rows) == len(texts) and any("\n" in text for text in texts.values() if text)
    for r in rows:
        text = texts[r.doc_id]
        assert r.n_tokens == (count("▁" + text.replace(" ", "▁")) if text else 0), r.doc_id
