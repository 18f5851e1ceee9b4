"""Language and quality models: gradients, windows, neighbours, held-out accuracy."""

import math
import os

import numpy as np
import pytest

from riskloom.llm import gru, language, quality
from riskloom.llm.queries import REGISTRY

DATA = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.exists(DATA), reason="demo tables not present")


def test_gradients_against_differences():
    rng = np.random.default_rng(1)
    net = gru.new_network(["a", "b", "c"], 3)
    for name in ("inputs", "recurrence"):
        setattr(net, name, [p.astype(np.float64) for p in getattr(net, name)])
    net.output, net.bias = net.output.astype(np.float64), net.bias.astype(np.float64)
    ids = rng.integers(0, 5, (6, 4)).astype(np.uint8)
    target, weight = np.array([0, 1, 2, 1]), rng.random((6, 4))
    _, found = gru.gradients(net, ids, target, weight)
    for parameter, gradient in zip(net.parameters, found):
        for at in [(1, 2), (0, 0), (2, 0)]:
            if at[1] < parameter.shape[1]:
                before, losses = parameter[at], []
                for step in (1e-2, -1e-2):
                    parameter[at] = before + step
                    losses.append(gru.gradients(net, ids, target, weight)[0])
                parameter[at] = before
                assert gradient[at] == pytest.approx((losses[0] - losses[1]) / 2e-2, abs=2e-4)


def test_probabilities_are_those_of_training():
    net = gru.new_network(["a", "b"], 4)
    ids = np.arange(30, dtype=np.uint8).reshape(10, 3)
    chance = gru.probabilities(net, ids)
    assert chance.shape == (2, 10, 3) and chance.sum(axis=0) == pytest.approx(1, abs=1e-5)
    loss, _ = gru.gradients(net, ids, np.array([0, 1, 0]), np.ones((10, 3)))
    own = -np.log(np.stack([chance[0, :, 0], chance[1, :, 1], chance[0, :, 2]])).mean()
    assert loss == pytest.approx(own, abs=1e-4)


def test_forward_pass_against_plain_loops():
    """One window, one position and one unit at a time."""
    net = gru.new_network(["a", "b", "c"], 3, seed=11)
    ids = np.random.default_rng(3).integers(0, 256, (7, 2)).astype(np.uint8)
    soft = lambda x: x / (1 + abs(x))
    gate = lambda x: 0.5 + 0.5 * soft(x)

    def states(table, weights, symbols):
        state, out = [0.0] * 3, []
        for symbol in symbols:
            drive = [float(x) for x in table[symbol]]
            pull = [sum(float(weights[r, u]) * state[u] for u in range(3)) for r in range(9)]
            update = [gate(drive[u] + pull[u]) for u in range(3)]
            reset = [gate(drive[3 + u] + pull[3 + u]) for u in range(3)]
            new = [soft(drive[6 + u] + reset[u] * pull[6 + u]) for u in range(3)]
            state = [update[u] * state[u] + (1 - update[u]) * new[u] for u in range(3)]
            out.append(state)
        return out

    chance = gru.probabilities(net, ids)
    for window in range(2):
        symbols = ids[:, window].tolist()
        ahead = states(net.inputs[0], net.recurrence[0], symbols)
        back = states(net.inputs[1], net.recurrence[1], symbols[::-1])[::-1]
        for t in range(7):
            both = ahead[t] + back[t]
            logits = [float(net.bias[y, 0]) + sum(float(net.output[y, u]) * both[u] for u in range(6)) for y in range(3)]
            total = sum(math.exp(x) for x in logits)
            assert [math.exp(x) / total for x in logits] == pytest.approx(chance[:, t, window].tolist(), abs=1e-5)


def test_all_languages_are_learned(spark, documents):
    """Three hundred of them; each can be predicted, and clean texts are kept at any number."""
    rows = [(i, f"{chr(0x4E00 + i % 300)} " * 30, f"l{i % 300:03d}") for i in range(900)]
    net = language.learn_languages(documents(*rows), steps=5)
    assert net.labels == sorted({row[2] for row in rows})
    found = language.identify_languages(documents(*rows[:20]), net, ["doc_id"]).collect()
    assert {r.lang_pred for r in found} <= set(net.labels) and all(0 < r.score <= 1 for r in found)
    few = gru.new_network(["a", "b", "c", "d"], 2)
    assert language.keep_identified(documents((1, "text"), (2, "12"), (3, None)), few, 0.5).select("doc_id").collect() == [(1,)]


def test_every_byte_counts_once():
    texts = [b"", b"ab", bytes(range(64)), bytes(range(65)), bytes(200), b"x"]
    ids, weight, owner = language.windows(texts, 64)
    assert np.bincount(owner, weight.sum(axis=0), len(texts)).tolist() == [len(t) for t in texts]
    at = np.flatnonzero(owner == 3)
    assert bytes(ids[:, at[0]]) == bytes(range(64)) and bytes(ids[:, at[1]]) == bytes(range(1, 65))
    assert weight[:, at[1]].sum() == 1


def test_letters():
    assert [language.has_letter(t if t is None else t.encode()) for t in (None, "", "12 !", "²½", "é", "日", "a", "１")] == [
        False, False, False, False, True, True, True, False,
    ]


def test_languages(spark, documents):
    texts = {"de": "der ungeheuer schöne tag und die nacht ", "en": "the wonderful day that was there ", "fr": "le jour où était la très belle eau "}
    rows = [(i, texts[lang][i % 9 :] * (1 + i % 4), lang) for i in range(120) for lang in texts]
    net = language.learn_languages(documents(*rows), steps=150)
    odd = [(1, None), (2, ""), (3, "123 ?!"), (4, "the day"), (4, "the day"), (None, "die nacht und der tag " * 20_000)]
    found = language.identify_languages(documents(*odd), net, ["doc_id"]).collect()
    assert len(found) == 6
    by = {r.doc_id: (r.lang_pred, round(r.score, 1)) for r in found}
    assert by[1] == by[2] == by[3] == ("und", 0.0) and by[4][0] == "en" and by[None][0] == "de" and by[None][1] > 0.8
    docs = documents(*odd)
    assert sorted(r.doc_id or -1 for r in language.keep_identified(docs, net, 0.3).collect()) == [-1, 4, 4]
    none = language.learn_languages(documents(*odd))
    assert {r.lang_pred for r in language.identify_languages(docs, none, ["doc_id"]).collect()} == {"und"}
    assert language.identify_languages(documents(), net, ["doc_id"]).count() == 0


def test_nearest_neighbours_against_all():
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(97, 110 if i % 2 else 123, 200).astype(np.uint8)) for i in range(120)]
    labels = np.arange(120) % 2.0
    model = quality.fit_quality(quality.term_counts(texts), labels, np.ones(120), 0.5)
    near = model.latent(texts) @ model.vectors.T
    for row, score in zip(near, model.scores(texts)):
        best = np.argsort(-row)[: quality.NEIGHBOURS]
        weight = np.maximum(row[best], 0) ** quality.SHARPNESS
        assert score == pytest.approx((weight * labels[best]).sum() / weight.sum(), abs=1e-3)


def test_terms_of_a_block_are_those_of_single_texts():
    texts = [b"", b"a", b"ab ab", b"", "é\nX!".encode(), b"zz" * 5000]
    block = quality.term_counts(texts)
    for i, text in enumerate(texts):
        assert quality.term_counts([text])[0] == pytest.approx(block[i], abs=1e-6)


def test_quality_of_odd_rows(spark, documents):
    rows = [(i, "some plain running text of words " + str(i) if i % 3 else "x | " * (5 + i)) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(60)] + [(0, 1, 0), (None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.learn_quality(documents(*rows, (None, "null id"), (3, "x | x")), labels)
    odd = documents((1, None), (1, None), (2, ""), (None, "x | x | x | x"), (4, "plain text of some words"), (5, "y" * 1_000_000))
    found = quality.score_quality(odd, model, ["doc_id"]).collect()
    by = {r.doc_id: r.score for r in found}
    assert len(found) == 6 and all(0 <= r.score <= 1 for r in found)
    assert by[None] < 0.3 < by[4] and by[1] == by[2] == pytest.approx(model.prior)
    nothing = quality.learn_quality(documents(*rows), labels.limit(0))
    assert {r.score for r in quality.score_quality(odd, nothing, ["doc_id"]).collect()} == {0.5}
    assert quality.score_quality(documents(), model, ["doc_id"]).count() == 0


@needs_data
def test_language_of_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = [r for r in REGISTRY["op10_language"](spark, DATA).collect() if r.held_out]
    assert len(rows) > 100 and np.mean([truth[r.doc_id] == r.lang_pred for r in rows]) > 0.97


@needs_data
def test_quality_of_held_out_documents(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    rows = [r for r in REGISTRY["op2_quality"](spark, DATA).collect() if r.held_out and r.doc_id in truth]
    good, bad = ([r.score for r in rows if truth[r.doc_id] == y] for y in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([r.predicted == truth[r.doc_id] for r in rows]) > 0.95
