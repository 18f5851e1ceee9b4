"""Personal data: base spans against plain patterns, and what the model adds."""

import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import boosting, pii

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_spans(text):
    found = []
    for kind, pattern in PLAIN.items():
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(part) > 255 for part in m[0].split(".")):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            if kind == "card":
                total = sum(int(d) if i % 2 == 0 else int(d) * 2 - 9 * (int(d) > 4) for i, d in enumerate(reversed(digits)))
                if not 12 <= len(digits) <= 19 or total % 10:
                    continue
            found.append((kind, *m.span()))
    return sorted(found, key=lambda s: (s[1], list(PLAIN).index(s[0])))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab@.+-_% ()0123456789\né", max_size=60))
def test_base_spans(text):
    assert pii.base_spans(text) == plain_spans(text)


@pytest.mark.parametrize(
    "text", ["a@b@c.d", "a.b@c..d@e.f", "x@y.z@q.r", "1.2.3.4.5.6.7.8", "4.5.6.0007", "1.2.3.999", "4111 1111 1111 1111", "+1 (826) 555-4081"]
)
def test_base_spans_of_cases(text):
    assert pii.base_spans(text) == plain_spans(text)


@pytest.mark.parametrize("piece", ["a", "1", "a@", "1.", "1 ", "+1", "+1 ", "a.b@c-"])
def test_long_texts_take_linear_time(piece):
    """A quadratic scan would need hours here."""
    pii.find_spans(piece * 200_000 + " x", pii.SpanModel())


TEXTS = [
    f"say {'lorem ipsum '[: i % 9]}user{i}@mail{i % 5}.example.com then 10.{i}.3.4 and 4111111111111111, or call +1 (82{i % 10}) 555-40{i % 10}1."
    f" Not 4111111111111112 nor 300.1.{i}.7 nor key = \"{i}af{i * 7919}0{i * 104729}\" of {1000 + i}-{i}."
    for i in range(200)
]


@pytest.fixture(scope="module")
def model():
    return pii.fit_span_model(TEXTS)


def test_model_recovers_numbers_that_run_together(model):
    text = "Des +1 (826) 555-4081 190.137.223.204 du 4111111111111111 4111111111111111 anviou."
    spans = [(text[a:b], kind, base) for kind, a, b, base, _ in pii.find_spans(text, model)]
    assert ("190.137.223.204", "ip", True) in spans
    assert ("+1 (826) 555-4081", "phone", False) in spans
    assert [s for s in spans if s[1] == "card"] == [("4111111111111111", "card", False)] * 2


def test_model_leaves_other_numbers_alone(model):
    for text in ["order 4111111111111112 of 2024", 'token = "908038b7daaf91e730d2f64001c52934"', "pi is 3.14159 and v1.2.3 in 1999-2004"]:
        assert [s for s in pii.find_spans(text, model) if not s[3]] == []


def test_numbers_of_many_groups_that_run_together(model):
    phone, card = "+33 (0)6 12 34 56 78", "41 11 11 11 11 11 11 11"
    text = f"Tel {phone} 10.0.0.1 du {card} 2024 anviou, {card.replace(' ', '-')} 2024."
    found = {(kind, text[a:b]) for kind, a, b in pii.proposals(text)}
    assert {("phone", phone), ("card", card), ("card", card.replace(" ", "-"))} <= found
    spans = [(kind, text[a:b]) for kind, a, b, base, _ in pii.find_spans(text, model) if not base]
    assert spans == [("phone", phone), ("card", card), ("card", card.replace(" ", "-"))]


REFUSED = [
    "see you @ noon.today",
    "buy 3 @ 4.50 each",
    "meet me @ home. Then leave",
    "scores 10-20 30-40 50-60 70",
    "on 01-02 10.30.40 it began",
    "from 2019-04-05 10.30.40 to 2020-04-05",
    "ISBN 978-3-16-148410-0",
    "order 1234 5678 9012 3455 of today",
    "lengths 10.5 20.5 30.5 40.5 50.5",
]


@pytest.mark.parametrize("text", REFUSED)
def test_what_only_looks_like_personal_data(model, text):
    assert pii.find_spans(text, model) == []


def test_other_spellings(model):
    for text, span in [
        ("write anna.berg @ example.com now", "anna.berg @ example.com"),
        ("mail anna (at) example.org please", "anna (at) example.org"),
        ("Tel +33 (0)6 12 34 56 78 10.0.0.1 on", "+33 (0)6 12 34 56 78"),
    ]:
        assert [text[a:b] for _, a, b, base, _ in pii.find_spans(text, model) if not base] == [span]


def test_kinds_without_both_classes_are_never_added():
    assert pii._threshold(np.array([0.9] * 60), np.ones(60)) == 2.0
    assert pii._threshold(np.array([0.9] * 60 + [0.1] * 49), np.array([1.0] * 60 + [0.0] * 49)) == 2.0
    assert pii._threshold(np.array([0.9] * 60 + [0.1] * 50), np.array([1.0] * 60 + [0.0] * 50)) == 0.5
    assert pii._threshold(np.array([0.9] * 60 + [0.95] * 50), np.array([1.0] * 60 + [0.0] * 50)) == 2.0
    no_mail = pii.fit_span_model([text.replace("@", " ") for text in TEXTS])
    assert no_mail.threshold["email"] == 2.0 and no_mail.threshold["card"] < 1


def test_measured_on_kept_cases(model):
    for kind in ("email", "card", "phone"):
        positives, negatives, precision, recall = model.measured[kind]
        assert min(positives, negatives) >= pii.LEAST_OF_CLASS and precision >= 0.98 and recall > 0.7


def test_nothing_to_learn():
    model = pii.fit_span_model([])
    assert model.trees is None
    assert [s[:4] for s in pii.find_spans("me@a.bc", model)] == [("email", 0, 7, True)]


def test_rows_and_masks(spark, documents, model):
    docs = documents((1, "é me@a.bc 10.0.0.1!"), (2, None), (3, ""), (3, ""), (None, "call +1 (826) 555-4081 10.0.0.2"))
    rows = pii.personal_data(docs, ["doc_id"], model).withColumn("s", pii.span_text("spans")).collect()
    assert sorted((r.doc_id or -1, r.s) for r in rows) == [
        (-1, "phone:5:22,ip:23:31"), (1, "email:2:9,ip:10:18"), (2, ""), (3, ""), (3, ""),
    ]
    redacted = pii.redact(docs, model)
    assert redacted.schema == docs.schema
    texts = {r.doc_id: (r.text, r.n_chars) for r in redacted.collect()}
    assert texts == {1: ("é [EMAIL] [IP]!", 15), 2: (None, None), 3: ("", 0), None: ("call [PHONE] [IP]", 17)}
    assert pii.personal_data(documents(), ["doc_id"], model).count() == 0


def test_learns_from_a_table(spark, documents):
    learned = pii.learn_span_model(documents(*[(i, text) for i, text in enumerate(TEXTS)], (999, None)))
    assert learned.trees is not None and min(learned.threshold.values()) <= 1
    assert pii.learn_span_model(documents()).trees is None


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    rows = rng.random((2000, 3))
    labels = ((rows[:, 0] > 0.5) ^ (rows[:, 1] > 0.3)).astype(float)
    model = boosting.fit_trees(rows[:1500], labels[:1500])
    boosting.calibrate(model, rows[1500:], labels[1500:])
    chance = model.probability(rows[1500:])
    assert ((chance > 0.5) == labels[1500:]).mean() > 0.95
    assert abs(chance.mean() - labels[1500:].mean()) < 0.02
