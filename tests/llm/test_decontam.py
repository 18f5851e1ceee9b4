"""Template decontamination: re-parameterised questions, slot checks, planted passages."""

import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom.llm import decontam, templates

ITEMS = [
    (1, "A train leaves at noon. If Alice buys 12 apples for 3 dollars and sells 5 of them to Bob, how many apples does Alice keep in the end?"),
    (2, "The quick brown fox jumps over the lazy dog while seven birds are watching from a tall tree near the old river."),
    (3, "tiny item"),
    (4, None),
    (5, ""),
    (None, "What is the largest lake that lies between two countries on this great wide continent of ours today?"),
]


def hits(spark, documents, *texts, items=ITEMS, **rules):
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(*enumerate(texts))
    return {(r.doc_id, r.item_id): r for r in decontam.contaminated(docs, bench, ["doc_id"], **rules).collect()}


def test_exact_and_embedded(spark, documents):
    found = hits(spark, documents, f"Some words. {ITEMS[1][1]} More words.", "clean text about nothing " * 50, ITEMS[5][1], None, "", "tiny item", "a tiny item here")
    assert set(found) == {(0, 2), (2, None), (5, 3), (6, 3)}
    assert found[0, 2].coverage == 1 and found[0, 2].changed_slots == 0


def test_items_shorter_than_a_window_are_passages(spark, documents):
    items = [(1, "Capital of France?"), (2, "Add 3 and 4"), (3, "12 15"), (4, "Alice Smith Jones")]
    texts = [
        "Quiz. Capital of France? Paris.",
        "the capital of france is old",
        "The capital of Spain? Madrid.",
        "Please add 3 and 4 now. Then add 5 and 6.",
        "Add 3 and 5",
        "values 11 12 15 16",
        "We met ALICE SMITH JONES and others.",
        "Alice Jones Smith",
        "Capital of France",
    ]
    found = hits(spark, documents, *texts, items=items)
    assert {(0, 1), (1, 1), (3, 2), (5, 3), (6, 4), (8, 1)} <= set(found)
    assert not {d for d, _ in found} & {2}
    assert all(r.coverage == 1 for r in found.values())


TABLE = "Measured heights were 11 12 13 14 15 16 17 18 19 in this order. Name the median of them."


def test_placeholders_alone_count_beside_other_windows(spark, documents):
    changed = re.sub(r"\d+", lambda m: str(int(m.group()) + 50), TABLE)
    found = hits(spark, documents, TABLE, f"Before it. {changed} After it.", "61 62 63 64 65 66 67 68 69", "11 12 13 14 15", items=[(1, TABLE)])
    assert {k: (r.coverage, r.changed_slots) for k, r in found.items()} == {(0, 1): (1, 0), (1, 1): (1, 9)}
    assert set(hits(spark, documents, "so: 1 2 3 4 5 6 7 8", "so: 2 3 4 5 6 7 8 9", items=[(1, "1 2 3 4 5 6 7 8")])) == {(0, 1)}
    twice = TABLE.replace("19", "11")  # the item's value has two partners
    assert hits(spark, documents, TABLE, items=[(1, twice)], run_tokens=1000) == {}
    assert hits(spark, documents, TABLE, items=[(1, twice)], coverage=0.5, run_tokens=1000)[0, 1].coverage == 11 / 16


def test_number_tables_in_linear_time(spark, documents):
    rng = random.Random(2)
    numbers = lambda n, most=10**6: " ".join(str(rng.randrange(most)) for _ in range(n))
    items = [(i, f"{numbers(11)}") for i in range(25)] + [(100 + i, f"Sort the list {numbers(11)} upwards now please.") for i in range(25)]
    texts = [numbers(50_000), numbers(5_000) + " " + items[3][1] + " " + numbers(5_000), numbers(3_000, 2), items[30][1] + " " + numbers(3_000)]
    hits(spark, documents, "warm up", items=items)
    start = time.perf_counter()
    found = hits(spark, documents, *texts, items=items)
    assert time.perf_counter() - start < 30
    # Lists to be sorted are one question with other numbers; numbers alone are what they are.
    assert set(found) == {(1, 3)} | {(3, 100 + i) for i in range(25)}


def test_bitmap_follows_the_benchmark(spark):
    for n, size in ((10, 1 << 23), (1 << 20, 1 << 24), (1 << 30, 1 << 26)):
        bits = decontam._bitmap(spark.createDataFrame([(-1,), (5,), (1 << 62,)], "hash long"), n)
        assert len(bits) * 8 == size and sum(map(int.bit_count, bits)) == 3


def test_new_numbers_and_names(spark, documents):
    changed = ITEMS[0][1].replace("12", "7,500").replace("Alice", "Maria").replace("Bob", "John Smith").replace("3 dollars", "2.5 euros")
    found = hits(spark, documents, changed)
    assert set(found) == {(0, 1)} and found[0, 1].coverage == 1 and found[0, 1].changed_slots >= 4


def test_slots_must_be_consistent(spark, documents):
    """The same name stands for two people: windows with slots do not count."""
    broken = ITEMS[0][1].replace("Alice buys", "Maria buys").replace("does Alice", "does Peter")
    assert hits(spark, documents, broken) == {}
    assert set(hits(spark, documents, ITEMS[0][1].replace("Alice", "Maria"))) == {(0, 1)}


NAMED = (
    "A market opens early each day. On the first morning Alice carries a basket of green pears down the narrow lane and meets a farmer. "
    "Later that week the baker gives Alice warm bread in exchange for some of the fruit that nobody else wanted. "
    "If the rest is shared among friends at the gate, what does Alice bring back home?"
)


def test_one_edited_mention(spark, documents):
    """A near-verbatim copy stays a hit: only windows with the edited mention are lost."""
    copy = NAMED.replace("does Alice", "does Alicia")
    other = NAMED.replace("Alice", "Maria").replace("does Maria", "does Peter")
    found = hits(spark, documents, copy, other, items=[(1, NAMED)], run_tokens=1000)
    assert set(found) == {(0, 1), (1, 1)}
    assert all(0.85 < r.coverage < 1 for r in found.values()) and [found[i, 1].changed_slots for i in (0, 1)] == [0, 1]


def test_copies_in_another_case(spark, documents):
    copies = [f"so they said {form} and so on" for form in (NAMED.lower(), NAMED.upper(), NAMED.title(), NAMED)]
    found = hits(spark, documents, *copies, "other words of no item at all", items=[(1, NAMED), (2, "Where Did John Jacob Astor Smith Live Then?")])
    assert set(found) == {(i, 1) for i in range(4)} and all(r.coverage == 1 and r.changed_slots == 0 for r in found.values())
    assert set(hits(spark, documents, "Ask: where did john jacob astor smith live then? Nobody knew it.", items=[(2, "Where Did John Jacob Astor Smith Live Then?")])) == {(0, 2)}


def test_values_replaced_in_several_ways():
    """Windows that are the item's own cover it, but make no run."""
    windows = [{"item_pos": p, "item_slots": [7, 0], "slots": [d, 0]} for p, d in ((0, 1), (5, 2))]
    windows += [{"item_pos": 9, "item_slots": [8, 0], "slots": [8, 0]}, {"item_pos": 20, "item_slots": [0, 0], "slots": [0, 0]}]
    assert decontam._consistent(windows) == ([9, 20], [20], 0)
    windows[1]["slots"] = [1, 0]
    assert decontam._consistent(windows) == ([0, 5, 9, 20], [0, 5, 9, 20], 1)


def test_coverage_and_runs(spark, documents):
    words = ITEMS[1][1].split()
    assert set(hits(spark, documents, " ".join(words[:14]))) == {(0, 2)}  # a run of 13 tokens and more
    assert hits(spark, documents, " ".join(words[:11])) == {}
    assert set(hits(spark, documents, " ".join(words[:11]), coverage=0.3)) == {(0, 2)}
    scattered = " zzz ".join(" ".join(words[i : i + 6]) for i in range(0, 22, 6))
    assert hits(spark, documents, scattered) == {}


def plain_windows(text, n=5):
    words = re.findall(r"[^\W\d_]+", text.lower())
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def test_planted_passages_against_brute_force(spark, documents, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 0)  # join by shuffle
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 6))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    items = [(i, prose(rng.randrange(12, 40))) for i in range(30)]
    texts = [prose(rng.randrange(5, 120)) for _ in range(120)]
    for d in range(0, 120, 4):
        texts[d] += " " + rng.choice(items)[1] + " " + prose(3)
    texts[8] = texts[9] = items[0][1] + " " + items[1][1]
    got = set(hits(spark, documents, *texts, items=items))
    want = set()
    for d, text in enumerate(texts):
        own = plain_windows(text)
        for i, item in items:
            windows = plain_windows(item)
            if len(windows & own) >= 0.8 * len(windows):
                want.add((d, i))
    assert got == want and len(want) > 30


def test_repeats_clashing_names_and_empty_tables(spark, documents):
    docs = documents((1, ITEMS[1][1]), (1, ITEMS[1][1]), (None, ITEMS[1][1]), (2, "other"))
    docs = docs.withColumnRenamed("lang", "hash").withColumnRenamed("source", "item_id").withColumn("_key0", F.lit(1))
    bench = spark.createDataFrame([*ITEMS, ITEMS[1], (2, "another version of it")], "item_id long, text string")
    found = decontam.contaminated(docs, bench, ["doc_id"]).collect()
    assert sorted((r.doc_id or -1, r.item_id) for r in found) == [(-1, 2), (1, 2)]
    kept = decontam.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [2]
    assert decontam.contaminated(docs.limit(0), bench, ["doc_id"]).count() == 0
    assert decontam.drop_contaminated(docs, bench.limit(0)).count() == 4


@pytest.mark.parametrize("text", ["a" * 500_000, "a " * 200_000, "A " * 100_000, "1 km " * 50_000, "Xy. " * 50_000])
def test_long_texts(text):
    hashes, values = templates.template(templates.tokens([text])[0])
    assert len(hashes) == len(values) > 0
    assert len(templates.window_hashes(hashes, 5)) == max(1, len(hashes) - 4)


PATTERN = re.compile(r"[^\W\d_]+|[.!?:\n]|[+-]?\d+(?:[.,]\d+)*|[%$€£°]")


def plain_kind(token):
    known = dict.fromkeys(templates.NUMBER_WORDS, templates.NUMBER) | dict.fromkeys(templates.UNITS, templates.UNIT)
    if token in ".!?:\n":
        return templates.STOP
    if token.lower() in known:
        return known[token.lower()]
    if not token[0].isalpha():
        return templates.NUMBER
    return templates.CAPITAL if len(token) > 1 and token[0].isupper() and token[1:].islower() else templates.WORD


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text(alphabet="aBéÑ𝒜日 .,!\n15+-%€\t_kKmM", max_size=30), max_size=4))
def test_tokens(texts):
    """Kinds, and equal hashes for equal lower-cased tokens only, against a plain pattern."""
    coded, ends = templates.tokens(texts)
    for i, text in enumerate(texts):
        own = coded[ends[i - 1] if i else 0 : ends[i]].tolist()
        want = [t for t in PATTERN.findall(text + "\n")]
        assert [c & 7 for c in own] == [plain_kind(t) for t in want]
        names = {}
        assert all(names.setdefault(c >> 3, t.lower()) == t.lower() for c, t in zip(own, want))
