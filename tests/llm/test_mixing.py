"""Targets, words taken and positions of the mix."""

import re
from collections import defaultdict

import pytest

from riskloom.llm import mixing


def water_fill(sizes, weights, budget=1.5, most=2.0):
    """Share the budget by weight, again and again, until no source is above its limit."""
    full, open_ = {}, dict(zip(sizes, weights))
    left = budget * sum(sizes.values())
    while open_:
        level = left / sum(open_.values())
        above = [s for s, w in open_.items() if level * w >= most * sizes[s]]
        if not above:
            break
        for s in above:
            full[s] = most * sizes[s]
            left -= full[s]
            del open_[s]
    return {**full, **{s: left / sum(open_.values()) * w for s, w in open_.items()}}


def rows():
    out = [(i, "word " * (1 + i % 13), None, f"s{i % 5}") for i in range(200)]
    out += [(1000 + i, "x y\tz\n" * (i % 40), None, "hot") for i in range(300)]
    out += [(2000, "lone source of one long text " * 50, None, "Ω"), (2001, None, None, "nothing"), (2002, " \t\n", None, None)]
    out += [(2003, "null source", None, None), (None, "null id", None, "s1"), (5, "word " * 6, None, "s0")]
    return out


def test_against_water_filling(spark, documents):
    data = rows()
    got = mixing.mix_sources(documents(*data)).collect()
    assert len(got) == len(data)
    sizes = defaultdict(int)
    for _, text, _, source in data:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = water_fill({s: sizes[s] for s in order}, [(5, 2, 1)[i % 3] for i in range(len(order))])
    taken = defaultdict(int)
    for row in got:
        assert row.source_size == sizes[row.source]
        assert row.target == pytest.approx(want[row.source])
        assert 0 <= row.taken <= 2 * row.size
        taken[row.source] += row.taken
    for source, target in want.items():
        assert abs(taken[source] - target) <= 0.5 + 1e-9


def test_positions_follow_the_schedule(spark, documents):
    data = [(i, "w " * 10, None, "a") for i in range(400)]
    schedule = [(0.0, 0.0), (0.5, 3.0), (1.0, 1.0)]
    got = mixing.mix_sources(documents(*data), schedules=[schedule], budget=1.0).collect()
    assert [r.position for r in got] == sorted(r.position for r in got)
    area = 0.75 + 1.0
    for row, done in zip(got, range(0, 4000, 10)):
        t = row.position
        reached = 3 * t * t if t <= 0.5 else 0.75 + 3 * (t - 0.5) - 2 * (t - 0.5) ** 2
        assert reached / area == pytest.approx(done / 4000, abs=1e-6)


def test_buckets_change_nothing_and_reruns_agree(spark, documents, monkeypatch):
    first = sorted(map(repr, mixing.mix_sources(documents(*rows())).collect()))
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 4)
    assert sorted(map(repr, mixing.mix_sources(documents(*reversed(rows())).repartition(7)).collect())) == first


def test_empty_and_wordless(spark, documents):
    assert mixing.mix_sources(documents()).count() == 0
    only = mixing.mix_sources(documents((1, "", None, "a"), (1, "", None, "a"))).collect()
    assert [(r.size, r.target, r.taken, r.position) for r in only] == [(0, 0.0, 0, None)] * 2


def test_no_python_in_the_plan(spark, documents):
    plan = mixing.mix_sources(documents(*rows()))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_rows_of_one_id_are_split(documents, monkeypatch):
    """A third of the rows share the NULL id: they fill several tasks, with the same results."""
    data = [(i, "w " * (i % 9), None, f"s{i % 3}") for i in range(600)]
    data += [(None, "w " * (i % 4), None, "s1") for i in range(300)] + [(7, "same text", None, "s1")] * 50
    schedules = lambda df: sorted((tuple(r) for r in mixing.mix_sources(df).collect()), key=repr)
    plain = schedules(documents(*data))
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 8)
    many_buckets = schedules(documents(*data))
    assert many_buckets == plain
    monkeypatch.setattr(mixing, "FULL_BUCKET", 4)
    monkeypatch.setattr(mixing, "COPIES_PER_TASK", 16)
    blocks = []
    apart = mixing._apart
    monkeypatch.setattr(mixing, "_apart", lambda df: blocks.append(df) or apart(df))
    assert schedules(documents(*data)) == plain and blocks
