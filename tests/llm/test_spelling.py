"""Spelling groups against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from riskloom.llm import spelling


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain(rows):
    words = plain_words(rows)
    near = {w: [v for v in words if distance_one(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items())


def found(df, **options):
    got = spelling.group_spellings(df, **options).select("word", "form", "root", "n", "n_near", "form_n")
    return sorted(tuple(row) for row in got.collect())


def texts(seed, n=120):
    """Words of few letters with random edits, so that many are near each other."""
    random.seed(seed)
    stems = ["".join(random.choices("abcéÿÀ", k=random.randrange(6, 10))) for _ in range(12)]

    def word():
        w = random.choice(stems[:2] * 30 + stems)
        for _ in range(random.choice((0, 0, 0, 0, 1, 1, 2))):
            i = random.randrange(len(w) + 1)
            w = random.choice((w[:i] + random.choice("abcé") + w[i:], w[:i] + w[i + 1 :], w[:i] + "c" + w[i + 1 :]))
        return w.upper() if random.random() < 0.1 else w

    return [(i, " ".join(word() for _ in range(random.randrange(60)))) for i in range(n)]


@pytest.mark.parametrize("most", [spelling.SHARD_WORDS, 20, 1])
def test_against_brute_force(documents, most):
    """Shards of any size: the smallest are named by all counts, and cut into parts as well."""
    rows = texts(most)
    want = plain(rows)
    assert sum(1 for row in want if row[1]) > 3 and max(row[4] for row in want) > 5
    assert found(documents(*rows), most=most) == want


def test_chains_of_forms(documents):
    words = {"aaaaaaab": 2000, "aaaaaabb": 200, "aaaaabbb": 20, "aaaabbbb": 2}
    text = " ".join(w for w, n in words.items() for _ in range(n))
    ids = [i for i in range(2000) if all(zlib.crc32(f"{i}:{w}".encode()) % 31 for w in words)]
    got = {row[0]: row for row in found(documents((ids[0], text)))}
    assert [got[w][1:3] for w in words] == [(None, "aaaaaaab"), ("aaaaaaab",) * 2, ("aaaaaabb", "aaaaaaab"), ("aaaaabbb", "aaaaaaab")]


def test_letters_and_case(documents):
    rows = [(i, "ÉTOILES ×÷×÷×÷× straße-straßen Straßenbahn don't ıııııııı naïveté́s") for i in range(40)]
    assert found(documents(*rows)) == plain(rows)


def test_odd_rows(documents):
    rows = [(None, "spelling spelling"), (1, None), (2, ""), (2, "short words"), (3, "variants"), (3, "variants")]
    assert found(documents(*rows)) == plain(rows)
    assert found(documents()) == []
    assert found(documents((1, None))) == []


def test_long_text_is_read_in_blocks(documents, monkeypatch):
    text = "wordlike, another " * 90_000 + "z" * 3_000_000
    assert "".join(spelling._blocks(text, 1000)) == text
    assert found(documents((1, text), (2, text))) == plain([(1, text), (2, text)])


def test_other_columns_do_not_matter(spark):
    df = spark.createDataFrame([(1, "spelling spelling", {"a": 1}, "n")], "doc_id long, text string, word map<string,int>, n string")
    assert [row[0] for row in found(df)] == [row[0] for row in plain([(1, "spelling spelling")])]


def test_pairs_are_found_once(spark):
    random.seed(3)
    words = list({"".join(random.choices("abc", k=random.randrange(4, 7))) for _ in range(300)})
    group_of = {"a": 0, "b": 1, "c": 1}  # letters that share a group
    for level in (0, 1, spelling.GROUPS):
        pairs = Counter()
        for length in range(4, 8):
            shards = {}
            for w in words:
                if len(w) == length:
                    counts = spelling.letter_counts(w, group_of)
                    shards.setdefault(counts[:level], spelling.CountTrie(level)).add(spelling.Entry(w, counts, 1))
            for w in words:
                entry = spelling.Entry(w, spelling.letter_counts(w, group_of), 1)
                for size, first, over, under in spelling.visits(entry.counts[:level], len(w)):
                    if size == length and first in shards:
                        pairs.update(frozenset((w, e.word)) for e in shards[first].near(entry, over, under))
        assert set(pairs.values()) == {1}
        assert set(pairs) == {frozenset((a, b)) for a in words for b in words if distance_one(a, b)}
