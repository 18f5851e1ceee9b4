"""Fingerprints, links and components against plain recomputation."""

import random
import re

import pytest
import xxhash

from riskloom.llm import components, simhash


def plain_fingerprint(text, shingle=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(ids, prints, radius=2):
    parent = list(range(len(ids)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[top(i)] = top(j)
    least = {}
    for i, own in enumerate(ids):
        if own is not None:
            least[top(i)] = min(own, least.get(top(i), own))
    return [least.get(top(i)) for i in range(len(ids))]


def check(spark, documents, rows):
    prints = [plain_fingerprint(text) for _, text in rows]
    want = zip([i for i, _ in rows], [f"{p:016x}" for p in prints], plain_components([i for i, _ in rows], prints))
    got = simhash.simhash_groups(documents(*rows)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def words(rng, n):
    return [rng.choice("alpha beta gamma delta épsilon ZETA eta theta iota kappa".split()) for _ in range(n)]


def test_groups(spark, documents):
    rng = random.Random(2)
    rows = [(i, " ".join(words(rng, rng.randrange(1, 60)))) for i in range(60)]
    rows += [(100 + i, rows[i % 7][1]) for i in range(20)]
    rows += [(200 + i, rows[i][1] + " more") for i in range(60)]
    base = words(rng, 400)
    for i in range(30):
        base[rng.randrange(400)] = f"new{i}"
        rows.append((300 + i, "\t".join(base)))
    rows += [(400, None), (401, ""), (402, " \n\t "), (403, "Ä ä A"), (404, "Ä ä a"), (None, "Ä ä a"), (None, "only null id"), (0, rows[0][1])]
    check(spark, documents, rows)


def test_empty(spark, documents):
    assert simhash.simhash_groups(documents()).count() == 0
    assert simhash.drop_near_copies(documents()).count() == 0


def test_long_text(documents):
    text = "one two three four " * 60_000
    assert simhash.fingerprint(text.encode(), 3) == plain_fingerprint(text)


@pytest.mark.parametrize("most,members", [(4096, 16), (8, 16), (8, 0.001)])
def test_links_of_hot_shards(spark, monkeypatch, most, members):
    """Dense fingerprints force shards to be split; no component may be lost."""
    monkeypatch.setattr(simhash, "MOST_MEMBERS", most)
    monkeypatch.setattr(simhash, "SHARD_MEMBERS", members)
    rng = random.Random(4)
    centre = rng.getrandbits(64)
    prints = {centre} | {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(150)}
    prints |= {rng.getrandbits(64) for _ in range(100)}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash._links(spark.createDataFrame([(p,) for p in signed], "fp long"), 2)
    roots = {row.node: row.root for row in components.connected_components(links).collect()}
    got = [roots.get(p, p) for p in signed]
    want = plain_components(list(range(len(prints))), prints)
    assert len(set(got)) == len(set(want))
    assert len(set(zip(got, want))) == len(set(want))


def test_shards_hot_at_every_level(spark, monkeypatch):
    """Near copies that differ in 14 bits only: blocks in another order give the same bits at level 2."""
    monkeypatch.setattr(simhash, "MOST_MEMBERS", 8)
    assert all(len(set(masks)) == len(masks) for masks in (simhash._masks(2, level) for level in range(4)))
    rng = random.Random(5)
    centre = rng.getrandbits(63)
    prints = sorted({centre ^ rng.getrandbits(14) for _ in range(120)} | {rng.getrandbits(63) for _ in range(50)})
    kept = [tuple(row) for row in simhash._links(spark.createDataFrame([(p,) for p in prints], "fp long"), 2).collect()]
    assert all((u ^ v).bit_count() <= 2 for u, v in kept)
    roots = {row.node: row.root for row in components.connected_components(spark.createDataFrame(kept, "u long, v long")).collect()}
    got = [roots.get(p, p) for p in prints]
    want = plain_components(list(range(len(prints))), prints)
    assert len(set(got)) == len(set(want)) == len(set(zip(got, want)))


def test_components_of_a_path(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100), (101, 102), (102, 101)]
    found = components.connected_components(spark.createDataFrame(edges, "u long, v long"))
    assert {tuple(r) for r in found.collect()} == {(i, 0) for i in range(61)} | {(101, 101), (102, 101)}


def test_one_of_each_group_stays(spark, documents):
    docs = documents((5, "a b c d"), (3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (7, "other words here now"), (None, None))
    docs = docs.withColumnRenamed("source", "_row").withColumnRenamed("lang", "fp")
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == [(-1, ""), (3, "a b c d"), (7, "other words here now")]
