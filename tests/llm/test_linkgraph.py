"""URL rules and ranks against plain recomputation."""

import random

import numpy as np
import pytest

from riskloom.llm import linkgraph
from riskloom.llm.queries import URL_RULES


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    return host, tail[: min((i for i in map(tail.find, "?#") if i >= 0), default=len(tail))]


def plain_rule(host, path, rules=URL_RULES):
    fit = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


URLS = [
    "http://A.Example.ORG/es/1", "https://example.org/en/12", "http://x.example.org/en/2", "http://org/es/", "http://borg/", "org/es",
    None, "", "http://", "://", "http://h?x://y/z", "ftp://u:p@H.com:80/fr/a?b#c", "http://q.com/de/", "http://q.com/d", "http://É.com/fr/",
    "http://q.net/en/#x", "http://a.org?x=/es/", "http://line\nbreak.com/fr/\n?",
]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(URLS)], "page_id long, url string, html string")
    rows = {r.page_id: r for r in linkgraph.judge_urls(pages, URL_RULES).collect()}
    for i, url in enumerate(URLS):
        host, path = plain(url)
        rule, verdict = plain_rule(host, path)
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, rule)
        assert rows[i].verdict == verdict or (verdict is None and rows[i].verdict in ("allow", "block"))


def plain_ranks(edges, seeds, hosts):
    """Power iteration over a dense matrix, without handing back dangling rank."""
    at = {h: i for i, h in enumerate(hosts)}
    out = []
    for back in (False, True):
        move = np.zeros((len(hosts),) * 2)
        for (a, b), n in edges.items():
            move[(at[a], at[b]) if back else (at[b], at[a])] += n
        move /= np.maximum(move.sum(axis=0), 1)
        seed = np.array([seeds.get(h, (0, 0))[back] for h in hosts], float)
        rank = seed.copy()
        for _ in range(400):  # far beyond what changes the ranks
            rank = seed + linkgraph.DAMPING * move @ rank
        out.append(rank / max(rank.sum(), 1e-300))
    return {h: (out[0][i], out[1][i]) for h, i in at.items()}


def test_ranks_and_verdicts(spark):
    rng = random.Random(3)
    hosts = [f"h{i}.{d}" for i in range(12) for d in ("net", "com", "org")] + ["www.h1.net", "www.h2.com"]
    rows, edges = [], {}
    for page in range(150):
        host = rng.choice(hosts[:6]) if page % 3 else hosts[0]
        targets = [rng.choice(hosts) for _ in range(rng.randrange(4))]
        lang = rng.choice(["fr", "de", "en"])
        html = "".join(f'<a href="{rng.choice(["http:", "HTTPS:", ""])}//{t.upper() if rng.random() < 0.3 else t}/x">l</a><a href=/rel>' for t in targets)
        rows.append((page, f"http://{host}/{lang}/{page}", html if page % 10 else html or None))
        for t in targets:
            if t != host:
                edges[host, t] = edges.get((host, t), 0) + 1
    rows.append((900, "http://www.h1.net/en/", ""))
    seen = {plain(u)[0] for _, u, _ in rows}
    for host in seen:
        parent = host.split(".", 1)[1]
        if parent in seen:
            edges[host, parent] = edges.get((host, parent), 0) + 1
            edges[parent, host] = edges.get((parent, host), 0) + 1
    seeds = {}
    for _, url, _ in rows:
        host, path = plain(url)
        verdict = plain_rule(host, path)[1]
        good, bad = seeds.get(host, (0, 0))
        seeds[host] = (good + (verdict == "allow"), bad + (verdict == "block"))
    want = plain_ranks(edges, seeds, sorted(set(hosts) | seen))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    verdicts = set()
    for r in linkgraph.judge_urls(pages, URL_RULES).collect():
        trust, distrust = want[r.host]
        assert (r.trust, r.distrust) == (pytest.approx(trust, abs=1e-5), pytest.approx(distrust, abs=1e-5))
        rule, verdict = plain_rule(r.host, r.path)
        by_rank = "block" if distrust > 0 and distrust >= 0.5 * (trust + distrust) else "allow"
        assert r.verdict == (verdict or by_rank)
        verdicts.add((rule is None, r.verdict))
    assert (True, "block") in verdicts and (True, "allow") in verdicts


def test_rank_reaches_the_end_of_a_chain(spark):
    chain = [(f"h{i}", f"h{i + 1}", 1) for i in range(60)]
    seeds = spark.createDataFrame([("h0", 1, 0), ("h60", 0, 1)], "host string, trusted long, blocked long")
    edges = spark.createDataFrame(chain, "src string, dst string, n long")
    ranks = {r.host: (r.trust, r.distrust) for r in linkgraph.propagate(edges, seeds).collect()}
    total = sum(0.85**i for i in range(61))
    assert all(ranks[f"h{i}"] == (pytest.approx(0.85**i / total), pytest.approx(0.85 ** (60 - i) / total)) for i in range(61))
    assert linkgraph.propagate(edges.limit(0), seeds).count() == 2
    assert linkgraph.propagate(edges, seeds.limit(0)).count() == 0


def test_empty(spark):
    assert linkgraph.judge_urls(spark.createDataFrame([], "page_id long, url string, html string"), URL_RULES).count() == 0
