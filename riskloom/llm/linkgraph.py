"""URL filter: rules by host and path, and link-graph propagation for what no rule decides.

Trust spreads forward along host links from hosts with pages that a rule allows
(personalised PageRank); distrust spreads backward from hosts with pages that a rule
blocks, to the hosts that link to them. A host is blocked when distrust has the larger
share of its two ranks. Edges are links between hosts found in the pages, counted per
pair, and the tie between a host and its parent domain where both are seen.

All steps are joins and sums over edges in Spark. The rank that dangling hosts would hand
back to the seeds only scales all ranks alike, so it is left out and ranks are
normalised at the end.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.durable import durable
from riskloom.operators.joins import hot_keys_from_counts, spread_left_join

Rule = tuple[str, str, str]  # verdict, host, path
DAMPING = 0.85
TOLERANCE = 1e-6  # of the whole rank, by which it may still grow between two writes
ROUNDS_PER_WRITE = 5
BLOCK_SHARE = 0.5
HOT_ROWS = 10_000
LINK = r"""(?i)(?:href|src|action)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def _lower(column: Column) -> Column:
    """A-Z alone."""
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def with_host_path(df: DataFrame, url: str) -> DataFrame:
    """Add ``host`` and ``path``; both are empty for a NULL url or one without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)"))
    return df.withColumns(
        {
            "host": F.coalesce(_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.lit("")),
            "path": F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit("")),
        }
    )


def rule_of(rules: Sequence[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits, else NULL."""
    out = F.lit(None)
    for verdict, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit(f".{host}"))) & F.startswith(F.col("path"), F.lit(path))
        own = F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, own).otherwise(out)
    return out.cast("struct<rule:string,verdict:string>")


def host_edges(pages: DataFrame, html: str) -> DataFrame:
    """(src, dst, n): links between different hosts, and ties to the parent domain."""
    found = F.explode(F.regexp_extract_all(html, F.lit(LINK), F.lit(1)))
    linked = pages.where(F.col("host") != "").select(F.col("host").alias("src"), found.alias("dst"))
    links = linked.withColumn("dst", _lower(F.col("dst"))).where("src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))
    hosts = pages.where(F.col("host") != "").select("host").distinct()
    parent = F.regexp_extract("host", r"^[^.]+\.(.+)$", 1)
    ties = hosts.select(F.col("host").alias("src"), parent.alias("dst")).join(
        hosts.select(F.col("host").alias("dst")), "dst", "left_semi"
    )
    up, down = ties.select("src", "dst"), ties.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return links.unionAll(up.unionAll(down).withColumn("n", F.lit(1).cast("long"))).groupBy("src", "dst").agg(F.sum("n").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust), each normalised, from edges and seeds (host, trusted, blocked).

    Both ranks are iterated in one table: ``kind`` 0 follows links, 1 follows them back. A
    round only ever adds to ranks, so they have settled when their sums hardly grow any more
    and no further host is reached, however far it is from the seeds.
    """
    both = edges.select(F.lit(0).alias("kind"), "src", "dst", "n").unionAll(
        edges.select(F.lit(1).alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    )
    degree = both.groupBy("kind", "src").agg(F.sum("n").alias("degree"))
    steps = durable(
        both.join(degree, ["kind", "src"]).select("kind", "src", "dst", (F.lit(damping) * F.col("n") / F.col("degree")).alias("share")),
        "edges",
    )
    start = seeds.select(F.lit(0).alias("kind"), "host", F.col("trusted").cast("double").alias("rank")).unionAll(
        seeds.select(F.lit(1).alias("kind"), "host", F.col("blocked").cast("double").alias("rank"))
    )
    start = durable(start.where("rank > 0"), "seeds")
    ranks, reached = start, {}
    while True:
        for _ in range(ROUNDS_PER_WRITE):
            moved = ranks.withColumnRenamed("host", "src").join(steps, ["kind", "src"])
            moved = moved.select("kind", F.col("dst").alias("host"), (F.col("rank") * F.col("share")).alias("rank"))
            ranks = start.unionAll(moved).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        ranks = durable(ranks, "ranks")
        sums = ranks.groupBy("kind").agg(F.sum("rank").alias("total"), F.count("*").alias("hosts")).collect()
        before, reached = reached, {row.kind: (row.total, row.hosts) for row in sums}
        if all(
            kind in before and before[kind][1] == hosts and total - before[kind][0] <= tolerance * total
            for kind, (total, hosts) in reached.items()
        ):
            break
    totals = {kind: total for kind, (total, _) in reached.items()}

    def normal(kind: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0)) / F.lit(totals.get(kind) or 1.0)

    return ranks.groupBy("host").agg(normal(0).alias("trust"), normal(1).alias("distrust"))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    id_column: str = "page_id",
    url: str = "url",
    html: str = "html",
    block_share: float = BLOCK_SHARE,
) -> DataFrame:
    """(id, host, path, rule, verdict, trust, distrust) of every page.

    The longest fitting rule decides. Without one, the host's ranks do: block if distrust has
    at least ``block_share`` of both, allow otherwise and where neither reaches the host. A
    NULL url or one without ``://`` has an empty host and path, no rule, and is allowed; a
    NULL html has no links. Repeated rows all stay; no rows give no rows.
    """
    own = pages.select(F.col(id_column).alias("id"), F.col(url).alias("_url"), F.col(html).alias("_html"))
    own = with_host_path(own, "_url")
    judged = durable(own.select("id", "host", "path", rule_of(rules).alias("by_rule")), "judged")
    verdict = F.col("by_rule.verdict")
    hosts = durable(
        judged.groupBy("host").agg(
            F.count("*").alias("n"),
            F.count_if(verdict == "allow").alias("trusted"),
            F.count_if(verdict == "block").alias("blocked"),
        ),
        "hosts",
    )
    ranks = durable(propagate(host_edges(own, "_html"), hosts.where("host <> ''")), "host-ranks")
    hot = hot_keys_from_counts(hosts, ["host"], 2, min_rows=HOT_ROWS)
    joined = spread_left_join(judged, [ranks], ["host"], hot=hot)
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    bad = (distrust > 0) & (distrust >= F.lit(block_share) * (trust + distrust))
    return joined.select(
        F.col("id").alias(id_column),
        "host",
        "path",
        F.col("by_rule.rule").alias("rule"),
        F.coalesce(verdict, F.when(bad, "block").otherwise("allow")).alias("verdict"),
        trust.alias("trust"),
        distrust.alias("distrust"),
    )
