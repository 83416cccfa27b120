"""URL rules, and for pages without one the standing of their host: trust and distrust passed along links.

Personalised PageRank starts at hosts with pages that rules allow and follows links; distrust starts at hosts with pages that
rules block and follows links backwards, to those who link there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .tables import written

# The rules of the query, as (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?((?:[a-z][a-z0-9+.\-]*:)?//[^"'\s>]+)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url):
    """(host, path) of a url column: empty where it is null or has no ://."""
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER), F.regexp_extract(url, URL, 2)


def rule_of(host, path, rules=RULES):
    """(rule, verdict) of the longest rule that fits, null if none does."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, h, p in reversed(ordered):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts, counted before they are shuffled."""
    src, _ = url_parts(F.col("url"))
    link = F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1)))
    links = pages.select(src.alias("src"), link.alias("link"))
    full = F.when(F.col("link").startswith("//"), F.concat(F.lit("x:"), "link")).otherwise(F.col("link"))
    links = links.select("src", url_parts(full)[0].alias("dst"))
    return links.where("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


#: A host with less than this share of the mean mass of a host counts as not reached.
FAINT = 1e-30


def propagated(links: DataFrame, seeds: DataFrame, damping: float, rounds: int | None, tolerance: float, faint: float = FAINT) -> DataFrame:
    """(kind, host, mass): personalised PageRank of several kinds at once.

    `links` has (kind, src, dst, n), `seeds` (kind, host, mass) with masses that sum to 1 per kind. What hosts without links
    hold goes back to the seeds. Every five rounds the state is written and compared with the one before: it ends when no
    host is new and none has changed by more than `tolerance` of its mass, so that small masses are as exact as large ones.
    Masses below `faint` times the mean over all hosts are dropped at the end. Each round shrinks all that is missing by `damping`,
    so however long the chains of a graph are, what can still come is `tolerance` of that after a number of rounds that grows with
    the logarithm of the number of hosts: then it ends as well. With a limit of `rounds` that is too few, it raises.
    """
    out = links.groupBy("kind", "src").agg(F.sum("n").alias("total"))
    shares = links.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("total")).alias("part"))
    shares = written(shares, "links")
    seeds = written(seeds, "seeds")
    if shares.isEmpty():
        return seeds
    hosts = shares.select(F.col("src").alias("host")).union(shares.select("dst")).union(seeds.select("host")).distinct().count()
    least = faint / hosts
    state = before = seeds
    k = 0
    while True:
        k += 1
        moved = state.withColumnRenamed("host", "src").join(shares, ["kind", "src"])
        moved = moved.groupBy("kind", F.col("dst").alias("host")).agg((F.sum(F.col("mass") * F.col("part")) * damping).alias("mass"))
        lost = moved.groupBy("kind").agg((1 - F.sum("mass")).alias("back"))
        back = seeds.join(lost, "kind", "left").select(
            "kind", "host", (F.col("mass") * F.coalesce("back", F.lit(1.0))).alias("mass")
        )
        state = moved.unionByName(back).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))
        if k % 5 and k != rounds:
            continue
        state = written(state, "mass")
        both = state.join(before.withColumnRenamed("mass", "old"), ["kind", "host"], "left")
        moves = F.col("old").isNull() | (F.abs(F.col("mass") - F.col("old")) > tolerance * F.col("mass"))
        moving = both.where(F.col("mass") >= least).agg(F.sum(moves.cast("long"))).first()[0]
        if not moving or damping**k < tolerance * least:
            return state.where(F.col("mass") >= least)
        if k == rounds:
            raise RuntimeError(f"after {k} rounds {moving} masses still change by more than {tolerance} of themselves")
        before = state


def _digits(mass):
    """A mass rounded to 12 significant digits."""
    return F.format_string("%.11e", mass).cast("double")


def judged(
    pages: DataFrame,
    rules=RULES,
    damping: float = 0.85,
    rounds: int | None = None,
    tolerance: float = 1e-6,
    threshold: float = 1.0,
    faint: float = FAINT,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) for each row of `pages` (page_id, url, html, other columns).

    The verdict is the rule's, else block if the host's distrust is more than `threshold` times its trust, else allow. Hosts
    that no mass reaches have 0 of both. Null urls and urls without :// have an empty host, which is no node; null html has no
    links. Repeated rows count as often as they occur. Masses are compared after rounding to 12 significant digits. Rounds go
    on until every mass is settled to `tolerance` of itself, or too little is missing to matter; hosts with less than `faint` times
    the mean mass have 0. With a limit of `rounds` that is too few for that, it raises.
    """
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = parts.withColumn("rule", rule).withColumn("said", verdict)
    counts = ruled.where("said is not null and host <> ''").groupBy(F.col("said").alias("kind"), "host").agg(F.count("*").alias("n"))
    counts = written(counts, "counts")
    totals = counts.groupBy("kind").agg(F.sum("n").alias("total"))
    seeds = counts.join(totals, "kind").select("kind", "host", (F.col("n") / F.col("total")).alias("mass"))
    links = host_links(pages)
    both = links.select(F.lit("allow").alias("kind"), "src", "dst", "n").union(
        links.select(F.lit("block").alias("kind"), F.col("dst"), F.col("src"), "n")
    )
    mass = propagated(both, seeds, damping, rounds, tolerance, faint)
    of = lambda kind: _digits(F.sum(F.when(F.col("kind") == kind, F.col("mass")).otherwise(0.0)))
    hosts = mass.groupBy("host").agg(of("allow").alias("trust"), of("block").alias("distrust"))
    out = ruled.join(hosts, "host", "left").fillna(0.0, ["trust", "distrust"])
    method = F.when(F.col("distrust") > threshold * F.col("trust"), "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("said", method).alias("verdict"), "trust", "distrust")
