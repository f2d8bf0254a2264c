"""URL filters (operator 1), with DataFrame functions only.

Rules decide where one fits: its host and all subdomains, and a path that starts
with the rule's; the longest rule wins. Everything else is judged per host by link
propagation: personalised PageRank from trusted seeds along host edges, and the
same from blocked seeds along the reversed edges (a host that links to blocked
ones inherits distrust). Seeds weigh by their number of pages under allow / block rules.

Host edges are the links of all pages, resolved (absolute, `//host/..`, or relative:
their own host, which does not propagate) and summed per pair of hosts, and the
site edges between a host and its parent domain in both directions.

Defined results: a null url or one without `://` has empty host and path, no rule, and is
allowed; null html has no links; rows are judged one by one, also with a null or repeated page_id; extra columns are ignored.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplecast.llm.tables import materialise, read


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The production rules.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
DAMPING, ROUNDS = 0.85, 20
#: A host is blocked if distrust makes up more than this share of its trust and distrust.
BLOCK_ABOVE = 0.5
#: Rounds between two written states.
WRITE_EVERY = 4

LINK = r"""(?is)<a\s[^>]*?href\s*=\s*["']([^"'>]*)"""


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    return _ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest fitting rule as struct(rule, verdict), else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.text)):  # later, longer rules override
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight) between different hosts: links of (host, html), and site edges."""
    link = F.trim("link")
    target = (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), host_of(link))
        .when(F.startswith(link, F.lit("//")), host_of(F.concat(F.lit("x:"), link)))
        .otherwise(F.col("host"))
    )
    links = (
        pages.where("host <> ''")
        .select("host", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))).alias("link"))
        .select(F.col("host").alias("src"), target.alias("dst"))
        .where("dst <> '' AND src <> dst")
        .groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    )
    hosts = pages.select("host").distinct().unionByName(links.select(F.col("dst").alias("host"))).distinct()
    label = F.split("host", r"\.")
    # host -> parent -> grandparent ..: at most one row per label of a distinct host.
    chain = F.transform(F.sequence(F.lit(1), F.size(label)), lambda i: F.array_join(F.slice(label, i, F.size(label)), "."))
    steps = F.transform(F.sequence(F.lit(0), F.size("chain") - 2), lambda i: F.struct(F.get("chain", i).alias("src"), F.get("chain", i + 1).alias("dst")))
    site = (
        hosts.select(chain.alias("chain")).where(F.size("chain") > 1)
        .select(F.explode(steps).alias("e")).select("e.src", "e.dst").distinct()
    )
    both = site.unionByName(site.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return (
        links.unionByName(both.withColumn("weight", F.lit(1.0)))
        .groupBy("src", "dst").agg(F.sum("weight").alias("weight"))
    )


def propagate(edges: DataFrame, seeds: DataFrame, damping: float, rounds: int) -> DataFrame:
    """Personalised PageRank of both kinds at once.

    `seeds` (kind, host, share) sum to 1 per kind; kind 0 follows the edges, kind 1
    the reversed edges. Returns (kind, host, score).
    """
    forward = edges.select(F.lit(0).alias("kind"), "src", "dst", "weight")
    back = edges.select(F.lit(1).alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    moves = forward.unionByName(back)
    total = moves.groupBy("kind", "src").agg(F.sum("weight").alias("total"))
    moves = materialise(
        moves.join(total, ["kind", "src"]).select("kind", "src", "dst", (F.col("weight") / F.col("total")).alias("part")), "trust-moves"
    )
    jump = seeds.select("kind", "host", (F.col("share") * (1 - damping)).alias("score"))
    state = seeds.select("kind", "host", F.col("share").alias("score"))
    for step in range(1, rounds + 1):
        moved = moves.join(state.withColumnRenamed("host", "src"), ["kind", "src"]).select(
            "kind", F.col("dst").alias("host"), (F.col("score") * F.col("part") * damping).alias("score")
        )
        state = moved.unionByName(jump).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if step % WRITE_EVERY == 0 or step == rounds:
            state = materialise(state, "trust-state")
    return state


def judge_urls(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, damping: float = DAMPING, rounds: int = ROUNDS,
    block_above: float = BLOCK_ABOVE,
) -> DataFrame:
    """Per row of `pages` (page_id, url, html): host, path, rule, verdict, trust, distrust."""
    pages = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html"
    )
    ruled = pages.select("page_id", "host", "path", best_rule(F.col("host"), F.col("path"), rules).alias("best"))
    edges = materialise(host_edges(pages), "trust-edges")
    counts = ruled.where("best IS NOT NULL AND host <> ''").groupBy(
        F.when(F.col("best.verdict") == "allow", 0).otherwise(1).alias("kind"), "host"
    ).agg(F.count("*").alias("n"))
    counts = materialise(counts, "trust-seeds")
    total = counts.groupBy("kind").agg(F.sum("n").alias("total"))
    seeds = counts.join(F.broadcast(total), "kind").select("kind", "host", (F.col("n") / F.col("total")).alias("share"))
    score = propagate(edges, seeds, damping, rounds).groupBy("host").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("score")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == 1, F.col("score")).otherwise(0.0)).alias("distrust"),
    )
    bad = F.round(F.col("distrust") / (F.col("trust") + F.col("distrust")), 9) > block_above
    hosts = score.select("host", "trust", "distrust", F.coalesce(bad, F.lit(False)).alias("blocked"))
    by_host = F.when(F.coalesce("blocked", F.lit(False)), F.lit("block")).otherwise(F.lit("allow"))
    return ruled.join(hosts, "host", "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), by_host).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )


def op1_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages"))
