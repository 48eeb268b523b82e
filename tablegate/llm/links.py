"""URL filters: rules, and a link graph for the hosts that no rule decides.

Trust starts at the pages that a rule allows and follows links; distrust starts at the
pages that a rule blocks and goes against them, as who links to a blocked host is suspect.
Both are personalised PageRanks over host edges, in units of pages. Edges are the absolute
links of the pages, and one each way between a host and its parent domain. Hosts that are
only linked to and all parent domains are part of the graph; without a page of their own
they count as one page that a rule on the whole host allows or blocks. Names of a single
label and numeric addresses are no parent domains.

Defined cases: a null url, or one without ``://``, has an empty host and path and fits no
rule; a null html has no links; repeated rows count as further pages; a host without links
is judged by its own pages; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegate.llm.common import small_or_shuffled
from tablegate.session import BROADCAST_LIMIT_BYTES, materialize, measured

Rule = tuple[str, str, str]

RULES: tuple[Rule, ...] = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
DAMPING = 0.85
ROUNDS = 20
# A host is blocked when its distrust exceeds its trust by more than this share of its pages.
THRESHOLD = 0.5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s<>]+)"""


def host_of(rest: Column) -> Column:
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path, both empty for a null url or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return host_of(rest), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> tuple[Column, Column]:
    """The text and the action of the longest rule that fits, or nulls."""
    text = action = F.lit(None).cast("string")
    for kind, domain, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(prefix)
        text = F.when(fits, domain + prefix).otherwise(text)
        action = F.when(fits, kind).otherwise(action)
    return text, action


def host_links(pages: DataFrame) -> DataFrame:
    """(source, target, weight): the absolute links between different hosts."""
    links = pages.select(
        F.col("host").alias("source"),
        F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("target"),
    )
    links = links.select("source", F.translate("target", UPPER, LOWER).alias("target"))
    links = links.filter("source <> target AND source <> '' AND target <> ''")
    return links.groupBy("source", "target").agg(F.count(F.lit(1)).cast("double").alias("weight"))


def parents_of(host: Column) -> Column:
    """The parent domains of at least two labels, nearest first."""
    labels = F.size(F.split(host, "[.]"))
    parents = F.transform(
        F.sequence(F.lit(1), labels - 2),
        lambda i: F.array_join(F.slice(F.split(host, "[.]"), i + 1, labels), "."),
    )
    proper = (labels > 2) & ~host.rlike(r"^[0-9.]+(:[0-9]+)?$|[.][.]|^[.]|[.]$")
    return F.when(proper, parents).otherwise(F.array().cast("array<string>"))


def graph(hosts: DataFrame, links: DataFrame, rules: Sequence[Rule] = RULES) -> tuple[DataFrame, DataFrame]:
    """Nodes (host, allowed, blocked) and edges (source, target, weight)."""
    named = hosts.select("host").union(links.select(F.col("target").alias("host"))).distinct()
    every = named.select(
        F.explode(F.concat(F.array("host"), parents_of(F.col("host")))).alias("name")
    ).distinct()
    _, action = rule_of(F.col("name"), F.lit("/"), rules)
    nodes = every.join(hosts, F.col("name") == F.col("host"), "left").select(
        F.col("name").alias("host"),
        F.coalesce("allowed", F.when(action == "allow", 1).otherwise(0)).cast("long").alias("allowed"),
        F.coalesce("blocked", F.when(action == "block", 1).otherwise(0)).cast("long").alias("blocked"),
    )
    family = every.select("name", F.get(parents_of(F.col("name")), F.lit(0)).alias("parent")).filter(
        "parent IS NOT NULL"
    )
    one = F.lit(1.0).alias("weight")
    up = family.select(F.col("name").alias("source"), F.col("parent").alias("target"), one)
    down = family.select(F.col("parent").alias("source"), F.col("name").alias("target"), one)
    edges = links.union(up).union(down).groupBy("source", "target").agg(F.sum("weight").alias("weight"))
    return nodes, edges


def propagated(
    hosts: DataFrame, edges: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS
) -> DataFrame:
    """(host, trust, distrust) for hosts with (host, allowed, blocked) pages.

    Distrust runs over the reversed edges as a graph of its own beside the first, so that a
    round is one join and one partial aggregation. The mass of hosts without links is lost.
    """
    both = edges.select(F.concat(F.lit("+"), "source").alias("source"), F.concat(F.lit("+"), "target").alias("node"), "weight").union(
        edges.select(F.concat(F.lit("-"), "target").alias("source"), F.concat(F.lit("-"), "source").alias("node"), "weight")
    )
    seeds = hosts.select(F.concat(F.lit("+"), "host").alias("node"), F.col("allowed").cast("double").alias("seed")).union(
        hosts.select(F.concat(F.lit("-"), "host").alias("node"), F.col("blocked").cast("double").alias("seed"))
    )
    out = both.groupBy("source").agg(F.sum("weight").alias("total"))
    shares = materialize(both.join(out, "source").select("source", "node", (F.col("weight") / F.col("total")).alias("share")))
    seeds = materialize(seeds)
    if measured(shares)[1] + measured(seeds)[1] <= BROADCAST_LIMIT_BYTES:
        # A graph of a measured small size needs no exchange between its rounds.
        shares, seeds = materialize(shares.coalesce(1)), materialize(seeds.coalesce(1))
    state = seeds.select("node", (F.col("seed") * (1 - damping)).alias("score"))
    for round_no in range(rounds):
        known = state.select(F.col("node").alias("source"), "score")
        passed = shares.join(known, "source").groupBy("node").agg(F.sum(F.col("score") * F.col("share")).alias("got"))
        state = seeds.join(passed, "node", "left").select(
            "node",
            (F.col("seed") * (1 - damping) + F.coalesce("got", F.lit(0.0)) * damping).alias("score"),
        )
        if round_no % 5 == 4:
            state = materialize(state)
    kind, host = F.substring("node", 1, 1), F.expr("substring(node, 2)")
    return state.groupBy(host.alias("host")).agg(
        F.sum(F.when(kind == "+", F.col("score")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(kind == "-", F.col("score")).otherwise(0.0)).alias("distrust"),
    )


def judged(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    damping: float = DAMPING,
    rounds: int = ROUNDS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page."""
    host, path = url_parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    ruled = rows.select("page_id", "host", "path", rule.alias("rule"), action.alias("action"))
    hosts = materialize(
        ruled.filter("host <> ''").groupBy("host").agg(
            F.count(F.lit(1)).alias("pages"),
            F.count(F.when(F.col("action") == "allow", 1)).alias("allowed"),
            F.count(F.when(F.col("action") == "block", 1)).alias("blocked"),
        )
    )
    nodes, edges = graph(hosts, materialize(host_links(rows)), rules)
    scores = propagated(materialize(nodes), materialize(edges), damping, rounds)
    excess = F.col("distrust") - F.col("trust")
    suspect = hosts.join(scores, "host").filter(
        excess > F.col("pages") * F.lit(threshold * (1 - damping))
    )
    bad = materialize(suspect.select(F.col("host").alias("bad_host")))
    return ruled.join(small_or_shuffled(bad), F.col("host") == F.col("bad_host"), "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("action", F.when(F.col("bad_host").isNotNull(), "block"), F.lit("allow")).alias("verdict"),
    )
