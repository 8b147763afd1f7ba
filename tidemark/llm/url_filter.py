"""URL filter: rules on hosts and paths, and trust carried along links for the rest.

Rules judge pages first.  Hosts that rules judge for the most part become seeds: trusted
ones spread trust along links (personalised PageRank), blocked ones spread distrust along
reversed links, to the hosts that lead there.  A host is blocked when its share of all
distrust exceeds its share of all trust and the floor; that verdict holds for its pages
without a rule.

Links are the `href` values with a host of their own.  One edge counts the pages of a host
that link to another host; links within a host say nothing about hosts and are left out.
Mass that ends at hosts without links would go back to the seeds, which multiplies every
score alike; so it is left out and the scores are divided by their sum at the end.
The number of rounds follows from the tolerance: what a walk longer than that could still add.

Cases: a null url, or one without `://`, has an empty host and path, no edges, and gets
the default.  A host without any mass gets the default, allow.  Repeated pages count as
pages, and each gets its row.  Null html has no links.  Without links, seeds keep their
own mass and all other hosts have none.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Value of an href with a host; group 1 is the host.
LINK = r"""[\x20\x09-\x0D"'][Hh][Rr][Ee][Ff][\x20\x09-\x0D]*=[\x20\x09-\x0D]*["']?(?:[Hh][Tt][Tt][Pp][Ss]?:)?//([^/?#"'<>\x00-\x20]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parse_rules(lines: Sequence[str]) -> list[Rule]:
    """Rules of lines like `block net/` or `allow example.net/en/`."""
    out = []
    for line in lines:
        verdict, rest = line.split(" ", 1)
        host, slash, path = rest.partition("/")
        if verdict not in ("allow", "block") or not host or not slash:
            raise ValueError(f"not a rule: {line!r}")
        out.append(Rule(verdict, host, "/" + path))
    return out


RULES = parse_rules(["block net/", "allow example.net/en/", "block example.com/de/", "allow org/fr/"])


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the last one wins
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def judged_by_rules(pages: DataFrame, rules: Sequence[Rule], url: str = "url", keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """The kept columns with host, path, rule and the rule's verdict."""
    split = pages.select(*keep, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    name, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    return split.select(*keep, "host", "path", name.alias("rule"), verdict.alias("by_rule"))


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """src, dst, pages: how many pages of a host link to another host."""
    linked = F.array_distinct(F.transform(F.regexp_extract_all(F.col(html), F.lit(LINK), 1), lower_ascii))
    found = pages.select(host_of(F.col(url)).alias("src"), F.explode(linked).alias("dst"))
    return found.where("src <> '' AND dst <> '' AND src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("pages"))


def seeds(judged: DataFrame) -> DataFrame:
    """kind (trust, distrust), host of the hosts whose pages most rules judge alike."""
    counts = judged.where("host <> ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("by_rule") == "allow").alias("a"), F.count_if(F.col("by_rule") == "block").alias("b")
    )
    kind = F.when(F.col("a") * 2 > F.col("n"), "trust").when(F.col("b") * 2 > F.col("n"), "distrust")
    return counts.select(kind.alias("kind"), "host").where("kind IS NOT NULL")


def propagate(edges: DataFrame, start: DataFrame, damping: float = 0.85, tolerance: float = 0.01, written_every: int = 5) -> DataFrame:
    """kind, host, score: seeds' mass carried along (trust) or against (distrust) the edges.

    One join and one sum a round.  A host with a great many links is a hot key of the
    join, which adaptive execution splits; sums are reduced before their shuffle.
    """
    ways = [("trust", "src", "dst"), ("distrust", "dst", "src")]
    both = reduce(DataFrame.unionAll, [edges.select(F.lit(k).alias("kind"), F.col(a).alias("host"), F.col(b).alias("to"), "pages") for k, a, b in ways])
    total = both.groupBy("kind", "host").agg(F.sum("pages").alias("all"))
    steps = cut_lineage(both.join(total, ["kind", "host"]).select("kind", "host", "to", (F.lit(damping) * F.col("pages") / F.col("all")).alias("p")), "host-steps")
    start = cut_lineage(start.select("kind", "host", F.lit(1.0).alias("score")), "host-seeds")
    state = start
    rounds = 0 if steps.isEmpty() or start.isEmpty() else math.ceil(math.log(tolerance) / math.log(damping))
    for i in range(1, rounds + 1):
        sent = state.join(steps, ["kind", "host"]).select("kind", F.col("to").alias("host"), (F.col("score") * F.col("p")).alias("score"))
        state = sent.unionAll(start).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if i % written_every == 0 or i == rounds:
            state = cut_lineage(state, "host-scores")
    return state


def blocked_hosts(scores: DataFrame, floor: float = 0.5) -> DataFrame:
    """host, of hosts whose share of distrust exceeds that of trust, and `floor` of an even share.

    Shares are compared to nine places, so that the order of a sum decides nothing.
    """
    totals = scores.agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("score"))).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("score"))).alias("distrust"),
    )
    hosts = scores.groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "trust", F.col("score"))), F.lit(0.0)).alias("trust"),
        F.coalesce(F.sum(F.when(F.col("kind") == "distrust", F.col("score"))), F.lit(0.0)).alias("distrust"),
    )
    number = hosts.agg(F.count(F.lit(1)).alias("n"))
    share = {k: F.coalesce(F.round(F.col(k) / totals.select(k).scalar(), 9), F.lit(0.0)) for k in ("trust", "distrust")}
    least = F.round(F.lit(floor) / number.scalar(), 9)
    return hosts.select("host", share["trust"].alias("trust"), share["distrust"].alias("distrust"), least.alias("least")).where("distrust > trust AND distrust >= least").select("host")


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, url: str = "url", html: str = "html", keep: Sequence[str] = ("page_id",), **how) -> DataFrame:
    """The kept columns with host, path, rule (its name or null) and verdict (allow, block)."""
    floor = how.pop("floor", 0.5)
    judged = judged_by_rules(pages, rules, url, keep)
    scores = propagate(host_edges(pages, url, html), seeds(judged_by_rules(pages, rules, url, ())), **how)
    blocked = cut_lineage(blocked_hosts(scores, floor), "blocked-hosts").select(F.col("host").alias("bad"))
    by_host = F.when(F.col("bad").isNull(), "allow").otherwise("block")
    return judged.join(blocked, F.col("host") == F.col("bad"), "left").select(
        *keep, "host", "path", "rule", F.coalesce("by_rule", by_host).alias("verdict")
    )


def url_query(pages: DataFrame) -> DataFrame:
    return judge_urls(pages)
