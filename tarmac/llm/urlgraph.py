"""URL filtering: rules by host and path, and trust propagated over links between hosts.

Rules decide where they fit. For the rest, trust is a personalised PageRank that
starts from hosts with allowed pages and follows links; distrust starts from hosts
with blocked pages and follows links backwards, as who links to a bad host is
suspect. A host whose distrust exceeds its trust is blocked.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import materialise

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, the earlier of equally long ones; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for _, rule in sorted(enumerate(rules), key=lambda r: (len(r[1].text), -r[0])):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        name, verdict = F.when(fits, rule.text).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


#: Absolute and scheme-relative targets of links, cut where ``host_of`` cuts or the attribute ends. A host named in plain text is no link.
_TARGET = r"""(?i)(?:href|src)\s*=\s*["']?(?:https?:)?//([^/?#"'>\s]+)"""


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, links) between different hosts, from whole pages (host, html)."""
    found = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(_TARGET), F.lit(1))
    targets = pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(F.array_distinct(F.transform(found, lambda h: F.translate(h, _UPPER, _LOWER)))).alias("dst"))
    return targets.where("src <> dst and dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("links"))


#: Rounds go on until the scores of a kind change by no more than this in sum, where all of a kind's scores sum to 1 at most.
TOLERANCE = 1e-8
MOST_ROUNDS = 5000


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int | None = 12, damping: float = 0.85) -> DataFrame:
    """(kind, host, score) by personalised PageRank of each kind.

    ``edges`` (kind, src, dst, links); ``seeds`` (kind, host, weight), whose weights
    are scaled to sum to 1 for each kind. A walk that reaches a host without links
    ends there. Each round is stored, so a lost executor costs one round. With
    ``rounds=None`` they go on until the summed absolute change is at most ``TOLERANCE`` and no further host
    is reached; after ``MOST_ROUNDS`` that is an error.
    """
    out = edges.groupBy("kind", "src").agg(F.sum("links").alias("all_links"))
    moves = materialise(edges.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("links") / F.col("all_links")).alias("share")))
    total = seeds.groupBy("kind").agg(F.sum("weight").alias("total"))
    start = materialise(seeds.groupBy("kind", "host").agg(F.sum("weight").alias("weight")).join(total, "kind").select(
        "kind", "host", (F.col("weight") / F.col("total")).alias("score")))
    restart = start.select("kind", "host", (F.col("score") * (1 - damping)).alias("score"))
    ranks = start
    for _ in range(MOST_ROUNDS if rounds is None else rounds):
        moved = ranks.join(moves, (ranks["kind"] == moves["kind"]) & (ranks["host"] == moves["src"])).select(
            moves["kind"], F.col("dst").alias("host"), (F.col("score") * F.col("share") * damping).alias("score"))
        arrived = moved.unionByName(restart).withColumn("old", F.lit(None).cast("double"))
        before = ranks.select("kind", "host", F.lit(0.0).alias("score"), F.col("score").alias("old"))
        # a host is at its old place too, so the change needs no join
        ranks = materialise(arrived.unionByName(before).groupBy("kind", "host").agg(F.sum("score").alias("score"), F.sum("old").alias("old")))
        if rounds is None:
            moved_by, reached = ranks.agg(F.sum(F.abs(F.col("score") - F.coalesce("old", F.lit(0.0)))), F.count(F.when(F.col("old").isNull(), 1))).first()
            if (moved_by or 0.0) <= TOLERANCE and not reached:
                break
        ranks = ranks.select("kind", "host", "score")
    else:
        if rounds is None:
            raise RuntimeError(f"scores did not settle in {MOST_ROUNDS} rounds")
    return ranks.select("kind", "host", "score")


def judge(pages: DataFrame, rules: list[Rule], rounds: int | None = None, damping: float = 0.85, threshold: float = 1.0) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, host, path, rule, verdict, trust and distrust.

    Where no rule fits, a host is blocked if its distrust exceeds ``threshold`` times
    its trust; a host that neither reaches, and a page without a host, is allowed. A null html
    has no links. Repeated rows stay; an empty table gives an empty result. Scores are those
    of ``rounds`` rounds if given, else settled ones.
    """
    at = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    name, verdict = fitting(F.col("host"), F.col("path"), rules)
    at = at.withColumns({"rule": name, "ruled": verdict})
    judged = at.drop("html")
    edges = materialise(host_edges(at))
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "links").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "links"))
    seeds = judged.where("ruled is not null and host <> ''").groupBy("host", "ruled").agg(F.lit(1.0).alias("weight")).select(
        F.when(F.col("ruled") == "allow", "trust").otherwise("distrust").alias("kind"), "host", "weight")
    ranks = propagate(both, seeds, rounds, damping)
    hosts = materialise(ranks.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("score")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(0.0)).alias("distrust")))
    whole = judged.join(hosts, "host", "left").withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust")})
    return whole.select("page_id", "host", "path", "rule", F.coalesce(
        "ruled", F.when(F.col("distrust") > F.col("trust") * threshold, "block").otherwise("allow")).alias("verdict"), "trust", "distrust")
