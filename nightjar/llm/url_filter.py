"""URL filter by link-graph propagation.

Rules (host, path) decide the urls they fit. For all others the host decides:
personalised PageRank over the host graph spreads trust from trusted seeds
along links, and distrust from blocked seeds along reversed links (a site
that links to blocked ones is suspect). A host's score is distrust / (trust +
distrust); over the threshold its other urls are blocked. A host that neither
trust nor distrust reaches is allowed.

Seeds are the hosts of which the rules decide more than half of the pages,
one way. Edges are the distinct links between different hosts, found in the
pages. Both propagations share the iterations: forward and reversed edges are
one table, ranks are combined before each shuffle, and every round's ranks
are written to the shared folder. Rounds go on until no host's rank changes by
more than TOLERANCE of itself, so that far hosts, whose ranks are small, are
reached and their scores settle too.

Defined cases: a null url, or one without ``://``, has an empty host and path
and is allowed unless a rule fits; null html has no links; repeated rows are
judged alike and count as pages; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightjar.llm.tables import materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DAMPING = 0.85
TOLERANCE = 1e-6
SMALLEST = 1e-290                    # ranks under it have too few digits to settle
MAX_ROUNDS = 10_000                  # only against endless loops: more is an error
THRESHOLD = 0.5


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The production rules.
RULES = (Rule("org", "/", "allow"), Rule("example.org", "/es/", "block"), Rule("example.org", "/en/1", "block"),
         Rule("com", "/fr/", "allow"), Rule("com", "/de/", "block"))


def url_host(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lowered."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _first_rule(rules, host: Column, path: Column) -> Column:
    """Name of the longest rule that fits."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(r.name)).otherwise(out)
    return out


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, url, host, path, rule, ruled (the rule's verdict)."""
    url = F.col("url").cast("string")
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), url_host(url).alias("host"),
                     url_path(url).alias("path"))
    p = p.withColumn("rule", _first_rule(rules, F.col("host"), F.col("path")))
    ruled = F.lit(None).cast("string")
    for r in rules:
        ruled = F.when(F.col("rule") == r.name, F.lit(r.verdict)).otherwise(ruled)
    return p.withColumn("ruled", ruled)


def host_edges(pages: DataFrame) -> DataFrame:
    """Distinct links src -> dst between different hosts."""
    found = F.regexp_extract_all(F.coalesce(F.col("html").cast("string"), F.lit("")),
                                 F.lit(r"(?i)\bhref\s*=\s*[\"']?\s*((?:https?:)?//[^/?#\"'\s>]+)"), F.lit(1))
    link = F.regexp_replace(F.col("link"), r"^(?:[A-Za-z]+:)?//", "")
    return (pages.select(url_host(F.col("url").cast("string")).alias("src"), F.explode(found).alias("link"))
            .select("src", F.translate(link, UPPER, UPPER.lower()).alias("dst"))
            .where("src != dst AND src != '' AND dst != ''").distinct())


def seeds(pages: DataFrame) -> DataFrame:
    """kind (0 trust, 1 distrust), host, seed (each kind sums to 1), from
    ``judged`` pages."""
    n = F.count(F.lit(1))
    by = (pages.where("host != ''").groupBy("host")
          .agg(n.alias("n"), F.count_if(F.col("ruled") == "allow").alias("allowed"),
               F.count_if(F.col("ruled") == "block").alias("blocked")))
    kind = F.when(F.col("allowed") * 2 > F.col("n"), 0).when(F.col("blocked") * 2 > F.col("n"), 1)
    by = by.select("host", kind.alias("kind")).where("kind IS NOT NULL")
    size = by.groupBy(F.col("kind").alias("s_kind")).agg(F.count(F.lit(1)).alias("s_n"))
    return by.join(F.broadcast(size), F.col("kind") == F.col("s_kind")).select(     # two rows at most
        "kind", "host", (F.lit(1.0) / F.col("s_n")).alias("seed"))


def propagate(edges: DataFrame, seed: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE,
              max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """kind, host, rank: personalised PageRank along links from the seeds of
    kind 0, along reversed links from those of kind 1. What hosts without
    outgoing edges hold goes back to the seeds. Ends when every rank changes
    by less than ``tolerance`` of itself; over ``max_rounds`` is an error."""
    both = edges.select(F.lit(0).alias("kind"), "src", "dst").unionByName(
        edges.select(F.lit(1).alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst")))
    degree = both.groupBy(F.col("kind").alias("d_kind"), F.col("src").alias("d_src")).agg(
        F.count(F.lit(1)).alias("degree"))
    out = materialize(both.join(degree, (F.col("kind") == F.col("d_kind")) & (F.col("src") == F.col("d_src")))
                      .select("kind", "src", "dst", "degree"), "op8-edges")
    seed = materialize(seed, "op8-seeds")
    rank = seed.withColumnRenamed("seed", "rank")
    if out.isEmpty():
        return rank
    for _ in range(max_rounds):
        r = rank.select(F.col("kind").alias("r_kind"), F.col("host").alias("r_host"), "rank")
        moved = (out.join(r, (F.col("kind") == F.col("r_kind")) & (F.col("src") == F.col("r_host")))
                 .groupBy("kind", F.col("dst").alias("host")).agg(F.sum(F.col("rank") / F.col("degree")).alias("got")))
        arrived = {x.kind: x.s for x in moved.groupBy("kind").agg(F.sum("got").alias("s")).collect()}   # two rows
        lost = F.when(F.col("kind") == 0, F.lit(1.0 - arrived.get(0, 0.0))).otherwise(F.lit(1.0 - arrived.get(1, 0.0)))
        back = seed.withColumn("got", F.col("seed") * ((1 - damping) / damping + lost)).select("kind", "host", "got")
        new = moved.unionByName(back).groupBy("kind", "host").agg((F.sum("got") * damping).alias("rank"))
        new = materialize(new, "op8-rank")
        old = rank.select("kind", "host", (-F.col("rank")).alias("change"), F.lit(0.0).alias("rank"))
        both = new.select("kind", "host", F.col("rank").alias("change"), "rank").unionByName(old)
        change = (both.groupBy("kind", "host").agg(F.abs(F.sum("change")).alias("d"), F.sum("rank").alias("rank"))
                  .agg(F.max(F.when(F.col("d") > 0, F.col("d") / F.greatest("rank", F.lit(SMALLEST)))
                             .otherwise(0.0))).first()[0] or 0.0)
        rank = new
        if change < tolerance:
            return rank
    raise RuntimeError(f"ranks have not settled after {max_rounds} rounds")


def host_verdicts(rank: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """host, score, blocked."""
    return (rank.groupBy("host").agg(F.sum(F.when(F.col("kind") == 1, F.col("rank")).otherwise(0.0)).alias("distrust"),
                                     F.sum("rank").alias("both"))
            .select("host", (F.col("distrust") / F.col("both")).alias("score"))
            .withColumn("blocked", F.col("score") > threshold))


def filter_urls(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, url, host, path, rule, verdict; only urls without a rule are
    joined with the hosts."""
    j = judged(pages, rules)
    hosts = host_verdicts(propagate(host_edges(pages), seeds(j)), threshold)
    bad = materialize(hosts.where("blocked").select(F.col("host").alias("b_host")), "op8-blocked")
    cols = ["page_id", "url", "host", "path", "rule"]
    ruled = j.where("ruled IS NOT NULL").select(*cols, F.col("ruled").alias("verdict"))
    rest = j.where("ruled IS NULL")
    if bad.isEmpty():
        return ruled.unionByName(rest.select(*cols, F.lit("allow").alias("verdict")))
    rest = rest.join(bad, F.col("host") == F.col("b_host"), "left").select(
        *cols, F.when(F.col("b_host").isNull(), "allow").otherwise("block").alias("verdict"))
    return ruled.unionByName(rest)
