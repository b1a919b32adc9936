"""URL filters by link-graph propagation (operator 1).

Rules (host and path prefix, allow or block) decide the pages they fit; the longest
fitting rule wins.  Other pages are decided by their host: trust is a personalised
PageRank that starts at hosts with allowed pages and follows links forward; distrust
starts at hosts with blocked pages and follows links backward, from a page's host to
those that link to it.  Both run over one table of weighted host arcs in the same
join; each round's scores are written to the shared folder, the round before's deleted.
Rounds go on until no host is reached for the first time and the scores of all hosts
together grow by at most TOLERANCE; what is still to come is then at most
DAMPING / (1 - DAMPING) times that.  A host is blocked when its distrust reaches ``threshold`` times its trust, and allowed
otherwise, so hosts that no seed reaches are allowed.

Links are a page's ``href`` values with a scheme or beginning with ``//``; a relative link
stays on its host and carries nothing, so pages that hold no other links leave the rules and
the hosts' own seeds to decide.  Arcs are counted with map-side combine, so a host with a third of all
pages is one row per task; the joins are plain equi-joins for Spark to split or not.

Defined results: a null url or one without ``://`` has empty host and path, fits no rule
and is allowed; a null html has no links; repeated pages count again as seeds and
links; an empty table gives an empty result.  Only page_id, url and html are read.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalytics.llm.common import cut_lineage, drop_stage
from catalytics.sources.io import staged_path

#: rule -> verdict; a rule is a host and the beginning of a path.
RULES = {
    "org/": "allow",
    "example.org/es/": "block",
    "example.org/en/1": "block",
    "com/fr/": "allow",
    "com/de/": "block",
}
#: Summed growth of all scores at which rounds end; the scores of each kind sum up to 1 at most.
TOLERANCE = 1e-9
DAMPING = 0.85
THRESHOLD = 1.0
#: Rules become one expression, so there is a bound on how many.
MAX_RULES = 1000


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits (of equally long ones the last by name), else null."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, slash, rest = rule.partition("/")
        on_host = (host == name) | F.endswith(host, F.lit("." + name))
        found = F.when(on_host & F.startswith(path, F.lit(slash + rest)), F.lit(rule)).otherwise(found)
    return found


def verdict_of(rule: Column, rules: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for verdict in sorted(set(rules.values())):
        out = F.when(rule.isin([r for r, v in rules.items() if v == verdict]), verdict).otherwise(out)
    return out


def judged_pages(pages: DataFrame, rules: dict[str, str]) -> DataFrame:
    out = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    out = out.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    return out.withColumn("by_rule", verdict_of(F.col("rule"), rules))


def host_links(pages: DataFrame) -> DataFrame:
    """(source, target, links) between different hosts."""
    found = F.regexp_extract_all(F.coalesce(F.col("html"), F.lit("")), F.lit(r"""(?i)href\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""), F.lit(1))
    rows = pages.select(host_of(F.col("url")).alias("source"), F.explode(found).alias("link"))
    # a link without a scheme has its page's; the host is the same with any
    link = F.when(F.startswith("link", F.lit("//")), F.concat(F.lit("http:"), "link")).otherwise(F.col("link"))
    rows = rows.select("source", host_of(link).alias("target"))
    return rows.filter("source <> '' and target <> '' and source <> target").groupBy("source", "target").agg(F.count(F.lit(1)).alias("links"))


def propagate(links: DataFrame, seeds: DataFrame, rounds: int | None = None, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust); ``rounds`` of them, or as many as it takes.

    ``links``: source, target, links.  ``seeds``: host, allowed, blocked (weights).  A
    score starts as (1 - damping) * its own share of the seeds, and each round is that
    plus damping * what arcs bring; an arc brings its share of its origin's outgoing
    weight.  Without any arc the start is what every round would give.
    """
    forward = links.select(F.lit("trust").alias("kind"), F.col("source").alias("at"), F.col("target").alias("to"), "links")
    backward = links.select(F.lit("distrust").alias("kind"), F.col("target").alias("at"), F.col("source").alias("to"), "links")
    arcs = forward.unionByName(backward)
    arcs = arcs.join(arcs.groupBy("kind", "at").agg(F.sum("links").alias("all")), ["kind", "at"])
    arcs = cut_lineage(arcs.select("kind", "at", "to", (F.col("links") / F.col("all")).alias("share")), "arcs")
    weights = seeds.select("host", F.explode(F.create_map(F.lit("trust"), F.col("allowed"), F.lit("distrust"), F.col("blocked"))).alias("kind", "weight"))
    sums = weights.groupBy("kind").agg(F.sum("weight").alias("total"))  # two rows
    start = weights.filter("weight > 0").join(F.broadcast(sums), "kind")
    start = cut_lineage(start.select("kind", F.col("host").alias("at"), ((1 - damping) * F.col("weight") / F.col("total")).alias("score")), "seeds")
    size = F.struct(F.count(F.lit(1)).alias("reached"), F.coalesce(F.sum("score"), F.lit(0.0)).alias("sum"))
    scores, before = start, start.agg(size.alias("size")).first()["size"]
    for _ in range(0) if arcs.isEmpty() else count() if rounds is None else range(rounds):
        brought = scores.join(arcs, ["kind", "at"]).select("kind", F.col("to").alias("at"), (damping * F.col("score") * F.col("share")).alias("score"))
        last, scores = scores, cut_lineage(start.unionByName(brought).groupBy("kind", "at").agg(F.sum("score").alias("score")), "scores")
        old = staged_path(last) if last is not start else None
        if old:
            drop_stage(links.sparkSession, old)
        # scores and reached hosts only ever grow
        now = scores.agg(size.alias("size")).first()["size"]
        if rounds is None and now["reached"] == before["reached"] and now["sum"] - before["sum"] <= tolerance:
            break
        before = now
    return scores.groupBy(F.col("at").alias("host")).agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("score")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(0.0)).alias("distrust"),
    )


def judge(pages: DataFrame, rules: dict[str, str] | None = None, threshold: float = THRESHOLD, rounds: int | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust for every page."""
    rules = RULES if rules is None else rules
    judged = judged_pages(pages, rules)
    seeds = judged.filter("host <> ''").groupBy("host").agg(
        F.count_if(F.col("by_rule") == "allow").cast("double").alias("allowed"),
        F.count_if(F.col("by_rule") == "block").cast("double").alias("blocked"),
    )
    scores = cut_lineage(propagate(host_links(pages), seeds, rounds), "hosts")
    of_host = F.when((F.col("distrust") > 0) & (F.col("distrust") >= threshold * F.col("trust")), "block").otherwise("allow")
    out = judged.join(scores, "host", "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("trust", "distrust")}
    return out.withColumns(zero).select("page_id", "host", "path", "rule", F.coalesce("by_rule", of_host).alias("verdict"), "trust", "distrust")
