"""URL filters: fixed rules, and a path-template tree with smoothed labelled purity for the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the rules of the contract
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
BRANCHES = 64  # segments at one depth of a host from which they are variable
SMOOTH = 8.0
REJECT = 0.6
ALIKE = 1.96
UPPER, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = _after_scheme(url)
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOW)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null without one. Equal lengths: the longer host, then block."""
    parsed = [(v, r, r.partition("/")[0], "/" + r.partition("/")[2]) for v, r in rules]
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, text, h, p in sorted(parsed, key=lambda r: (len(r[1]), len(r[2]), r[0] == "block")):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def judge_urls(pages: DataFrame, rules=RULES, branches: int = BRANCHES, reject: float = REJECT) -> DataFrame:
    """page_id, host, path, rule, verdict, and the template and smoothed purity behind the method's verdicts.

    Rules decide first. Their verdicts also label the tree: each host's paths
    become segments, variable ones (digits, long or mixed ids, or a depth with
    more than `branches` segments) become `*`. Sibling leaves whose blocked
    share does not differ significantly from that of all of them are merged into
    one branch. A template's purity is its branch's blocked share, smoothed towards the same template over all hosts and that
    towards the share over all pages; from `reject` on its pages are blocked.
    A url that is null or has no `://` has an empty host and path and is judged
    by the purity of the empty template. A purity of just `reject` blocks; of
    rules of one length the longer host, then block, wins. Repeated rows are
    judged alike and count as often as they stand; very long urls are read
    whole; an empty table gives an empty one; other columns are not read.
    """
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    base = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    base = base.select("*", rule.alias("rule"), verdict.alias("ruled"))
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    variable = lambda s: F.when(s.rlike(r"[0-9]") | (F.length(s) > 24), F.concat(F.lit("*"), F.regexp_extract(s, r"\.[a-z]{2,5}$", 0))).otherwise(s)
    base = base.withColumn("steps", F.transform(segments, variable))

    counted = base.groupBy("host", "steps").agg(F.count("*").alias("n"), F.count("ruled").alias("m"), F.count_if(F.col("ruled") == "block").alias("b"))
    wide = counted.select("host", F.posexplode("steps").alias("depth", "step")).distinct().groupBy("host", "depth").agg(F.count("*").alias("k")).where(F.col("k") > branches)
    wide = wide.groupBy("host").agg(F.collect_set("depth").alias("wild"))  # at most a host's depth
    star = F.transform("steps", lambda s, i: F.when(F.array_contains(F.col("wild"), i), F.lit("*")).otherwise(s))
    tree = counted.join(wide, "host", "left").withColumn("template", F.when(F.col("wild").isNull(), F.col("steps")).otherwise(star))

    nodes = tree.groupBy("host", "template").agg(F.sum("m").alias("m"), F.sum("b").alias("b"))
    parent = F.when(F.size("template") > 0, F.slice(F.col("template"), 1, F.size("template") - 1)).otherwise(F.col("template"))
    nodes = nodes.select("*", parent.alias("parent"), F.size("template").alias("depth"))
    pool = nodes.groupBy("host", "parent", "depth").agg(F.sum("m").alias("pm"), F.sum("b").alias("pb"))
    nodes = nodes.join(pool, ["host", "parent", "depth"])
    share = (F.col("pb") + 1) / (F.col("pm") + 2)
    z = F.abs(F.col("b") / F.col("m") - share) / F.sqrt(share * (1 - share) / F.col("m"))
    merged = (F.col("m") > 0) & (z <= ALIKE)
    nodes = nodes.withColumn("merged", merged)
    # a merged branch holds what is alike, not the siblings that differ
    alike = nodes.where("merged").groupBy("host", "parent", "depth").agg(F.sum("m").alias("am"), F.sum("b").alias("ab"))
    nodes = nodes.join(alike, ["host", "parent", "depth"], "left")
    nodes = nodes.select("host", "template", F.when(F.col("merged"), F.col("am")).otherwise(F.col("m")).alias("m"), F.when(F.col("merged"), F.col("ab")).otherwise(F.col("b")).alias("b"), F.col("m").alias("own_m"), F.col("b").alias("own_b"))

    everywhere = nodes.groupBy("template").agg(F.sum("own_m").alias("gm"), F.sum("own_b").alias("gb"))
    root = nodes.agg(F.sum("own_m").alias("rm"), F.sum("own_b").alias("rb"))
    nodes = nodes.join(everywhere, "template").crossJoin(F.broadcast(root))  # one row
    base_share = (F.coalesce("rb", F.lit(0)) + 1) / (F.coalesce("rm", F.lit(0)) + 2)
    wide_share = (F.col("gb") + SMOOTH * base_share) / (F.col("gm") + SMOOTH)
    nodes = nodes.select("host", "template", ((F.col("b") + SMOOTH * wide_share) / (F.col("m") + SMOOTH)).alias("purity"))

    known = tree.select("host", "steps", "template").join(nodes, ["host", "template"])
    out = base.join(known, ["host", "steps"], "left")
    method = F.when(F.col("purity") >= reject, F.lit("block")).otherwise(F.lit("allow"))
    name = F.concat(F.lit("/"), F.array_join("template", "/"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), name.alias("template"), "purity")
