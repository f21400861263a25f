"""URL filtering by association rules.

Seed rules (host suffix, path prefix, verdict) decide what they fit; the longest
wins.  Their verdicts are the labels of the urls they fit, and from these alone Spark's
FP-growth mines token combinations that go with a block.  Rules below MIN_CONFIDENCE or
MIN_SUPPORT are pruned.  Against over-blocking, a combination must reach that support under
at least MIN_ORIGINS seed rules by itself: what goes with a block in one seed rule's area only
restates that rule and says nothing of other hosts.  A rule that contains another is left
out, as it blocks no more.  The urls no seed rule fits are judged by the mined rules: an
inverted index leads from each rule's rarest token to the rule, and a rule matches if all its
tokens are there.

Scale: urls are judged in one narrow pass up to the mined rules; rules are few by
construction (support bounds how many token sets can be frequent), and the index join
carries only distinct token sets that a rule's rarest token reaches.

Defined results: null urls, and those without ``://``, have empty host and path; no seed rule
fits them and, having no token, no mined rule either: they are allowed.  Repeated rows count
as often as they come and get equal results; of seed rules that fit equally long, the last in
order decides; without labelled rows, as in an empty table, no rule is mined; a long url is
only a longer list of tokens; columns of the input named like a result are replaced.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import materialize

#: The seed rules.
SEED = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
MIN_SUPPORT, MIN_CONFIDENCE, MIN_ORIGINS = 0.005, 0.8, 2


def host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lowered."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """Then up to ?, # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _fits(suffix: str, prefix: str) -> Column:
    return ((F.col("host") == suffix) | F.col("host").endswith(f".{suffix}")) & F.col("path").startswith(prefix)


def seeded(urls: DataFrame, rules: tuple = SEED) -> DataFrame:
    """The urls with host, path, ``rule`` (like ``net/``; the longest that fits, else null) and ``seed`` (its verdict)."""
    out = urls.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    rule, seed = F.lit(None).cast("string"), F.lit(None).cast("string")
    for suffix, prefix, verdict in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        rule = F.when(_fits(suffix, prefix), F.lit(suffix + prefix)).otherwise(rule)
        seed = F.when(_fits(suffix, prefix), F.lit(verdict)).otherwise(seed)
    return out.withColumns({"rule": rule, "seed": seed})


def tokens() -> Column:
    """Distinct tokens of host and path: top domain, domain, subdomains, and path parts with their numbers as ``#``."""
    labels = F.filter(F.split("host", "\\."), lambda x: x != "")
    n = F.size(labels)
    hosts = F.transform(labels, lambda x, i: F.concat(
        F.when(i == n - 1, F.lit("top:")).when(i == n - 2, F.lit("domain:")).otherwise(F.lit("sub:")), x))
    parts = F.transform(F.filter(F.split("path", "/"), lambda x: x != ""),
                        lambda x: F.concat(F.lit("path:"), F.regexp_replace(x, "[0-9]+", "#")))
    return F.array_sort(F.array_distinct(F.concat(hosts, parts)))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
         min_origins: int = MIN_ORIGINS) -> DataFrame:
    """(rule_id, needed, confidence, support) of the rules ``needed -> block`` from (tokens, label, origin).

    The label is one more item of the basket, and so is a block's origin (the seed rule it comes
    from); a rule that contains a smaller one that passed is dropped.
    """
    block = F.col("label") == "block"
    extra = F.filter(F.array(F.concat(F.lit("label:"), F.col("label")), F.when(block, F.concat(F.lit("from:"), F.col("origin")))),
                     lambda x: x.isNotNull())
    baskets = materialize(labelled.select(F.array_union("tokens", extra).alias("items")), "url-baskets")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    plain = lambda c: ~F.exists(c, lambda t: t.startswith("label:") | t.startswith("from:"))
    rules = model.associationRules.filter((F.element_at("consequent", 1) == "label:block") & plain("antecedent"))
    rules = rules.select(F.array_sort("antecedent").alias("needed"), "confidence", "support")
    # frequent sets of a rule's tokens and one origin
    sets = model.freqItemsets.withColumn("needed", F.filter("items", lambda t: ~t.startswith("from:")))
    sets = sets.filter((F.size("needed") == F.size("items") - 1) & plain("needed")).select(F.array_sort("needed").alias("needed"))
    wide = sets.groupBy("needed").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") >= min_origins).select("needed")
    rules = materialize(rules.join(wide, "needed").withColumn("rule_id", F.xxhash64("needed")), "url-rules")
    # smaller rules inside a rule share a token with it
    small = rules.select(F.explode("needed").alias("t"), F.col("needed").alias("inner"))
    covered = (rules.select("rule_id", "needed", F.explode("needed").alias("t")).join(small, "t")
               .filter((F.size("inner") < F.size("needed")) & (F.size(F.array_except("inner", "needed")) == 0)).select("rule_id").distinct())
    return materialize(rules.join(covered, "rule_id", "left_anti").select("rule_id", "needed", "confidence", "support"), "url-mined")


def match(sets: DataFrame, rules: DataFrame, counts: DataFrame) -> DataFrame:
    """(tokens) of the distinct token sets that some rule matches, by an inverted index on the rules' rarest tokens."""
    n = rules.select("rule_id", "needed", F.explode("needed").alias("t")).join(counts, "t", "left")
    index = n.groupBy("rule_id").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "t")).alias("x"),
                                     F.first("needed").alias("needed")).select(F.col("x.t").alias("t"), "needed")
    hits = sets.select("tokens", F.explode("tokens").alias("t")).join(index, "t")
    return hits.filter(F.size(F.array_except("needed", "tokens")) == 0).select("tokens").distinct()


def judge(urls: DataFrame, labelled: DataFrame | None = None, rules: tuple = SEED, **kw) -> DataFrame:
    """The urls with host, path, rule and verdict.

    ``labelled`` (tokens, label: block or another, origin) replaces the labels that the seed rules give.
    """
    own = urls.columns
    seen = seeded(urls.select(F.struct(*[urls[c] for c in own]).alias("_row"), urls["url"].alias("url")), rules)
    seen = seen.withColumn("tokens", tokens())
    if labelled is None:
        labelled = seen.filter("seed is not null").select("tokens", F.col("seed").alias("label"), F.col("rule").alias("origin"))
    mined = mine(labelled, **kw)
    open_ = seen.filter("seed is null").groupBy("tokens").agg(F.count(F.lit(1)).alias("n"))
    open_ = materialize(open_, "url-open")
    counts = open_.select("n", F.explode("tokens").alias("t")).groupBy("t").agg(F.sum("n").alias("n"))
    bad = materialize(match(open_.select("tokens"), mined, counts), "url-blocked")
    bad = bad.select(F.col("tokens").alias("_tokens"))
    out = seen.join(bad, seen["tokens"] == bad["_tokens"], "left")
    verdict = F.coalesce("seed", F.when(F.col("_tokens").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return out.select(*[F.col("_row").getField(c).alias(c) for c in own if c not in ("host", "path", "rule", "verdict")],
                      "host", "path", "rule", verdict.alias("verdict"))
