"""URL filtering by mined association rules.

URLs become sets of tokens: host labels, path segments (digit runs as #), query
keys, fragment. Spark's FP-growth mines the token combinations of labelled URLs
(the label is an item of its own); rules "tokens -> label" of at least
``support`` and ``confidence`` stay, less those that a rule on fewer of their
tokens already gives as surely. An inverted
index keeps each rule under its rarest token, so a URL meets only rules whose
key it has; a rule fires if the URL has all its tokens. The surest rule decides
(then the better supported, the longer, block before allow); without one the
verdict is ``default``.

Given rules (host and path prefix) come first: a rule fits its host and all
subdomains if the path starts with the rule's; the longest wins. URLs that a
given rule fits are the labelled set of the registered query: the mining
carries the given rules' verdicts over to URLs that none of them fits. That set
is biased (a given rule picks hosts), so there a host label alone is no
evidence: such a rule leaves the default. Labels of a caller's own count fully.

DataFrame operations and pyspark.ml only. Verdicts are computed once per
distinct URL, so copies cost nothing; the index is broadcast only if Spark finds
it small.

Defined cases: null URLs and those without :// have empty host and path, no
rule and no host or path tokens; an empty host label is ignored; without
labelled URLs nothing is mined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from clientlens.llm.shared import ascii_lower, temp_name, written

#: Given rules, (rule, verdict); the host ends at the first slash.
RULES: tuple[tuple[str, str], ...] = (
    ("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LABEL = "="


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def given_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits, or null."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):  # the longest is tested first
        h, slash, p = rule.partition("/")
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(slash + p)
        out = F.when(fits, rule).otherwise(out)
    return out


def tokens(url: Column, host: Column, path: Column) -> Column:
    """The URL's distinct tokens."""
    labels = F.transform(F.filter(F.split(host, r"\."), lambda x: x != ""), lambda x: F.concat(F.lit("h:"), x))
    parts = F.transform(F.filter(F.split(path, "/"), lambda x: x != ""),
                        lambda x: F.concat(F.lit("p:"), F.regexp_replace(F.lower(x), "[0-9]+", "#")))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.regexp_extract_all(query, F.lit(r"(?:^|&)([^=&]+)"), F.lit(1)), lambda x: F.concat(F.lit("q:"), F.lower(x)))
    mark = F.when(F.contains(F.coalesce(url, F.lit("")), F.lit("#")), F.array(F.lit("f:"))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(labels, parts, keys, mark))


def mine(labelled: DataFrame, support: float = 0.002, confidence: float = 0.8, host_alone: bool = True) -> DataFrame:
    """``labelled``: (tokens, label). Returns (rule_id, needs, label,
    confidence, support). ``host_alone``: whether one host label may be a rule."""
    spark = labelled.sparkSession
    rows = written(labelled.select(F.array_append("tokens", F.concat(F.lit(LABEL), F.col("label"))).alias("items")), "url-baskets")
    if not rows.take(1):
        return spark.createDataFrame([], "rule_id long, needs array<string>, label string, confidence double, support double")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence, numPartitions=parts).fit(rows)
    found = model.associationRules.filter(F.col("consequent")[0].startswith(LABEL)
                                          & ~F.exists("antecedent", lambda x: x.startswith(LABEL)))
    found = written(found.select(F.array_sort("antecedent").alias("needs"), F.expr(f"substr(consequent[0], {len(LABEL) + 1})").alias("label"),
                                 "confidence", "support"), "url-rules")
    # a rule is redundant if one token less gives the same label as surely
    less = found.select(F.col("needs").alias("l_needs"), F.col("label").alias("l_label"), F.col("confidence").alias("l_conf"))
    wide = found.filter(F.size("needs") > 1).select("needs", "label", "confidence", F.explode("needs").alias("x")) \
        .select("needs", "label", "confidence", F.array_remove(F.col("needs"), F.col("x")).alias("l_needs"))
    spare = wide.join(less, "l_needs").filter("l_label = label and l_conf >= confidence").select("needs", "label").distinct()
    kept = found.join(spare, ["needs", "label"], "left_anti")
    if not host_alone:
        kept = kept.filter((F.size("needs") > 1) | ~F.col("needs")[0].startswith("h:"))
    return kept.withColumn("rule_id", F.xxhash64("needs", "label"))


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls``: distinct (url, tokens). (url, label, confidence, needs) of the
    rule that decides, for URLs on which one fires."""
    held = urls.select("url", "tokens", F.explode("tokens").alias("token"))
    count = held.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    keyed = rules.select("rule_id", F.explode("needs").alias("token")).join(count, "token", "left")
    key = keyed.groupBy("rule_id").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("token"))
    index = written(rules.join(key, "rule_id"), "url-index")
    fired = held.join(index, "token").filter(F.size(F.array_except("needs", "tokens")) == 0)
    best = fired.groupBy("url").agg(F.max(F.struct("confidence", "support", F.size("needs").alias("size"), "label", "needs")).alias("b"))
    return best.select("url", F.col("b.label").alias("label"), F.col("b.confidence").alias("confidence"), F.col("b.needs").alias("needs"))


def judge(pages: DataFrame, url: str = "url", rules: Sequence[tuple[str, str]] = RULES, labelled: DataFrame | None = None,
          default: str = "allow", **mining) -> DataFrame:
    """``pages`` with url_host, url_path, url_rule (given rule or null),
    url_verdict and url_mined (tokens of the mined rule that decided, or null).
    ``labelled``: (url, label) to learn from; by default the pages' URLs that a
    given rule fits, with its verdict."""
    src = pages.select(F.col(url).alias("url"))
    mining = {"host_alone": labelled is not None} | mining
    if labelled is None:
        host, path = host_of(F.col("url")), path_of(F.col("url"))
        rule = given_rule(host, path, rules)
        verdict = F.element_at(F.create_map(*[F.lit(x) for r in rules for x in r]), rule)
        labelled = src.filter(F.col("url").isNotNull() & rule.isNotNull()).select("url", verdict.alias("label"))
    learn = labelled.select(tokens(F.col("url"), host_of(F.col("url")), path_of(F.col("url"))).alias("tokens"), "label")
    mined = written(mine(learn, **mining), "url-kept")
    urls = src.filter("url is not null").distinct()
    urls = written(urls.select("url", tokens(F.col("url"), host_of(F.col("url")), path_of(F.col("url"))).alias("tokens")), "url-tokens")
    have = pages.drop("url_host", "url_path", "url_rule", "url_verdict", "url_mined")
    d_url, d_label, d_needs = (temp_name(have, c) for c in ("url", "label", "needs"))
    decided = match(urls, mined).select(F.col("url").alias(d_url), F.col("label").alias(d_label), F.col("needs").alias(d_needs))
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rule = given_rule(host, path, rules)
    by_rule = F.element_at(F.create_map(*[F.lit(x) for r in rules for x in r]), rule)
    out = have.join(decided, F.col(url) == F.col(d_url), "left")
    return out.select(*have.columns, host.alias("url_host"), path.alias("url_path"), rule.alias("url_rule"),
                      F.coalesce(by_rule, F.col(d_label), F.lit(default)).alias("url_verdict"),
                      F.when(rule.isNull(), F.col(d_needs)).alias("url_mined"))
