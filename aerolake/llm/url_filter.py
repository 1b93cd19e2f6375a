"""URL filter by association rules.

URLs become sets of tokens (host labels, path words, query names). Spark's FP-growth mines, over labelled URLs,
the token combinations that go with the label ``block``; rules are pruned by support and confidence, and a rule
whose part already is a rule of at least its confidence is dropped. Tokens that always occur together are one item.
Matching uses an inverted index: each rule is posted under its rarest class of tokens, so a URL meets only the rules
posted under one of its own tokens, and a candidate counts where the URL holds a token of each of the rule's classes.
URLs with equal token sets are matched once.

What mining can learn is bounded by its labels. Where the label table says nothing about URLs, that is the explicit
rules' own verdicts, carried over to hosts that no rule names. FP-growth lists all frequent combinations, so its cost
doubles with each token that nearly always, but not always, occurs with the others of one frequent URL shape and is
found in blocked and allowed URLs alike.

Explicit host/path rules come first; where one fits, the longest decides and labels the URL for mining. Other
URLs take their label from a label table where they have one.

Edge cases: a null URL or one without ``://`` has empty host and path, no tokens but query names, and is allowed;
repeated rows repeat; with no labelled URL or no surviving rule everything without an explicit rule is allowed;
an empty table gives an empty result. Output columns are fixed, so clashing extra columns are dropped.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import ascii_lower, written

MIN_SUPPORT = 0.002  # share of the labelled URLs that hold the rule
MIN_COUNT = 5  # and the least number of them
MIN_CONFIDENCE = 0.8
INDEX_BROADCAST_RULES = 20_000  # rules up to which the index is broadcast
BAD = "label=block"
# Parts over which the URLs of one token set are dealt when they meet their rule.
SALTS = 16


@dataclass(frozen=True)
class HostRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# Fixed values of the query.
HOST_RULES = (HostRule("allow", "org", "/"), HostRule("block", "example.org", "/es/"),
              HostRule("block", "example.org", "/en/1"), HostRule("allow", "com", "/fr/"),
              HostRule("block", "com", "/de/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    u = F.coalesce(url, F.lit(""))
    pattern = "://([^/?#]*)([^?#]*)"
    return ascii_lower(F.regexp_extract(u, pattern, 1)), F.regexp_extract(u, pattern, 2)


def explicit_rule(host: Column, path: Column, rules=HOST_RULES) -> tuple[Column, Column]:
    """(rule name, verdict) of the longest rule that fits; null where none does."""
    name = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, r.name) if name is None else name.when(fits, r.name)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    return name, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Sorted distinct tokens: ``h=`` host labels, ``p=`` path words (numbers as ``#``), ``q=`` query names."""
    def some(parts, tag):
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(tag), x))

    words = F.transform(F.split(ascii_lower(path), "[^a-z0-9-]+"), lambda x: F.when(x.rlike("^[0-9]+$"), "#").otherwise(x))
    query = ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1))
    names = F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, "^[^=]*", 0))
    return F.array_sort(F.array_distinct(F.concat(some(F.split(host, r"\."), "h="), some(words, "p="),
                                                  some(names, "q="))))


def mine_rules(labelled: DataFrame, tokens: str = "tokens", bad: str = "bad", min_support: float = MIN_SUPPORT,
               min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (rule string, needs, confidence, support) for ``bad``, pruned, from token sets and a boolean. ``needs`` lists
    classes of tokens: a URL fits where it holds a token of every class.

    Three exact reductions keep FP-growth from listing subsets that pruning would drop anyway. A token in too few bad
    URLs is in no rule. A token that only bad URLs hold is a rule by itself, and any rule with more tokens is redundant
    to it. Tokens in exactly the same URLs are one class and one item, because a rule with two of them is redundant to
    the rule with one. Every token that is left is in at least ``min_support`` of the URLs, so the table of them that
    reaches the driver has at most (mean tokens a URL) / ``min_support`` rows."""
    spark = labelled.sparkSession
    n = labelled.count()
    shape = "rule string, needs array<array<string>>, confidence double, support double"
    if n < min_count:
        return spark.createDataFrame([], shape)
    share = max(min_support, min_count / n)
    prints = [F.xxhash64(F.lit(seed), F.col(tokens)).cast("decimal(20,0)").alias(f"h{seed}") for seed in (1, 2)]
    # Equal counts and equal sums of two 64-bit hashes of the URLs' sets: the tokens are in the same URLs.
    held = labelled.select(F.explode(tokens).alias("t"), F.col(bad).alias("bad"), *prints).groupBy("t").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("n_bad"), F.sum("h1").alias("s1"), F.sum("h2").alias("s2")) \
        .where(F.col("n_bad") >= math.ceil(share * n)).collect()
    alone = [(r["t"], [[r["t"]]], 1.0, r["n_bad"] / n) for r in held if r["n"] == r["n_bad"]]
    classes: dict[tuple, list[str]] = {}
    for r in sorted(held, key=lambda r: r["t"]):
        if r["n"] > r["n_bad"]:
            classes.setdefault((r["n"], r["n_bad"], r["s1"], r["s2"]), []).append(r["t"])
    members = {c[0]: c for c in classes.values()}
    sure = spark.createDataFrame(alone, shape)
    if not members:
        return sure
    baskets = labelled.select(F.concat(F.filter(F.col(tokens), lambda t: t.isin(list(members))),
                                       F.when(F.col(bad), F.array(F.lit(BAD))).otherwise(F.array())).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=min_confidence,
                     numPartitions=int(spark.conf.get("spark.sql.shuffle.partitions"))).fit(baskets)
    rules = model.associationRules.where(F.col("consequent")[0] == BAD) \
        .select(F.array_sort("antecedent").alias("tokens"), "confidence", "support") \
        .withColumn("rule", F.array_join("tokens", " & "))
    rules = written(rules, "url-rules")
    # A rule is redundant where one of its proper subsets is a rule of at least its confidence. A subset is posted under
    # its rarest token and looked up through the tokens of the larger rule, never pairwise over all rules.
    part = _posted(rules, F.col("tokens")).join(rules, "rule").select(
        F.col("rule").alias("part"), F.col("tokens").alias("part_tokens"), F.col("confidence").alias("part_confidence"), "t")
    redundant = rules.select("rule", "tokens", "confidence", F.explode("tokens").alias("t")).join(part, "t") \
        .where((F.size("part_tokens") < F.size("tokens")) & (F.col("part_confidence") >= F.col("confidence"))
               & (F.size(F.array_except("part_tokens", "tokens")) == 0)).select("rule").distinct()
    whole = F.from_json(F.lit(json.dumps(members)), "map<string,array<string>>")
    return rules.join(redundant, "rule", "left_anti").select(
        "rule", F.transform("tokens", lambda t: F.try_element_at(whole, t)).alias("needs"), "confidence", "support") \
        .unionByName(sure)


def _posted(rules: DataFrame, tokens: Column) -> DataFrame:
    """(rule, t): the rarest of each rule's tokens among all rules, ties by name."""
    uses = rules.select("rule", F.explode(tokens).alias("t"))
    rarity = uses.groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    return uses.join(rarity, "t").groupBy("rule").agg(F.min(F.struct("n", "t"))["t"].alias("t"))


def match_rules(token_sets: DataFrame, rules: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Distinct token sets that a rule matches, with their best rule (confidence, support, fewer tokens, name). The rule
    is named by the least token of each class that the URL holds."""
    rules = written(rules, "url-index")
    n = rules.count()
    # The class of a rule that is rarest among all rules carries its posting, under each of its tokens.
    index = _posted(rules, F.transform("needs", lambda c: c[0])).join(rules.drop("t"), "rule") \
        .select("needs", "confidence", "support", F.explode(F.filter("needs", lambda c: c[0] == F.col("t"))[0]).alias("t"))
    if n <= INDEX_BROADCAST_RULES:
        index = F.broadcast(index)
    name = F.array_join(F.array_sort(F.transform(
        "needs", lambda c: F.array_min(F.array_intersect(c, F.col(tokens))))), " & ")
    best = F.min(F.struct((-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), F.size("needs").alias("n"),
                          name.alias("rule"), "confidence"))
    return token_sets.select(tokens).distinct() \
        .select(tokens, F.explode(tokens).alias("t")).join(index, "t") \
        .where(F.forall("needs", lambda c: F.arrays_overlap(c, F.col(tokens)))) \
        .groupBy(tokens).agg(best.alias("hit"))


def judge_urls(pages: DataFrame, labels: DataFrame | None = None, rules=HOST_RULES, key: str = "page_id",
               url: str = "url", label_key: str = "doc_id", label_bad: str = "toxic", **mining) -> DataFrame:
    """One row per page: key, host, path, explicit rule, mined rule and its confidence, verdict."""
    host, path = host_and_path(F.col(url))
    urls = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"),
                        url_tokens(F.col(url), host, path).alias("tokens"))
    name, verdict = explicit_rule(F.col("host"), F.col("path"), rules)
    urls = urls.withColumn("rule", name).withColumn("given", verdict)
    known = urls.where(F.col("given").isNotNull()).select("tokens", (F.col("given") == "block").alias("bad"))
    if labels is not None:
        marks = labels.where(F.col(label_key).isNotNull()).groupBy(F.col(label_key).alias("key")) \
            .agg(F.max(F.col(label_bad)).alias("mark")).where(F.col("mark").isNotNull())
        known = known.unionByName(urls.where(F.col("given").isNull()).join(marks, "key")
                                  .select("tokens", (F.col("mark") == 1).alias("bad")))
    mined = match_rules(urls, mine_rules(known, **mining)) \
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # Many pages of a large site share one token set: its pages are dealt over several tasks.
    salted = urls.withColumn("salt", F.pmod(F.xxhash64("key", "path"), F.lit(SALTS)).cast("int"))
    return salted.join(mined, ["tokens", "salt"], "left").select(
        F.col("key").alias(key), "host", "path", "rule",
        F.col("hit.rule").alias("mined_rule"), F.col("hit.confidence").alias("mined_confidence"),
        F.coalesce("given", F.when(F.col("hit").isNotNull(), "block").otherwise("allow")).alias("verdict"))
