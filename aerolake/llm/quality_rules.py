"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger stores the measurements and one failure bit per rule;
versioned policies are bit masks over it, so a verdict is ``bits & mask = 0`` and re-judging the corpus under
another policy, or asking what each rule costs, never reads a text again.

All of it is DataFrame expressions without a shuffle: the repeated 5-word windows of a text are found inside
its row (hash the windows, and only for texts with equal hashes sort (hash, position) and merge positions).

Edge cases: null, empty and blank texts have no words and fail ``few_words``; repeated rows each get their row;
an empty table gives an empty ledger; measurements are named columns, so clashing input columns are dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import BLANKS, words_of, written

WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """A failure condition over measurements, as SQL. Its position in ``RULES`` is its bit."""
    name: str
    fails: str


RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("shouting", "2 * n_upper > word_chars"),
    Rule("exclamations", "2 * n_exclamations > n_words"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 12 * n_words"),
    Rule("digits", "2 * n_digits > word_chars"),
)
BASE = ("few_words", "repeated_windows")
# Versioned policies: the rules whose failure rejects a document. The last one is in force.
POLICIES = {
    1: BASE,
    2: BASE + ("symbols", "repeated_lines", "shouting", "exclamations"),
    3: tuple(r.name for r in RULES),
}
CURRENT = max(POLICIES)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper",
            "n_exclamations", "n_digits")


def mask_of(names) -> int:
    at = {r.name: i for i, r in enumerate(RULES)}
    return sum(1 << at[n] for n in set(names))


def _windows(words: Column) -> Column:
    """xxhash64 of each window of five words."""
    n = F.size(words)
    starts = F.when(n >= WINDOW, F.sequence(F.lit(0), n - WINDOW)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))


def measure(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus the measurements of each document's whole text."""
    t = F.col("__text")
    lines = F.filter(F.split(t, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text")) \
        .withColumn("__words", words_of(t)) \
        .withColumn("__lines", lines) \
        .withColumn("__hash", _windows(F.col("__words")))
    h = F.col("__hash")
    # Only texts with two equal windows pay for the sort.
    out = out.withColumn("__sorted", F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(
        F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    s = F.col("__sorted")
    out = out.withColumn("__at", F.sort_array(F.filter(F.transform(s, lambda e, k: F.when(
        (F.get(s, k - 1)["h"] == e["h"]) | (F.get(s, k + 1)["h"] == e["h"]), e["i"])), lambda p: p.isNotNull())))
    at = F.col("__at")
    covered = F.aggregate(F.transform(at, lambda p, k: F.least(
        F.lit(WINDOW), F.coalesce(F.get(at, k + 1), p + WINDOW) - p)), F.lit(0), lambda a, x: a + x)
    long = lambda c: c.cast("bigint")
    return out.select(
        *keep,
        long(F.size("__words")).alias("n_words"),
        long(F.length(t) - F.regexp_count(t, F.lit(BLANKS))).alias("word_chars"),
        long(F.regexp_count(t, F.lit(r"[#*$%&|<>]"))).alias("n_symbols"),
        long(F.size("__lines")).alias("n_lines"),
        long(F.size("__lines") - F.size(F.array_distinct("__lines"))).alias("n_dup_lines"),
        long(F.coalesce(covered, F.lit(0))).alias("n_repeat_words"),
        long(F.regexp_count(t, F.lit(r"\p{Lu}"))).alias("n_upper"),
        long(F.regexp_count(t, F.lit("!"))).alias("n_exclamations"),
        long(F.regexp_count(t, F.lit("[0-9]"))).alias("n_digits"))


def ledger(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Measurements plus ``fail_bits``: bit i is set when ``RULES[i]`` fails."""
    measured = measure(docs, text, keep)
    # A zero that Spark takes for non-deterministic: a filter on the bits stays above the measurements instead of
    # being rewritten into them, which would copy every measurement into every rule.
    bits = F.monotonically_increasing_id().bitwiseAND(F.lit(0).cast("bigint"))
    for i, rule in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint"))
    return measured.withColumn("fail_bits", bits)


def verdict(policy: int = CURRENT, bits: str = "fail_bits") -> Column:
    """True where no rule of the policy fails."""
    return F.col(bits).bitwiseAND(F.lit(mask_of(POLICIES[policy])).cast("bigint")) == 0


def apply_policy(led: DataFrame, policy: int = CURRENT) -> DataFrame:
    """A ledger with ``policy`` (the version that judged), ``base_failed`` and ``kept`` (never true where the base
    fails)."""
    base = F.col("fail_bits").bitwiseAND(F.lit(mask_of(BASE)).cast("bigint")) != 0
    return led.withColumn("policy", F.lit(policy)).withColumn("base_failed", base) \
        .withColumn("kept", ~base & verdict(policy))


def stored_ledger(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ledger, written once to the shared folder and read from there: every policy and every ablation applied to it
    reads measurements and bits, never a text."""
    return written(ledger(docs, text, keep), "quality-ledger")


def judge(docs: DataFrame, policy: int = CURRENT, text: str = "text",
          keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``apply_policy`` in the same pass as the measurements, where one verdict is all that is asked."""
    return apply_policy(ledger(docs, text, keep), policy)


def ablation(led: DataFrame, policies: dict[int, tuple[str, ...]] | None = None) -> DataFrame:
    """What each rule of each policy does: documents it fails, documents only it rejects, and documents the
    policy keeps with and without it. One aggregation by failure pattern (at most 2^rules rows), then bitwise
    arithmetic on the patterns."""
    policies = policies or POLICIES
    patterns = led.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    cells = F.array(*[F.struct(F.lit(v).alias("policy"), F.lit(name).alias("rule"),
                               F.lit(mask_of([name])).cast("bigint").alias("bit"),
                               F.lit(mask_of(names)).cast("bigint").alias("mask"))
                      for v, names in sorted(policies.items()) for name in names])
    hit = F.col("fail_bits").bitwiseAND(F.col("mask"))
    count = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("bigint")
    return patterns.select("fail_bits", "n", F.inline(cells)).groupBy("policy", "rule").agg(
        count(F.col("fail_bits").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        count(hit == F.col("bit")).alias("n_only"),
        count(hit == 0).alias("n_kept"),
        count(hit.bitwiseAND(F.bitwise_not(F.col("bit"))) == 0).alias("n_kept_without"))
