"""Benchmark decontamination by SimHash of item-sized windows.

Texts and items are normalised to lower-case words of letters and digits and read as five-word shingles, each
weighing its characters. A document window as long as an item is fingerprinted (64-bit weighted SimHash) and
looked up among the items of that length through multi-index Hamming blocks: the fingerprint is cut into eight
bytes, and two fingerprints within distance 23 have at least one byte within distance 2, so an index of each item
under every byte value within 2 of its own finds all of them. Candidates are then verified exactly by weighted
Jaccard similarity of their shingles, 0.8 or more.

Only windows that can verify are fingerprinted: they must share a shingle with the item, and that shingle's place
in the item fixes where the window starts. A window at similarity 0.8 lies near distance 10; the radius of 23 is
more than four standard deviations beyond, and tests hold the result against exact comparison.

The benchmark is small against the corpus: its shingles and its index are broadcast where their counted rows stay
below ``BROADCAST_ROWS``, and joined by shuffle beyond. Documents are never shuffled, only their found windows.

Edge cases: null and empty texts match nothing; items of one to four words have no shingle and are found where they are
a document's whole word sequence (inside longer texts so few words prove nothing); items without words match nothing;
a window that reaches over an end of the text is cut there; repeated rows (same key and text) give one result;
a null key is kept as a null; empty tables give no rows. Only key and text of either table are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import bounded, written

SHINGLE = 5
THRESHOLD = 0.8
BLOCKS, BLOCK_BITS, BLOCK_RADIUS = 8, 8, 2
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
BROADCAST_ROWS = 2_000_000


def normal_words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingles(words: Column) -> Column:
    """Distinct five-word shingles; none for fewer words."""
    starts = F.when(F.size(words) >= SHINGLE, F.sequence(F.lit(1), F.size(words) - (SHINGLE - 1))) \
        .otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(words, i, SHINGLE), " ")))


def weight(grams: Column) -> Column:
    """Characters of all shingles."""
    return F.aggregate(grams, F.lit(0), lambda a, g: a + F.length(g))


def simhash(grams: Column) -> Column:
    """64-bit SimHash of shingles weighted by their characters."""
    cells = F.transform(grams, lambda g: F.struct(F.xxhash64(g).alias("h"), F.length(g).alias("w")))

    def bit(b):
        vote = F.aggregate(cells, F.lit(0), lambda a, c: a + F.when(
            F.shiftrightunsigned(c["h"], b).bitwiseAND(F.lit(1)) == 1, c["w"]).otherwise(-c["w"]))
        return F.when(vote > 0, F.shiftleft(F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint"))

    out = bit(0)
    for b in range(1, 64):
        out = out.bitwiseOR(bit(b))
    return out


def _block(fingerprint: Column, b: int) -> Column:
    return F.shiftrightunsigned(fingerprint, b * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def benchmark_items(bench: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """Items with a shingle: item, its words, length, shingles, weight and fingerprint; ``item_row`` tells items apart,
    also those without a key."""
    words = bench.select(F.col(key).alias("item"), normal_words(F.col(text)).alias("item_words")).distinct() \
        .where(F.size("item_words") >= SHINGLE).withColumn("item_row", F.xxhash64("item", "item_words"))
    return words.withColumn("length", F.size("item_words")).withColumn("item_grams", shingles(F.col("item_words"))) \
        .withColumn("item_weight", weight(F.col("item_grams"))) \
        .withColumn("item_print", simhash(F.col("item_grams")))


def short_copies(docs: DataFrame, bench: DataFrame, key: str = "doc_id", text: str = "text",
                 item_key: str = "item_id") -> DataFrame:
    """(row, key, item, similarity 1) of documents whose word sequence is an item of one to four words."""
    few = lambda df, c: df.where(F.size(F.split(F.coalesce(F.col(c), F.lit("")), r"[^\p{L}\p{N}]+", SHINGLE + 2))
                                 < SHINGLE + 2)
    items = few(bench, "text").select(F.col(item_key).alias("item"), normal_words(F.col("text")).alias("words")) \
        .where(F.size("words").between(1, SHINGLE - 1)).distinct()
    return few(docs, text).select(F.xxhash64(key, text).alias("row"), F.col(key).alias("key"),
                                  normal_words(F.col(text)).alias("words")) \
        .join(bounded(items), "words").select("row", "key", "item", F.lit(1.0).alias("similarity"))


def windows(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Distinct item-sized windows that share a shingle with an item of that length, aligned on it:
    (row, key, length, first, words); ``row`` tells apart texts of one key."""
    def hashed(words, at):
        return F.xxhash64(*[F.get(words, at + k) for k in range(SHINGLE)])

    anchors = items.select("length", "item_words", F.explode(F.sequence(F.lit(0), F.col("length") - SHINGLE)).alias("j")) \
        .select("length", "j", hashed(F.col("item_words"), F.col("j")).alias("h")).distinct()
    anchors = _bounded(anchors, anchors.count())
    places = docs.select(F.col(key).alias("key"), F.xxhash64(key, text).alias("row"),
                         normal_words(F.col(text)).alias("words")).where(F.size("words") >= SHINGLE) \
        .select("key", "row", "words", F.explode(F.sequence(F.lit(0), F.size("words") - SHINGLE)).alias("i")) \
        .withColumn("h", hashed(F.col("words"), F.col("i")))
    first = F.col("i") - F.col("j")
    return places.join(anchors, "h").select(
        "row", "key", "length", first.alias("first"),
        F.slice("words", F.greatest(first, F.lit(0)) + 1, F.least(F.col("length"), F.col("length") + first))
        .alias("window")).distinct()


def contaminated(docs: DataFrame, bench: DataFrame, threshold: float = THRESHOLD, key: str = "doc_id",
                 text: str = "text", item_key: str = "item_id") -> DataFrame:
    """One row per document text and item found in it: row, key, item, similarity (the best window's)."""
    items = benchmark_items(bench, item_key)
    n_items = items.count()
    found = windows(docs, items, key, text).withColumn("grams", shingles(F.col("window"))) \
        .withColumn("print", simhash(F.col("grams")))
    # Index: every item under each byte value within BLOCK_RADIUS of its own; windows probe with their own bytes.
    near = [v for v in range(1 << BLOCK_BITS) if bin(v).count("1") <= BLOCK_RADIUS]
    flips = F.array(*[F.lit(v) for v in near])
    blocks = lambda p: F.posexplode(F.array(*[_block(F.col(p), b) for b in range(BLOCKS)]))
    index = items.select("item_row", "length", "item_print",
                         blocks("item_print").alias("block", "own")) \
        .withColumn("flip", F.explode(flips)) \
        .withColumn("value", F.col("own").bitwiseXOR(F.col("flip").cast("bigint"))).drop("own", "flip")
    probes = found.select("row", "key", "length", "grams", "print", blocks("print").alias("block", "value"))
    apart = F.col("print").bitwiseXOR(F.col("item_print"))
    # Each pair comes once: at its first block within the block radius.
    earlier = F.lit(False)
    for b in range(BLOCKS):
        earlier = earlier | ((F.col("block") > b) & (F.bit_count(_block(apart, b)) <= BLOCK_RADIUS))
    pairs = probes.join(_bounded(index, n_items * BLOCKS * len(near)), ["length", "block", "value"]) \
        .where(~earlier & (F.bit_count(apart) <= RADIUS)) \
        .join(_bounded(items.select("item_row", "item", "item_grams", "item_weight"), n_items), "item_row")
    common = weight(F.array_intersect("grams", "item_grams"))
    return pairs.select("row", "key", "item", (common / (weight(F.col("grams")) + F.col("item_weight") - common))
                        .alias("similarity")).where(F.col("similarity") >= threshold) \
        .unionByName(short_copies(docs, bench, key, text, item_key)) \
        .groupBy("row", "key", "item").agg(F.max("similarity").alias("similarity"))


def find_leaks(docs: DataFrame, bench: DataFrame, key: str = "doc_id", item_key: str = "item_id",
               threshold: float = THRESHOLD) -> DataFrame:
    """(key, item key, similarity) of every benchmark item found in a document."""
    return contaminated(docs, bench, threshold, key, item_key=item_key).groupBy("key", "item") \
        .agg(F.max("similarity").alias("similarity")).select(F.col("key").alias(key), F.col("item").alias(item_key),
                                                             "similarity")


def remove_leaks(docs: DataFrame, bench: DataFrame, key: str = "doc_id", text: str = "text",
                 threshold: float = THRESHOLD) -> DataFrame:
    """The documents in which no benchmark item was found, with all their columns."""
    bad = contaminated(docs, bench, threshold, key, text).select(F.col("row").alias("__row")).distinct()
    bad = bounded(written(bad, "leaks"))
    return docs.withColumn("__row", F.xxhash64(key, text)).join(bad, "__row", "left_anti").drop("__row")
