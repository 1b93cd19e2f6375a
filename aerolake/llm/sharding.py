"""Sharding by jump consistent hashing: a stable key picks its shard from the key and the shard count alone.

There is no ring table. Appending a shard moves about 1/(n+1) of the keys, all of them into the new shard.
The hash runs as DataFrame expressions: the 64-bit linear congruential step is exact in DECIMAL(38, 0)
(2^64 * 2^61.4 < 10^38), so no expression relies on overflow.

Edge cases: a null key hashes as key 0; equal keys share a shard; an empty table gives an empty result; a null
text has size 1 and the CRC of the empty text. Only the named columns are read, so extra columns never clash.
"""

from __future__ import annotations

import json
import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Constants of the published jump consistent hash.
LCG_MULTIPLIER = 2862933555777941757
# Most jumps that one key may take before the job raises. A key jumps about ln(shards) times, so this is never
# met below astronomically many shards; up to 128 shards the loop is exhaustive.
MAX_JUMPS = 128
# Rows numbered by one task of the slot window.
ROWS_PER_SLOT_BUCKET = 100_000
# Rows of the offset table (shards x buckets) up to which it is broadcast.
OFFSET_BROADCAST_ROWS = 200_000


def jump_hash(key: Column, shards: int) -> Column:
    """Shard in [0, shards) of a bigint key."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    big = "decimal(20,0)"
    unsigned = F.when(key < 0, key.cast(big) + F.lit(Decimal(1 << 64)).cast(big)).otherwise(key.cast(big)).cast(big)
    start = F.struct(F.lit(-1).cast("bigint").alias("b"), F.lit(0).cast("bigint").alias("j"),
                     F.coalesce(unsigned, F.lit(0).cast(big)).alias("k"))

    def jump(acc, _):
        k = ((acc["k"] * F.lit(Decimal(LCG_MULTIPLIER)).cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)"))
             % F.lit(Decimal(1 << 64)).cast(big)).cast(big)
        top = F.floor(k / F.lit(Decimal(1 << 33)).cast("decimal(10,0)")).cast("bigint") + 1
        j = F.floor((acc["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / top.cast("double"))).cast("bigint")
        return F.when(acc["j"] < shards, F.struct(acc["j"].alias("b"), j.alias("j"), k.alias("k"))).otherwise(acc)

    last = F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, MAX_JUMPS))), start, jump)
    if shards <= MAX_JUMPS:
        return last["b"].cast("int")
    return F.when(last["j"] >= shards, last["b"]).otherwise(
        F.raise_error(F.lit("jump hash did not finish")).cast("bigint")).cast("int")


def slot_ranges(df: DataFrame, key: str, ties: list[str], buckets: int) -> Column:
    """A number for each row that grows with (``key`` nulls first, ``ties``) and deals the rows over about ``buckets``
    ranges of like size, wherever the keys lie.

    Bounds are approximate quantiles of the key. The rows that equal a bound are a range of their own: a key that holds
    more than its share is always one of the bounds. Those ranges and the null keys are cut again by ``ties[0]``, which
    must be a CRC-32: it spreads them evenly, except for copies that are equal in key and text."""
    cuts = [i / buckets for i in range(1, buckets)]
    bounds = sorted(set(df.agg(F.percentile_approx(key, cuts, 10 * buckets)).first()[0] or [])) if cuts else []
    # Two short searches instead of one over all bounds.
    step = max(1, math.isqrt(len(bounds)))
    literal = lambda xs: F.from_json(F.lit(json.dumps(xs)), "array<bigint>")
    below = lambda xs: F.size(F.filter(xs, lambda x: x < F.col(key)))
    block = F.greatest(below(literal(bounds[::step])) - 1, F.lit(0)) * step
    at = block + below(F.slice(literal(bounds), block + 1, F.lit(step)))
    level = F.when(F.col(key).isNull(), F.lit(1)).otherwise(
        (at + 1) * 2 + F.coalesce((F.get(literal(bounds), at) == F.col(key)).cast("int"), F.lit(0)))
    part = F.when(level % 2 == 1, F.floor(F.col(ties[0]) * F.lit(buckets) / F.lit(float(1 << 32)))).otherwise(F.lit(0))
    return level.cast("bigint") * F.lit(buckets) + part.cast("bigint")


def gapless_slots(df: DataFrame, shard: str, key: str, ties: list[str]) -> DataFrame:
    """Add ``slot``: 0, 1, 2, ... within each shard in the order of ``key`` (nulls first), then ``ties``.

    No task numbers a whole shard. Rows are cut into ranges (``slot_ranges``), each (shard, range) is numbered
    by itself, and running counts over the small table of ranges give the offsets. Slots do not depend on how
    many ranges there are.
    """
    n, shards = df.agg(F.count(F.lit(1)), F.count_distinct(shard)).first()
    buckets = max(1, -(-n // (ROWS_PER_SLOT_BUCKET * max(1, shards))))
    cut = df.withColumn("__range", slot_ranges(df, key, ties, buckets) if buckets > 1 else F.lit(0).cast("bigint"))
    sizes = cut.groupBy(shard, "__range").count()
    before = Window.partitionBy(shard).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(shard, "__range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    if shards * (buckets + 1) * (buckets + 2) <= OFFSET_BROADCAST_ROWS:  # ranges between bounds, and parts of bounds
        offsets = F.broadcast(offsets)
    within = Window.partitionBy(shard, "__range").orderBy(F.col(key).asc_nulls_first(), *ties)
    return cut.withColumn("__row", F.row_number().over(within)).join(offsets, [shard, "__range"]) \
        .withColumn("slot", (F.col("__before") + F.col("__row") - 1).cast("bigint")) \
        .drop("__range", "__row", "__before")


def shard_documents(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, size (UTF-8 bytes + 1), CRC-32 of the text, shard, slot, and the shard after
    one more shard is appended."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    keyed = docs.select(F.col(key).cast("bigint").alias(key), (F.octet_length(body) + 1).cast("bigint").alias("size"),
                        F.crc32(body).alias("text_crc32"),
                        jump_hash(F.col(key).cast("bigint"), shards).alias("shard"),
                        jump_hash(F.col(key).cast("bigint"), shards + 1).alias("grown_shard"))
    return gapless_slots(keyed, "shard", key, ["text_crc32", "size"]) \
        .select(key, "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
