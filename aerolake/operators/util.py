"""Shared building blocks: size-checked broadcast, multiplicity expansion, null-key filtering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default ceiling for an explicit broadcast: rows of a dimension-like side (a few MB per executor).
BROADCAST_MAX_ROWS = 200_000


def row_bound(df: DataFrame, limit: int) -> int:
    """Rows of ``df`` capped at ``limit + 1`` — a cheap bounded count (stops once the cap is reached)."""
    return df.limit(limit + 1).count()


def broadcast_if_bounded(small: DataFrame, bound: int | None = None,
                         max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Hint a broadcast only when the side is proven small.

    ``bound`` is an upper bound the caller already knows (e.g. distinct join keys); without it the side is
    counted with a capped count. Beyond the limit no hint is given: Spark plans a shuffle join and AQE
    re-plans at runtime (broadcast when the materialized side is small, skew splitting otherwise).
    """
    n = bound if bound is not None else row_bound(small, max_rows)
    return F.broadcast(small) if n <= max_rows else small


def non_null_keys(df: DataFrame, keys) -> DataFrame:
    """Drop rows whose grouping key is NULL (grouped pandas work drops those groups)."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond) if cond is not None else df


def expand_counts(df: DataFrame, count_col: str, index_col: str | None = None,
                  chunk_rows: int = 100_000, spread_partitions: int | None = None) -> DataFrame:
    """Turn each row carrying a multiplicity ``count_col = c`` into ``c`` rows (the count column dropped).

    ``index_col`` (optional) receives 0..c-1. Rows with c <= ``chunk_rows`` expand in place. Larger
    multiplicities (a group of copies may hold a third of all rows) are first cut into chunks of
    ``chunk_rows``, the chunk rows are hash-spread over the cluster, and each task expands only its chunks.
    """
    cnt = F.col(count_col)
    keep = [c for c in df.columns if c != count_col]
    k = index_col or "__k"

    small = df.where(cnt <= chunk_rows) \
              .withColumn(k, F.explode(F.sequence(F.lit(0).cast("long"), cnt.cast("long") - 1)))

    big = df.where(cnt > chunk_rows) \
            .withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"),
                                                        ((cnt - 1) / chunk_rows).cast("long"))))
    spread = [F.col("__chunk"), F.xxhash64(*[F.col(c) for c in keep])]
    big = (big.repartition(spread_partitions, *spread) if spread_partitions else big.repartition(*spread)) \
             .withColumn(k, F.explode(F.sequence(F.col("__chunk") * chunk_rows,
                                                 F.least(cnt.cast("long"), (F.col("__chunk") + 1) * chunk_rows) - 1))) \
             .drop("__chunk")
    out = small.unionByName(big)
    cols = keep + ([index_col] if index_col else [])
    return out.select(*cols)
