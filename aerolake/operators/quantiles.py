"""Exact quantiles without funnelling all distinct values into one task.

Spark's exact ``percentile`` aggregate merges a value -> count map of *every* distinct value in a single
task for a global quantile. Here:

1. a histogram (value, count) is built with a grouped count — partial aggregation collapses hot values;
2. approximate quantiles of the values cut the value axis into ``buckets`` ranges; the boundaries are
   collected once (a few KB) and used as literals, so bucketing is a deterministic expression;
3. per-bucket totals (at most ``buckets`` rows) give each bucket's starting rank; a running count inside a
   bucket (a window partitioned by bucket — a bucket holds ~1/``buckets`` of the rows, a single hot value
   sits alone in its bucket) gives every histogram row its rank interval [start, end);
4. the rows covering the 1-2 ranks needed per probability are read and interpolated linearly with Spark's
   ``percentile`` formula, position = (n - 1) * p.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, column: str, probs: list[float], buckets: int = 1024) -> list[float | None]:
    """Exact linear-interpolation quantiles of ``column`` (NULLs ignored) for each probability."""
    vals = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    hist = vals.groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    cuts = [i / buckets for i in range(1, buckets)]
    head = vals.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("v", cuts, 10 * buckets).alias("b")).first()
    n = head["n"]
    if not n:
        return [None for _ in probs]
    bounds = sorted(set(head["b"] or []))
    # One array literal (from_json of a constant is folded at planning time), not one expression per bound.
    barr = F.from_json(F.lit(json.dumps([float(b) for b in bounds])), "array<double>")
    hb = hist.withColumn("bk", F.size(F.filter(barr, lambda b: b < F.col("v"))))

    totals = sorted((r["bk"], r["t"]) for r in hb.groupBy("bk").agg(F.sum("c").alias("t")).collect())
    starts, acc = [], 0
    for bk, t in totals:
        starts.append((bk, acc))
        acc += t
    offs = df.sparkSession.createDataFrame(starts, "bk int, off long")  # <= buckets rows
    w = Window.partitionBy("bk").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = hb.join(F.broadcast(offs), "bk").select("v", "c", (F.col("off") + F.sum("c").over(w)).alias("end"))
    ranked = ranked.withColumn("start", F.col("end") - F.col("c"))

    positions = [(n - 1) * p for p in probs]
    needed = sorted({int(math.floor(pos)) for pos in positions} | {int(math.ceil(pos)) for pos in positions})
    cond = None
    for r in needed:
        c = (F.col("start") <= r) & (F.col("end") > r)
        cond = c if cond is None else cond | c
    found = [(row["v"], row["start"], row["end"]) for row in ranked.where(cond).select("v", "start", "end").collect()]

    def at(rank: int) -> float:
        for v, s, e in found:
            if s <= rank < e:
                return v
        raise AssertionError(f"rank {rank} not covered")

    out = []
    for pos in positions:
        lo, hi = int(math.floor(pos)), int(math.ceil(pos))
        lv, hv = at(lo), at(hi)
        out.append(lv if lo == hi or lv == hv else (hi - pos) * lv + (pos - lo) * hv)
    return out
