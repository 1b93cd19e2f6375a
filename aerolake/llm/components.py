"""Connected components by alternating large-star and small-star steps over an edge table.

Each step is an aggregation and a join by node; labels never reach the driver, and every round is written to the
shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import written

MAX_ROUNDS = 60  # the number of rounds is about logarithmic in the longest path


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with an edge; the component is its smallest node."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = written(e, "components")
    state = None
    for _ in range(MAX_ROUNDS):
        # Large star: every larger neighbour of u points to the least of u and its neighbours.
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        big = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .where("u <> v").distinct()
        # Small star: u and its smaller neighbours point to the least of them.
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        small = big.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        e = written(small, "components")
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("bigint"))).first()
        if now == state:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")) \
                .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        state = now
    raise RuntimeError("components did not settle")
