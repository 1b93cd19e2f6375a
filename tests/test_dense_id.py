"""W2 dense ids and the multiplicity expansion they rely on, including a hot group of copies."""

from pyspark.sql import functions as F

from aerolake.operators.dense_id import assign_dense_ids
from aerolake.operators.util import expand_counts


def test_expand_counts_chunks(spark):
    df = spark.createDataFrame([("a", 10), ("b", 1), ("c", 3)], "k string, n long")
    out = expand_counts(df, "n", index_col="i", chunk_rows=3, spread_partitions=4)
    got = sorted((r.k, r.i) for r in out.collect())
    assert got == [("a", i) for i in range(10)] + [("b", 0)] + [("c", i) for i in range(3)]
    assert out.columns == ["k", "i"]


def test_ordered_ids_follow_columns(spark):
    df = spark.createDataFrame([(3, "x"), (1, "y"), (2, None), (1, "a")], "a int, b string").repartition(3)
    out = assign_dense_ids(df, "id", order_cols=["a", "b"], num_partitions=3).orderBy("id").collect()
    assert [(r.id, r.a, r.b) for r in out] == [(1, 1, "a"), (2, 1, "y"), (3, 2, None), (4, 3, "x")]


def test_hot_copies_get_dense_unique_ids(spark):
    hot = spark.range(5000).select(F.lit(7).alias("a"), F.lit("same").alias("b"))
    rest = spark.range(300).select(F.col("id").cast("int").alias("a"), F.lit("r").alias("b"))
    df = hot.unionByName(rest).repartition(5)
    out = assign_dense_ids(df, "id", order_cols=["a", "b"], num_partitions=6)
    stats = out.agg(F.min("id"), F.max("id"), F.countDistinct("id"), F.count("*")).first()
    assert tuple(stats) == (1, 5300, 5300, 5300)
    # rows a = 0..6 come first, then (7, 'r'), then the 5,000 copies of (7, 'same'), then a = 8...
    assert out.where("a = 7 AND b = 'same'").agg(F.min("id"), F.max("id")).first() == (9, 5008)


def test_input_order_ids(spark):
    df = spark.range(0, 1000, 1, 4).select((F.col("id") * 3).alias("v"))
    out = assign_dense_ids(df, "id")
    stats = out.agg(F.min("id"), F.max("id"), F.countDistinct("id")).first()
    assert tuple(stats) == (1, 1000, 1000)
    stable = assign_dense_ids(df, "id", stable_input=True)
    assert stable.select("id").distinct().count() == 1000


def test_empty_input(spark):
    df = spark.createDataFrame([], "a int")
    assert assign_dense_ids(df, "id", order_cols=["a"]).count() == 0
    assert assign_dense_ids(df, "id").count() == 0


def test_scan_order_ids_are_deterministic_on_recompute(spark, tmp_out):
    import os
    path = os.path.join(tmp_out, "ids.parquet")
    spark.range(0, 5000, 1, 6).select((F.col("id") % 97).alias("a"), (F.col("id") * 7).alias("b")) \
        .write.parquet(path)
    df = spark.read.parquet(path)
    ids = assign_dense_ids(df, "id", stable_input=True)
    first = sorted((r.id, r.a, r.b) for r in ids.collect())
    second = sorted((r.id, r.a, r.b) for r in ids.collect())  # a recompute, as after a lost executor
    assert first == second
    assert [i for i, _, _ in first] == list(range(1, 5001))
