"""Hive-partitioned write ``year=YYYY/month=MM``.

The target is replaced, the keys live in the directory names only, and the month directory is zero-padded.
A ``REBALANCE`` on the keys lets AQE size the files: a small month becomes one file, a hot month (one key
may hold a third of all rows) is split into several advisory-sized files instead of one giant task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def partition_dataset(df: DataFrame, output_dir: str) -> int:
    """Write ``df`` partitioned by year and zero-padded month; return the number of partition folders.

    Rows with a NULL year or month are skipped (a grouped write in pandas drops them too), so no
    ``__HIVE_DEFAULT_PARTITION__`` folder appears.
    """
    try:
        out = (df.where(F.col("year").isNotNull() & F.col("month").isNotNull())
                 .withColumn("month", F.lpad(F.col("month").cast("string"), 2, "0")))
        (out.hint("rebalance", "year", "month")
            .write.mode("overwrite").partitionBy("year", "month").parquet(output_dir))
    except Exception as err:
        raise IOError(f"Failed to write partitioned dataset: {err}") from err
    # Counted by Spark over the partition columns; the schema is given, so an empty input counts 0.
    return df.sparkSession.read.schema(out.schema).parquet(output_dir).select("year", "month").distinct().count()


def replace_months(df: DataFrame, root: str) -> DataFrame:
    """Load the complete months of ``df`` into a partitioned root: only the month directories that it holds are
    replaced, so loading a month twice equals loading it once, and other months' files stay as they are. Rows with a NULL
    year or month are skipped. ``df`` must be a stable scan that does not read ``root``.

    Returns (year, month, n_rows) of the months replaced, counted in ``df``; an ``IOError`` says which stored month has
    another count."""
    keyed = df.where(F.col("year").isNotNull() & F.col("month").isNotNull())
    given = keyed.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_rows"))
    (keyed.withColumn("month", F.lpad(F.col("month").cast("string"), 2, "0")).hint("rebalance", "year", "month")
          .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(root))
    rows = given.collect()  # one row a month
    proof = df.sparkSession.createDataFrame(rows, given.schema)
    stored = df.sparkSession.read.schema(df.schema).parquet(root) \
        .join(F.broadcast(proof.select("year", "month")), ["year", "month"]) \
        .groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_rows")).collect()
    differing = set(map(tuple, rows)) ^ set(map(tuple, stored))
    if differing:
        raise IOError(f"Months stored with other row counts than given: {sorted(differing)}")
    return proof
