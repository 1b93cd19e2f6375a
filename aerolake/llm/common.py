"""Shared pieces: word pattern, table reading, written lineage cuts, Arrow batch helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.session import scratch_path

# A word is a maximal run of anything but space, tab, LF, VT, FF, CR (fixed by the query contracts).
BLANKS = r"[\x20\x09-\x0D]"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text; an empty array for null, empty or blank texts."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS + "+"), "")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: a lineage cut that survives lost
    executors (nothing is kept in executor memory or on executor disks)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, whatever the locale."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bounded(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """Hint a broadcast where a count proves the side small; beyond it Spark joins by shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
