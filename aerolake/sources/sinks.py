"""Sinks (S4, S5, S12, S14)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.schema import CLEAN_COLUMNS

CLEAN_PARTITION = "pollutant_key"
_PREFIX = "p_"


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write a frame as Parquet (replacing the target)."""
    df.write.mode(mode).parquet(path)
    return path


def write_clean(df: DataFrame, path: str) -> str:
    """Write the clean dataset in one directory per pollutant, each file sorted by station and time.

    Most marts read one pollutant (PM2.5 level counts, AQI rows, hourly profile, weekday pattern, hourly
    series), so their scans list one directory (``PartitionFilters``); the sort lets station / time
    filters skip row groups. The directory key is the name behind a fixed prefix: names that are empty or look like
    numbers come back as they were, and the name stays in the files too. The rows are rebalanced by pollutant first,
    which splits a frequent one, so the number of files follows the data and not tasks x pollutants."""
    (df.withColumn(CLEAN_PARTITION, F.concat(F.lit(_PREFIX), F.col("pollutant")))
       .hint("rebalance", CLEAN_PARTITION)
       .sortWithinPartitions(F.col(CLEAN_PARTITION), F.col("station_id"), F.col("datetime"))
       .write.mode("overwrite").partitionBy(CLEAN_PARTITION).parquet(path))
    return path


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """Read the clean dataset back with its columns in their original order. The pollutant comes from the directory
    key, so a filter on it prunes directories."""
    df = spark.read.parquet(path)
    name = F.substring(CLEAN_PARTITION, len(_PREFIX) + 1, 1 << 30).alias("pollutant")
    return df.select(*[name if c == "pollutant" else F.col(c) for c in CLEAN_COLUMNS if c in df.columns])


def write_outputs(outputs: dict[str, DataFrame], output_dir: str) -> dict[str, str]:
    """Write each named output to ``<output_dir>/<name>.parquet``. The writes are independent jobs and
    are submitted together so the scheduler overlaps them."""
    from aerolake.session import run_concurrently

    root = output_dir.rstrip("/")
    paths = {name: f"{root}/{name}.parquet" for name in outputs}
    if outputs:
        spark = next(iter(outputs.values())).sparkSession
        run_concurrently(spark, *[(lambda d=df, p=paths[n]: write_parquet(d, p)) for n, df in outputs.items()])
    return paths


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """Read a pre-aggregate only when its path exists (None otherwise); unreadable data raises."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_feature_bundle(tables: dict[str, DataFrame], output_dir: str, also_json: bool = False) -> dict[str, str]:
    """The dashboard's feature tables as Parquet marts (optionally JSON lines as well)."""
    paths = write_outputs(tables, output_dir)
    if also_json:
        root = output_dir.rstrip("/")
        for name, df in tables.items():
            df.write.mode("overwrite").json(f"{root}/{name}.json")
    return paths
