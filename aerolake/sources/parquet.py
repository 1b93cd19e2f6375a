"""Parquet scans.

The scan is lazy: Catalyst pushes the later filters and the column list into the Parquet reader, so a query
that needs two columns reads two columns.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL on every floating column, so aggregates use SQL NULL semantics
    (Spark's max/avg would otherwise return NaN when a NaN is present, and count would count it)."""
    exprs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append(F.when(~F.isnan(F.col(f.name)), F.col(f.name)).alias(f.name))
        else:
            exprs.append(F.col(f.name))
    return df.select(*exprs)


NANOS_AS_LONG = "spark.sql.legacy.parquet.nanosAsLong"


def _is_missing_path(err: AnalysisException) -> bool:
    cond = getattr(err, "getCondition", None) or getattr(err, "getErrorClass", None)
    name = cond() if callable(cond) else None
    return name == "PATH_NOT_FOUND" or "PATH_NOT_FOUND" in str(err) or "Path does not exist" in str(err)


def _is_nanos(err: Exception) -> bool:
    return "PARQUET_TYPE_ILLEGAL" in str(err) and "NANOS" in str(err)


def _scan(spark: SparkSession, path: str, nanos_as_long: bool) -> DataFrame:
    """The file with its schema read under the wished setting, whatever an earlier load left in the session."""
    before = spark.conf.get(NANOS_AS_LONG, "false")
    spark.conf.set(NANOS_AS_LONG, str(nanos_as_long).lower())
    try:
        df = spark.read.parquet(path)
        df.schema  # resolve the footer now so errors surface here
        return df
    finally:
        if not nanos_as_long:
            spark.conf.set(NANOS_AS_LONG, before)


def load_raw(spark: SparkSession, path: str, nanos_as_long: bool = False) -> DataFrame:
    """Scan raw Parquet; NaN -> NULL on doubles.

    Raises ``FileNotFoundError`` for a missing path and ``IOError`` for an unreadable one.
    Files with nanosecond timestamps (pandas' default), which Spark refuses, are read as int64 and ``datetime`` is
    converted to microseconds; ``nanos_as_long`` says so without the first try. Spark looks the setting up when a
    query runs, not when it is planned, so it stays on in the session; it concerns nanosecond columns only.
    """
    try:
        df = _scan(spark, path, nanos_as_long)
    except AnalysisException as err:
        if _is_missing_path(err):
            raise FileNotFoundError(f"Source file {path} not found.") from err
        if not nanos_as_long and _is_nanos(err):
            return load_raw(spark, path, nanos_as_long=True)
        raise IOError(f"Failed to read parquet file: {err}") from err
    except Exception as err:  # corrupt footer, permission, ...
        if not nanos_as_long and _is_nanos(err):
            return load_raw(spark, path, nanos_as_long=True)
        raise IOError(f"Failed to read parquet file: {err}") from err
    if nanos_as_long and "datetime" in df.columns and \
            isinstance(df.schema["datetime"].dataType, T.LongType):
        # integer division: nanoseconds since the epoch exceed a double's exact range
        micros = F.expr("CAST(`datetime` AS BIGINT) div 1000")
        df = df.withColumn("datetime", F.timestamp_micros(micros).cast("timestamp_ntz"))
    return nan_to_null(df)


def read_partitioned(spark: SparkSession, root: str) -> DataFrame:
    """Read a hive-partitioned root; partition keys come back as integer columns."""
    return spark.read.parquet(root)


def read_partition(spark: SparkSession, root: str, year: int, month: int) -> DataFrame:
    """One (year, month) partition. Expressed as a filter on the partitioned root, so the scan lists
    only that directory (``PartitionFilters`` in the plan)."""
    return read_partitioned(spark, root).where((F.col("year") == year) & (F.col("month") == month))


def sql_on_parquet(spark: SparkSession, query: str, **paths: str) -> DataFrame:
    """Run any SQL straight on Parquet files: each ``{name}`` placeholder stands for the rows of its path as
    ``load_raw`` gives them (NaN as NULL, nanosecond ``datetime`` converted), below the query, so its filters and columns
    still reach the scan."""
    return spark.sql(query, **{name: load_raw(spark, path) for name, path in paths.items()})
