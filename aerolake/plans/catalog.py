"""Catalog tables: raw star DDL and load (S9, S10), serving tables (S11, S12), views and introspection
(S8, S13), with key validation (V1) on the raw dimensions.

Tables are Parquet tables of the session catalog; a database can be given a ``location`` on shared storage
so its files outlive the session.

Loads are staged: the new tables are written beside the old ones under their own names and folders, checked there, and
put in place by renames in the catalog, which move no file. A reader sees the old star or the new one, never an invalid or
half-loaded one; a load that fails leaves the old tables as they were. Files of replaced tables stay for readers that
still scan them, until ``purge_replaced`` removes them.
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession

from aerolake.operators.star import KeyViolation, build_fact, pollutants_dim, stations_dim, validate_keys
from aerolake.schema import SERVING_TABLES
from aerolake.session import run_concurrently
from aerolake.sources.parquet import load_raw
from aerolake.sources.sinks import read_if_exists

log = logging.getLogger("aerolake.catalog")

RAW_DDL = {
    "stations": "station_id STRING NOT NULL, city STRING, state STRING",
    "pollutants": "pollutant_id INT NOT NULL, pollutant_name STRING",
    "measurements": ("measurement_id BIGINT, datetime TIMESTAMP_NTZ, station_id STRING, pollutant_id INT, "
                     "value DOUBLE, year INT, month INT, day INT, hour INT, at_c DOUBLE, rh_percent DOUBLE, "
                     "bp_mmhg DOUBLE, ws_m_s DOUBLE, wd_deg DOUBLE, rf_mm DOUBLE, sr_w_mt2 DOUBLE, vws_m_s DOUBLE"),
}


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{loc}")


# Fact layout: every benchmark and serving query selects one pollutant through the dimension join, so the
# facts are partitioned by pollutant_id (dynamic partition pruning then reads one directory) and each file
# is sorted by station and time (Parquet min/max statistics let a station filter skip row groups).
FACT_PARTITION = "pollutant_id"
FACT_SORT = ["pollutant_id", "station_id", "datetime"]
RAW_PARTITIONING = {"measurements": f" PARTITIONED BY ({FACT_PARTITION})"}


def create_raw_schema(spark: SparkSession, database: str, location: str | None = None) -> None:
    """(re)create the three raw star tables, dropping existing ones first (re-runnable). The fact is
    partitioned by ``pollutant_id`` (Spark lists partition columns last in the table schema)."""
    create_database(spark, database, location)
    for t in ("measurements", "stations", "pollutants"):
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{t}`")
    for t in ("stations", "pollutants", "measurements"):
        spark.sql(f"CREATE TABLE `{database}`.`{t}` ({RAW_DDL[t]}) USING parquet{RAW_PARTITIONING.get(t, '')}")


def _staged(table: str) -> str:
    return f"{table}__staged"


def _folder(spark: SparkSession, database: str, table: str) -> str:
    """A new folder for one version of a table, beside the database's other files."""
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{table}-{uuid.uuid4().hex[:12]}"


def drop_staged(spark: SparkSession, database: str, tables) -> None:
    for t in tables:
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{_staged(t)}`")


def publish(spark: SparkSession, database: str, tables, absent=()) -> None:
    """Put the staged ``tables`` in place of those of their names and drop the tables ``absent``. Only the catalog
    changes; where a rename fails, the tables renamed before it are put back."""
    def rename(old, new):
        spark.sql(f"ALTER TABLE `{database}`.`{old}` RENAME TO `{database}`.`{new}`")

    done = []
    try:
        for t in tables:
            spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{t}__replaced`")
            if spark.catalog.tableExists(f"{database}.{t}"):
                rename(t, f"{t}__replaced")
                done.append((f"{t}__replaced", t))
            rename(_staged(t), t)
            done.append((t, _staged(t)))
    except Exception:
        for old, new in reversed(done):
            rename(old, new)
        raise
    for t in [*(f"{t}__replaced" for t in tables), *absent]:
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{t}`")


def purge_replaced(spark: SparkSession, database: str) -> list[str]:
    """Delete the folders of table versions that no table of the database uses any more; their paths."""
    root = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    used = set()
    for t in list_tables(spark, database):
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED `{database}`.`{t}`").where("col_name = 'Location'").collect()
        used |= {r["data_type"].rstrip("/").rsplit("/", 1)[-1] for r in rows}
    gone = []
    for status in fs.listStatus(base) if fs.exists(base) else []:
        name = status.getPath().getName()
        table, _, version = name.rpartition("-")
        if table in (*RAW_DDL, *SERVING_TABLES) and len(version) == 12 and name not in used:
            fs.delete(status.getPath(), True)
            gone.append(f"{root}/{name}")
    return gone


def load_raw_data(spark: SparkSession, database: str, parquet_file: str, counts: bool = False,
                  id_order: str = "input") -> dict[str, int]:
    """Load the raw star from a raw Parquet file, staged and published as a whole.

    Dimensions are written first and validated (V1: PK, raising ``KeyViolation`` and leaving the old tables); the fact
    reads the staged pollutant table back for its surrogate-key lookup, so the dimension is computed once. The fact's
    ``measurement_id`` follows scan order by default (the source's unordered ``ROW_NUMBER() OVER ()``; no
    shuffle); ``id_order="columns"`` gives the reproducible column order instead."""
    raw = load_raw(spark, parquet_file)  # FileNotFoundError / IOError on a bad path
    stations = stations_dim(raw)
    pollutants = pollutants_dim(raw, "int")
    names = ["stations", "pollutants", "measurements"]
    drop_staged(spark, database, names)
    for t in names:
        spark.sql(f"CREATE TABLE `{database}`.`{_staged(t)}` ({RAW_DDL[t]}) USING parquet{RAW_PARTITIONING.get(t, '')} "
                  f"LOCATION '{_folder(spark, database, t)}'")

    def fill(df, table):
        df.write.insertInto(f"`{database}`.`{_staged(table)}`", overwrite=True)

    def load_stations():
        fill(stations.select("station_id", "city", "state"), "stations")
        # V1 on the staged (small) table instead of a second scan of the raw data. The pollutant keys hold
        # by construction (DISTINCT names numbered by row_number); the station key depends on the data
        # (one station id with two cities breaks it).
        validate_keys(spark.table(f"`{database}`.`{_staged('stations')}`"), ["station_id"], "stations")

    try:
        run_concurrently(spark, load_stations,
                         lambda: fill(pollutants.select("pollutant_id", "pollutant_name"), "pollutants"))
        stored_pollutants = spark.table(f"`{database}`.`{_staged('pollutants')}`")
        fact = build_fact(raw, stored_pollutants, include_vws=True, id_order=id_order, stable_input=True)
        table_cols = spark.table(f"`{database}`.`{_staged('measurements')}`").columns  # insertInto is positional
        fill(fact.select(*table_cols).hint("rebalance", FACT_PARTITION).sortWithinPartitions(*FACT_SORT), "measurements")
        publish(spark, database, names)
    finally:
        drop_staged(spark, database, names)
    return table_counts(spark, database) if counts else {}


def setup_served_database(spark: SparkSession, database: str, df_clean: DataFrame,
                          monthly_avg_path: str | None = None, daily_peaks_path: str | None = None,
                          location: str | None = None, id_order: str = "input",
                          stable_input: bool = False) -> None:
    """(re)create the serving tables from the clean frame: stations, pollutants (BIGINT ids),
    measurements_clean, and — only when their files exist (S12) — monthly_aggregates and daily_peaks. Staged and
    published as a whole; a pre-aggregate whose file is absent leaves no table.
    ``stable_input=True`` when ``df_clean`` is a Parquet scan (the written clean data read back): the
    scan-order ids then need no checkpoint."""
    create_database(spark, database, location)
    drop_staged(spark, database, SERVING_TABLES)
    made = []

    def stage(df, table, *partition):
        writer = df.write.mode("overwrite").option("path", _folder(spark, database, table))
        (writer.partitionBy(*partition) if partition else writer).saveAsTable(f"`{database}`.`{_staged(table)}`")
        made.append(table)

    # The fact needs the stored pollutant ids; everything else is independent of it and of each other.
    def load_fact():
        stored_pollutants = spark.table(f"`{database}`.`{_staged('pollutants')}`")
        stage(build_fact(df_clean, stored_pollutants, include_vws=False, id_order=id_order, stable_input=stable_input)
              .hint("rebalance", FACT_PARTITION).sortWithinPartitions(*FACT_SORT), "measurements_clean", FACT_PARTITION)

    def load_stations():
        stage(stations_dim(df_clean).orderBy("station_id"), "stations")
        # Serving tables carry no constraints; a station id with two cities would fan out the station join,
        # so it is reported (checked on the small stored table) rather than rejected.
        try:
            validate_keys(spark.table(f"`{database}`.`{_staged('stations')}`"), ["station_id"], "stations")
        except KeyViolation as err:
            log.warning("serving stations table: %s; joins on station_id will fan out", err)

    def load_preaggregate(name, path):
        def step():
            df = read_if_exists(spark, path)
            if df is not None:
                stage(df, name)
        return step

    steps = [load_fact, load_stations]
    for name, path in (("monthly_aggregates", monthly_avg_path), ("daily_peaks", daily_peaks_path)):
        if path:
            steps.append(load_preaggregate(name, path))
    try:
        stage(pollutants_dim(df_clean, "long"), "pollutants")
        run_concurrently(spark, *steps)
        publish(spark, database, made, [t for t in SERVING_TABLES if t not in made])
    finally:
        drop_staged(spark, database, SERVING_TABLES)


def list_tables(spark: SparkSession, database: str) -> list[str]:
    """Table names of a database (``SHOW TABLES``)."""
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def table_exists(spark: SparkSession, database: str, table: str) -> bool:
    """Is the table present?"""
    return spark.catalog.tableExists(f"{database}.{table}")


def table_counts(spark: SparkSession, database: str) -> dict[str, int]:
    """Row count per table of a database (the load log of the source)."""
    return {t: spark.table(f"`{database}`.`{t}`").count() for t in list_tables(spark, database)}


def describe(df: DataFrame) -> list[tuple[str, str]]:
    """Column names and types (``DESCRIBE``)."""
    return df.dtypes


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Expose a frame to SQL under ``name``."""
    df.createOrReplaceTempView(name)
    return df


def drop_view(spark: SparkSession, name: str) -> bool:
    """Remove a registered frame."""
    return spark.catalog.dropTempView(name)
