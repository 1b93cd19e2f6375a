"""Star schema: dimensions D1/D2 with surrogate ids W1, the fact J1 + W2, and key validation V1.

Dimensions are tiny (distinct stations, distinct pollutant names). The pollutant id uses a global window,
which is fine only because its input is the distinct pollutant names; the fact table never goes through a
global window (its id comes from ``assign_dense_ids``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolake.operators.dense_id import assign_dense_ids
from aerolake.operators.util import BROADCAST_MAX_ROWS, broadcast_if_bounded, row_bound
from aerolake.schema import FACT_VALUE_COLUMNS


class KeyViolation(ValueError):
    """A primary-key or unique constraint of a star table does not hold."""


def stations_dim(rows: DataFrame) -> DataFrame:
    """Distinct (station_id, city, state)."""
    return rows.select("station_id", "city", "state").distinct()


def pollutants_dim(rows: DataFrame, id_type: str = "int") -> DataFrame:
    """D2 + W1: distinct pollutant names numbered 1..n in name order (a NULL name sorts last)."""
    names = rows.select(F.col("pollutant").alias("pollutant_name")).distinct()
    w = Window.orderBy(F.col("pollutant_name").asc_nulls_last())
    return names.select(F.row_number().over(w).cast(id_type).alias("pollutant_id"), "pollutant_name")


def validate_keys(df: DataFrame, keys: list[str], table: str, allow_null: bool = False) -> None:
    """V1: raise ``KeyViolation`` if ``keys`` repeat (or are NULL for a primary key).

    A grouped count with a capped probe: only the existence of one offending key is computed."""
    bad = F.col("cnt") > 1
    if not allow_null:
        for k in keys:
            bad = bad | F.col(k).isNull()
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))
    if allow_null:  # UNIQUE: NULL keys never collide
        for k in keys:
            grouped = grouped.where(F.col(k).isNotNull())
    offenders = grouped.where(bad).limit(1).collect()
    if offenders:
        raise KeyViolation(f"{table}: key {keys} violated by {offenders[0].asDict()}")


def validate_raw_dimensions(stations: DataFrame, pollutants: DataFrame) -> None:
    """V1 for the raw star: stations.station_id PK, pollutants.pollutant_id PK, pollutant_name UNIQUE."""
    validate_keys(stations, ["station_id"], "stations")
    validate_keys(pollutants, ["pollutant_id"], "pollutants")
    validate_keys(pollutants, ["pollutant_name"], "pollutants", allow_null=True)


def attach_pollutant_ids(rows: DataFrame, pollutants: DataFrame, bound: int | None = None) -> DataFrame:
    """Surrogate-key lookup by name (inner join: rows without a known pollutant drop out). The
    dimension is broadcast after a capped size check (``bound``: its rows, where already counted)."""
    dim = broadcast_if_bounded(pollutants.select("pollutant_id", "pollutant_name"), bound)
    return rows.join(dim, rows["pollutant"] == dim["pollutant_name"], "inner")


def build_fact(rows: DataFrame, pollutants: DataFrame, include_vws: bool = True, id_order: str = "columns",
               stable_input: bool = False, num_partitions: int | None = None) -> DataFrame:
    """Fact rows (raw ``measurements`` with ``vws_m_s``; ``measurements_clean`` without) with a dense
    ``measurement_id``.

    ``id_order="columns"``: ids ordered by the value columns (reproducible, two shuffles).
    ``id_order="input"``: ids in scan order, the unordered ``ROW_NUMBER() OVER ()`` of a SQL load, with no
    shuffle at all; pass ``stable_input=True`` when ``rows`` is a file scan so no checkpoint is needed. That holds
    only while J1 broadcasts its dimension; where it must shuffle, the joined rows are checkpointed first."""
    cols = FACT_VALUE_COLUMNS + (["vws_m_s"] if include_vws else [])
    names = row_bound(pollutants, BROADCAST_MAX_ROWS)
    body = attach_pollutant_ids(rows, pollutants, names).select(*cols)
    if id_order == "input":
        return assign_dense_ids(body, id_col="measurement_id",
                                stable_input=stable_input and names <= BROADCAST_MAX_ROWS)
    return assign_dense_ids(body, id_col="measurement_id", order_cols=cols, num_partitions=num_partitions)


def build_raw_star(raw: DataFrame, validate: bool = True) -> dict[str, DataFrame]:
    """The raw star: stations, pollutants (INT ids), measurements (with ``vws_m_s``)."""
    stations = stations_dim(raw)
    pollutants = pollutants_dim(raw, "int")
    if validate:
        validate_raw_dimensions(stations, pollutants)
    fact = build_fact(raw, pollutants, include_vws=True)
    return {"stations": stations, "pollutants": pollutants, "measurements": fact}


def build_serving_star(clean: DataFrame) -> dict[str, DataFrame]:
    """The serving star over clean data: stations, pollutants (BIGINT ids), measurements_clean.
    Serving tables carry no constraints (a station with two cities fans out joins, as in the source)."""
    stations = stations_dim(clean).orderBy("station_id")
    pollutants = pollutants_dim(clean, "long")
    fact = build_fact(clean, pollutants, include_vws=False)
    return {"stations": stations, "pollutants": pollutants, "measurements_clean": fact}
