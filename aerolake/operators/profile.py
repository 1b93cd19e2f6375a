"""Data profiling: counts, distincts, missing-value profile, quality, describe, audits
(A1-A9, A23-A26, A29, A30, P5).

Every profile is one or a few aggregate passes whose outputs are bounded by the number of columns,
months, pollutants or other low-cardinality keys; nothing row-sized reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolake.functions import exact_avg, exact_std, pct, period_label, round2_half_even
from aerolake.operators.quantiles import exact_quantiles
from aerolake.operators.util import expand_counts, non_null_keys
from aerolake.schema import WHO_PM25_LIMIT


# ----------------------------------------------------------------------------------------- A1-A6, A3
def summary_counts(df: DataFrame) -> DataFrame:
    """A1/A2/A4: one row — records, columns, cells, datetime range, sorted distinct years, distinct stations
    and pollutants (exact distinct counts, NULL excluded)."""
    # One scan: rows collapse to their (year, station, pollutant) combinations before any distinct count, so no row
    # is expanded per counted column; the distinct counts see the combinations only.
    kinds = df.groupBy("year", "station_id", "pollutant").agg(
        F.count(F.lit(1)).alias("n"), F.min("datetime").alias("lo"), F.max("datetime").alias("hi"))
    years = F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_set("year")).cast("array<string>"), ", "),
                     F.lit("]"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return kinds.agg(
        total.alias("total_records"),
        F.lit(len(df.columns)).cast("int").alias("n_columns"),
        (total * F.lit(len(df.columns))).cast("long").alias("total_cells"),
        F.min("lo").alias("date_min"),
        F.max("hi").alias("date_max"),
        years.alias("years"),
        F.countDistinct("station_id").alias("stations"),
        F.countDistinct("pollutant").alias("pollutant_species"),
    )


def rows_per_year(df: DataFrame) -> DataFrame:
    """A5: rows per year, key-ordered."""
    return non_null_keys(df, ["year"]).groupBy("year").agg(F.count(F.lit(1)).alias("n_records")).orderBy("year")


def rows_per_month(df: DataFrame) -> DataFrame:
    """A5: rows per (year, month), key-ordered."""
    return (non_null_keys(df, ["year", "month"]).groupBy("year", "month")
              .agg(F.count(F.lit(1)).alias("n_records")).orderBy("year", "month"))


def rows_per_pollutant(df: DataFrame) -> DataFrame:
    """Rows per pollutant, most frequent first (name breaks ties), NULL excluded."""
    return (df.where(F.col("pollutant").isNotNull()).groupBy("pollutant")
              .agg(F.count(F.lit(1)).alias("n_records")).orderBy(F.desc("n_records"), F.asc("pollutant")))


DISTINCT_VALUE_COLUMNS = ["year", "month", "state", "city", "station_id", "pollutant"]


def distinct_counts(df: DataFrame, columns=None) -> DataFrame:
    """A3: distinct non-NULL values of low-cardinality columns with their rank in the column's own order and their
    number of rows, as (column_name, value, position, n_rows).

    One scan: the rows collapse, map-side first, to the combinations of the columns that occur; one grouping-sets pass
    over those gives every column's values and exact counts. The ranking window sees the values of one column."""
    cols = [c for c in (columns or DISTINCT_VALUE_COLUMNS) if c in df.columns]
    kinds = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    quoted = [f"`{c}`" for c in cols]
    sets = df.sparkSession.sql(
        f"SELECT {', '.join(quoted)}, grouping_id({', '.join(quoted)}) AS __gid, sum(__n) AS __n "
        f"FROM {{kinds}} GROUP BY GROUPING SETS ({', '.join(f'({q})' for q in quoted)})", kinds=kinds)
    # grouping_id has one bit per column, the first the highest; the grouped column's bit is 0.
    own = {c: (1 << len(cols)) - 1 - (1 << (len(cols) - 1 - k)) for k, c in enumerate(cols)}
    pick = lambda f: F.coalesce(*[F.when(F.col("__gid") == g, f(c)) for c, g in own.items()])
    w = Window.partitionBy("__gid").orderBy(*[F.col(c) for c in cols])
    found = sets.withColumn("value", pick(lambda c: F.col(c).cast("string"))).where(F.col("value").isNotNull())
    return found.select(pick(F.lit).alias("column_name"), "value", F.dense_rank().over(w).cast("int").alias("position"),
                        F.col("__n").cast("long").alias("n_rows"))


def distinct_values(df: DataFrame, columns=None) -> DataFrame:
    """A3: sorted distinct non-NULL values of low-cardinality columns, as (column_name, value, position)."""
    return distinct_counts(df, columns).select("column_name", "value", "position")


# ----------------------------------------------------------------------------------------- A7-A9
def _null_counts(df: DataFrame) -> DataFrame:
    """One pass: total rows plus a NULL count per column, in a single wide row."""
    return df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def missing_profile(df: DataFrame) -> DataFrame:
    """Per column missing count and percent (2 decimals), columns with missing values only, highest
    first (name breaks ties)."""
    cols = df.columns
    wide = _null_counts(df)
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    long = wide.selectExpr("__rows", f"stack({len(cols)}, {pairs}) AS (column_name, missing_count)")
    return (long.where(F.col("missing_count") > 0)
                .select("column_name", F.col("missing_count").cast("long").alias("missing_count"),
                        round2_half_even(pct("missing_count", "__rows")).alias("missing_pct"))
                .orderBy(F.desc("missing_pct"), F.asc("column_name")))


def _quality(df: DataFrame) -> DataFrame:
    cols = df.columns
    wide = _null_counts(df)
    total_missing = sum((F.col(c) for c in cols), F.lit(0).cast("long"))
    cells = F.col("__rows").cast("long") * F.lit(len(cols))
    return wide.select(
        F.col("__rows").cast("long").alias("rows"),
        F.lit(len(cols)).cast("long").alias("columns"),
        total_missing.cast("long").alias("total_missing"),
        cells.alias("total_cells"),
        (F.lit(100.0) - total_missing.cast("double") / F.nullif(cells, F.lit(0)).cast("double") * 100.0)
        .alias("quality_pct"))


def completeness(df: DataFrame) -> DataFrame:
    """Total missing cells, total cells and ``100 - missing / cells * 100``."""
    return _quality(df).select("total_missing", "total_cells", "quality_pct")


def quality_before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows, columns, missing cells and quality % before and after cleaning, with the change.

    The two one-row quality summaries are tagged, unioned and folded by one conditional aggregate — no
    join (a join of two single rows on a constant would be planned as a cross join)."""
    metrics = ("rows", "columns", "total_missing", "quality_pct")
    both = (_quality(before).select(F.lit("b").alias("__side"), *metrics)
            .unionByName(_quality(after).select(F.lit("a").alias("__side"), *metrics)))
    wide = both.agg(*[F.max(F.when(F.col("__side") == side, F.col(m).cast("double"))).alias(f"{side}_{m}")
                      for side in ("b", "a") for m in metrics])
    stack = ("stack(4, 'rows', b_rows, a_rows, 'columns', b_columns, a_columns, "
             "'missing_cells', b_total_missing, a_total_missing, "
             "'quality_pct', b_quality_pct, a_quality_pct) AS (metric, before_value, after_value)")
    return wide.selectExpr(stack).withColumn("delta", F.col("after_value") - F.col("before_value"))


# ----------------------------------------------------------------------------------------- A23-A26
def value_describe(df: DataFrame, column: str = "value", exact: bool = True) -> DataFrame:
    """Count, mean, std, min, quartiles (linear interpolation) and max, 2 decimals, as (stat, value)
    rows.

    ``exact=True`` computes the quartiles with ``exact_quantiles`` (distributed histogram ranks, no task
    holds all distinct values) and uses them as literals, and the deviation about the exact mean; ``exact=False`` uses ``percentile_approx``."""
    x = F.col(column)
    if exact:
        p25, p50, p75 = exact_quantiles(df, column, [0.25, 0.5, 0.75])
        q = F.array(*[F.lit(v).cast("double") for v in (p25, p50, p75)])
    else:
        q = F.percentile_approx(x, [0.25, 0.5, 0.75], 100000).cast("array<double>")
    mean = exact_avg(f"`{column}`", exact)
    std = exact_std(column, df.agg(mean).first()[0]) if exact else F.stddev_samp(x)
    one = df.agg(F.count(x).cast("double").alias("count"), mean.alias("mean"), std.alias("std"), F.min(x).alias("min"), F.max(x).alias("max"))
    one = one.select("count", "mean", "std", "min", q[0].alias("p25"), q[1].alias("p50"), q[2].alias("p75"), "max")
    stack = ("stack(8, 'count', count, 'mean', mean, 'std', std, 'min', min, '25%', p25, '50%', p50, "
             "'75%', p75, 'max', max) AS (stat, value)")
    return one.selectExpr(stack).select("stat", round2_half_even("value").alias("value"))


def negative_audit(df: DataFrame) -> DataFrame:
    """Negative readings overall and per pollutant, with their share of all rows (2 decimals).
    Rows: scope 'all' (pollutant NULL) and scope 'pollutant' (pollutants with at least one negative).

    One scan and one branch: ``GROUPING SETS ((), (pollutant))`` yields the grand total and the
    per-pollutant counts together; the grand total reaches the pollutant rows through a window over this
    tiny result, and a single projection labels the rows."""
    g = df.sparkSession.sql(
        "SELECT grouping_id(pollutant) AS gid, pollutant, count(*) AS n, "
        "CAST(sum(CASE WHEN value < 0 THEN 1 ELSE 0 END) AS BIGINT) AS neg "
        "FROM {df} GROUP BY GROUPING SETS ((), (pollutant))", df=df)
    g = g.withColumn("__rows", F.max(F.when(F.col("gid") == 1, F.col("n"))).over(Window.partitionBy()))
    total = F.col("gid") == 1
    return g.where(total | (F.col("neg") > 0)).select(
        F.when(total, F.lit("all")).otherwise(F.lit("pollutant")).alias("scope"),
        F.when(total, F.lit(None).cast("string")).otherwise(F.col("pollutant")).alias("pollutant"),
        F.coalesce(F.col("neg"), F.lit(0)).cast("long").alias("n_negative"),
        round2_half_even(pct(F.coalesce(F.col("neg"), F.lit(0)), "__rows")).alias("pct_of_rows"))


def duplicate_audit(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and surplus copies in one grouped pass (copies collapse map-side)."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    return g.agg(F.sum("__n").cast("long").alias("total_rows"),
                 F.count(F.lit(1)).cast("long").alias("distinct_rows"),
                 F.sum(F.col("__n") - 1).cast("long").alias("duplicate_rows"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Every member of every duplicate group (all copies, including the first).

    Grouped count, keep groups with more than one row, expand the multiplicity back chunk-wise — no
    22-column join and no whole group inside one task."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
    return expand_counts(g, "__n")


def dirty_sample(df: DataFrame, n: int = 10) -> DataFrame:
    """P5: a preview of rows missing ``at_c`` or ``ws_m_s`` (7 columns, first ``n`` in a fixed order).
    The limit is the feature (a sample for display); Spark plans it as a top-k."""
    cols = ["datetime", "station_id", "pollutant", "value", "at_c", "ws_m_s", "rh_percent"]
    return (df.where(F.col("at_c").isNull() | F.col("ws_m_s").isNull()).select(*cols)
              .orderBy(*[F.col(c).asc_nulls_first() for c in cols]).limit(n))


# ----------------------------------------------------------------------------------------- A29, A30
def _extremes(per_period: DataFrame, measure: str, ascending_label: str, descending_label: str) -> DataFrame:
    """Smallest and largest ``measure`` over a per-period table (earliest period breaks ties). The input is
    bounded by the number of months, so global windows are fine here. A single branch: each row carries the
    labels it earns (a one-period table earns both) and is exploded once per label."""
    lo = Window.orderBy(F.col(measure).asc_nulls_last(), F.col("period"))
    hi = Window.orderBy(F.col(measure).desc_nulls_last(), F.col("period"))
    ranked = per_period.where(F.col(measure).isNotNull()) \
        .withColumn("__lo", F.row_number().over(lo)).withColumn("__hi", F.row_number().over(hi))
    labels = F.filter(F.array(F.when(F.col("__lo") == 1, F.lit(ascending_label)),
                              F.when(F.col("__hi") == 1, F.lit(descending_label))), lambda x: x.isNotNull())
    return (ranked.where((F.col("__lo") == 1) | (F.col("__hi") == 1))
                  .withColumn("kind", F.explode(labels)).drop("__lo", "__hi"))


def month_extremes_who(df: DataFrame, exact: bool = True) -> DataFrame:
    """Cleanest and worst month by mean PM2.5, and the worst as a multiple of the WHO limit."""
    pm = non_null_keys(df.where(F.col("pollutant") == "pm25"), ["year", "month"])
    per = pm.groupBy("year", "month").agg(exact_avg("value", exact).alias("avg_pm25")) \
            .select(period_label().alias("period"), "avg_pm25")
    ext = _extremes(per, "avg_pm25", "cleanest", "worst")
    return ext.select("kind", "period", "avg_pm25",
                      (F.col("avg_pm25") / F.lit(WHO_PM25_LIMIT)).alias("who_multiple"))


def batch_size_extremes(df: DataFrame) -> DataFrame:
    """Smallest and largest monthly batch (rows per year-month)."""
    per = non_null_keys(df, ["year", "month"]).groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_rows")) \
        .select(period_label().alias("period"), "n_rows")
    return _extremes(per, "n_rows", "smallest", "largest").select("kind", "period", "n_rows")
