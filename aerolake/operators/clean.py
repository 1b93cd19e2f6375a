"""C1 cleaning (P2 -> P3 -> D3 -> A27/J5) and the imputation audit A28.

Order matters and is kept: drop the three redundant columns, remove negative readings (keeping missing
ones), remove exact duplicate rows, then fill missing weather readings with the exact median of their
(station_id, month) group computed on the already filtered and de-duplicated rows.

Plan shape: narrow projection/filter (pushed into the scan) -> one dedup hash aggregate (partial aggregation
collapses copies map-side, so a hot group of copies costs one row per map task) -> the eight medians from
one value histogram (see ``histogram_medians``) -> a join back on (station_id, month). The median table
has at most (#station-month keys) rows; a caller that knows a bound gets a broadcast hint under it, otherwise the
adaptive planner decides from the size it turns out to have (a shuffle join splits skew).

Deviation from pandas, on purpose: a row whose station_id or month is NULL keeps its weather values
(pandas' grouped transform would blank them); such rows simply find no median.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolake.operators.util import BROADCAST_MAX_ROWS, broadcast_if_bounded
from aerolake.schema import DROPPED_BY_CLEANING, IMPUTE_KEYS, WEATHER_COLUMNS


def drop_redundant(df: DataFrame) -> DataFrame:
    """Drop the all-null and duplicated columns if present (``drop`` ignores absent ones)."""
    return df.drop(*DROPPED_BY_CLEANING)


def remove_negative(df: DataFrame) -> DataFrame:
    """Drop readings below zero, keep missing ones (``value >= 0`` alone would drop NULLs)."""
    if "value" not in df.columns:
        return df
    return df.where(F.col("value").isNull() | (F.col("value") >= 0))


def remove_duplicates(df: DataFrame) -> DataFrame:
    """D3: full-row de-duplication (NULL equals NULL, NaN equals NaN, -0.0 equals 0.0)."""
    return df.dropDuplicates()


def _fingerprint(df: DataFrame):
    """64-bit hash of a row under which rows that grouping takes as equal are equal (one NaN, no negative zero)."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.dataType.typeName() in ("double", "float"):
            c = F.when(F.isnan(c), F.lit(float("nan"))).otherwise(c + F.lit(0.0))
        parts.append(c)
    return F.xxhash64(*parts)


def remove_duplicates_by_fingerprint(df: DataFrame, max_held: int = 2_000_000) -> DataFrame:
    """D3 for inputs too large to shuffle whole: the same rows as ``remove_duplicates``, but only rows that may have a
    copy are shuffled.

    A first pass counts the rows' 64-bit fingerprints (9 bytes a row in the shuffle instead of the whole row; copies
    collapse map-side) and writes those that occur twice or more to the shared folder. Up to ``max_held`` of them (a
    counted bound of some tens of megabytes) are broadcast, and the second pass keeps all other rows where they are and
    de-duplicates the rest. Two different rows of one fingerprint are merely shuffled too. With more fingerprints than
    that, most of the input would be shuffled anyway: then the plain form is used. ``df`` must be a stable scan,
    because it is read twice."""
    from aerolake.session import scratch_path

    spark = df.sparkSession
    path = scratch_path(spark, "fingerprints")
    df.select(_fingerprint(df).alias("__fp")).groupBy("__fp").agg(F.count(F.lit(1)).alias("__n")) \
        .where(F.col("__n") > 1).select("__fp").write.parquet(path)
    held = spark.read.schema("__fp bigint").parquet(path)
    n = held.limit(max_held + 1).count()
    if n == 0:
        return df
    if n > max_held:
        return remove_duplicates(df)
    small, marked = F.broadcast(held), df.withColumn("__fp", _fingerprint(df))
    alone = marked.join(small, "__fp", "left_anti").drop("__fp")
    return alone.unionByName(remove_duplicates(marked.join(small, "__fp", "left_semi").drop("__fp")))


def histogram_medians(df: DataFrame, columns, keys=IMPUTE_KEYS) -> DataFrame:
    """Exact interpolated medians per group from a value histogram (A27 for hot groups).

    The weather columns are unpivoted, a (group, column, value) -> count histogram is built (partial
    aggregation collapses repeats map-side; the shuffle spreads a hot group's values over reducers by value),
    each histogram row gets its rank interval through a running count over its (group, column) — rows
    bounded by the number of distinct values, not by the group's row count — and the one or two rows
    covering the middle ranks give the median with Spark's interpolation 0.5 * lo + 0.5 * hi."""
    keys = list(keys)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("double").alias("v"))
                                for c in columns])).alias("cell")
    long = df.select(*keys, cells).select(*keys, "cell.col", "cell.v").where(F.col("v").isNotNull())
    hist = long.groupBy(*keys, "col", "v").agg(F.count(F.lit(1)).alias("c"))
    # One exchange of the (small) histogram by group: the per-column window and both aggregates below are
    # then satisfied by this partitioning and add no further shuffle.
    hist = hist.repartition(*[F.col(k) for k in keys])
    ordered = Window.partitionBy(*keys, "col").orderBy("v")
    run = ordered.rowsBetween(Window.unboundedPreceding, 0)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # same sort, one operator
    ranked = hist.select(*keys, "col", "v", "c", F.sum("c").over(run).alias("end"), F.sum("c").over(whole).alias("n"))
    lo = F.floor((F.col("n") - 1) / 2)
    hi = F.ceil((F.col("n") - 1) / 2)
    start = F.col("end") - F.col("c")
    covering = ranked.where(((start <= lo) & (F.col("end") > lo)) | ((start <= hi) & (F.col("end") > hi)))
    mids = covering.groupBy(*keys, "col").agg(F.min("v").alias("lo_v"), F.max("v").alias("hi_v"))
    med = F.when(F.col("lo_v") == F.col("hi_v"), F.col("lo_v")) \
        .otherwise(F.lit(0.5) * F.col("lo_v") + F.lit(0.5) * F.col("hi_v"))
    wide = mids.groupBy(*keys).agg(*[F.max(F.when(F.col("col") == c, med)).alias(f"__med_{c}") for c in columns])
    # groups whose readings are all missing have no histogram rows; they simply find no median later
    return wide


def bucketed_medians(df: DataFrame, columns, keys=IMPUTE_KEYS, buckets: int = 64) -> DataFrame:
    """Exact medians like ``histogram_medians`` with no task ranking all distinct values of one group.

    Per weather column, approximate-quantile boundaries of its values (one small aggregate, collected as a
    constant-folded literal map) cut the value axis into ``buckets`` ranges; a hot group dominates those
    quantiles, so its values spread over many buckets. Bucket totals per (group, column, bucket) give each
    bucket its starting rank through a window over at most ``buckets`` rows per (group, column); a running
    count inside each (group, column, bucket) gives every histogram row its rank interval."""
    import json

    keys = list(keys)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("double").alias("v"))
                                for c in columns])).alias("cell")
    long = df.select(*keys, cells).select(*keys, "cell.col", "cell.v").where(F.col("v").isNotNull())
    cuts = [i / buckets for i in range(1, buckets)]
    bounds = {r["col"]: sorted(set(r["b"] or [])) for r in
              long.groupBy("col").agg(F.percentile_approx("v", cuts, 10 * buckets).alias("b")).collect()}
    bmap = F.from_json(F.lit(json.dumps({c: [float(x) for x in bounds.get(c, [])] for c in columns})),
                       "map<string,array<double>>")
    hist = long.groupBy(*keys, "col", "v").agg(F.count(F.lit(1)).alias("c")) \
        .withColumn("bk", F.size(F.filter(F.coalesce(F.element_at(bmap, F.col("col")), F.array().cast("array<double>")),
                                          lambda b: b < F.col("v"))))
    totals = hist.groupBy(*keys, "col", "bk").agg(F.sum("c").alias("t"))
    by_group = Window.partitionBy(*keys, "col").orderBy("bk")
    offsets = totals.select(*keys, "col", "bk",
                            (F.sum("t").over(by_group.rowsBetween(Window.unboundedPreceding, 0)) - F.col("t")).alias("off"),
                            F.sum("t").over(by_group.rowsBetween(Window.unboundedPreceding,
                                                                 Window.unboundedFollowing)).alias("n"))
    within = Window.partitionBy(*keys, "col", "bk").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = hist.join(offsets, [*keys, "col", "bk"]) \
        .select(*keys, "col", "v", "c", "n", (F.col("off") + F.sum("c").over(within)).alias("end"))
    lo = F.floor((F.col("n") - 1) / 2)
    hi = F.ceil((F.col("n") - 1) / 2)
    start = F.col("end") - F.col("c")
    covering = ranked.where(((start <= lo) & (F.col("end") > lo)) | ((start <= hi) & (F.col("end") > hi)))
    mids = covering.groupBy(*keys, "col").agg(F.min("v").alias("lo_v"), F.max("v").alias("hi_v"))
    med = F.when(F.col("lo_v") == F.col("hi_v"), F.col("lo_v")) \
        .otherwise(F.lit(0.5) * F.col("lo_v") + F.lit(0.5) * F.col("hi_v"))
    return mids.groupBy(*keys).agg(*[F.max(F.when(F.col("col") == c, med)).alias(f"__med_{c}") for c in columns])


#: Distinct values of one (group, column) that are ranked in one window; groups with more are narrowed first.
RANKED_AT_MOST = 100_000
#: Ranges that a narrowed group's distinct values are cut into, and tasks that its histogram rows are dealt over.
RANGES, FINE, SALTS = 1024, 32, 64


def _histogram(df: DataFrame, columns, keys) -> DataFrame:
    """(keys, col, v, c): how often each reading of each weather column occurs in its group. Partial aggregation
    collapses repeats map-side, and the shuffle deals a hot group by value."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("double").alias("v"))
                                for c in columns])).alias("cell")
    long = df.select(*keys, cells).select(*keys, "cell.col", "cell.v").where(F.col("v").isNotNull())
    return long.groupBy(*keys, "col", "v").agg(F.count(F.lit(1)).alias("c"))


def _join_each(rows: DataFrame, groups: DataFrame, names, how: str = "inner") -> DataFrame:
    """Join on ``names``, NULL equal to NULL; the columns of ``rows``, then the other columns of ``groups``."""
    other = groups.select(*[F.col(n).alias(f"__g_{n}") if n in names else F.col(n) for n in groups.columns])
    cond = F.lit(True)
    for n in names:
        cond = cond & rows[n].eqNullSafe(other[f"__g_{n}"])
    return rows.join(other, cond, how).drop(*[f"__g_{n}" for n in names])


def _for_each_salt(groups: DataFrame) -> DataFrame:
    return groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _covering(rows: DataFrame, window, before) -> DataFrame:
    """The one or two histogram rows that hold the middle ranks of their group; ``n`` is the group's row count and
    ``before`` counts its rows below the window."""
    end = F.sum("c").over(window.rowsBetween(Window.unboundedPreceding, 0)) + before
    ranked = rows.withColumn("end", end)
    lo, hi, start = F.floor((F.col("n") - 1) / 2), F.ceil((F.col("n") - 1) / 2), F.col("end") - F.col("c")
    return ranked.where(((start <= lo) & (F.col("end") > lo)) | ((start <= hi) & (F.col("end") > hi)))


def middle_ranges(rows: DataFrame, group) -> DataFrame:
    """Of groups too large for one window, the histogram rows in the ranges that hold the middle ranks.

    ``rows``: (group, salt, v, c). Approximate quantiles of each group's distinct values cut it into ``RANGES``
    ranges of nearly as many distinct values; a hot group's rows stay dealt by ``salt`` while they are placed. Exact counts by
    range (at most ``RANGES`` rows a group) say which one or two ranges hold the middle ranks and how many readings
    lie below (``off``), so whatever the quantiles' error, nothing is lost. A range has at most about
    1.2 / ``RANGES`` of the group's distinct values."""
    cuts = [i / RANGES for i in range(1, RANGES)]
    # The row count is taken here again, from the same exchange of the histogram, and used below.
    bounds = rows.groupBy(*group).agg(F.percentile_approx("v", cuts, 10 * RANGES).alias("b"), F.sum("c").alias("n")) \
        .withColumn("coarse", F.filter("b", lambda x, i: (i + 1) % FINE == 0))
    v, step = F.col("v"), F.size(F.filter("coarse", lambda x: x < F.col("v"))) * FINE
    placed = _join_each(rows, _for_each_salt(bounds), [*group, "salt"]) \
        .select(*group, "v", "c", "n", (step + F.size(F.filter(F.slice("b", step + 1, FINE), lambda x: x < v)))
                .alias("range"))
    totals = placed.groupBy(*group, "range").agg(F.sum("c").alias("c"), F.max("n").alias("n"))
    held = _covering(totals, Window.partitionBy(*group).orderBy("range"), F.lit(0)) \
        .select(*group, "range", (F.col("end") - F.col("c")).alias("off"))
    return _join_each(placed, held, [*group, "range"])


def narrowed_medians(df: DataFrame, columns, keys=IMPUTE_KEYS, ranked_at_most: int = RANKED_AT_MOST) -> DataFrame:
    """Exact medians like ``histogram_medians``, with the split chosen for each group from its measured distinct values.

    All groups are in one plan: up to ``ranked_at_most`` by a running count over the
    (group, column); beyond that only the ranges around the middle ranks are ranked (``middle_ranges``), so no
    window holds more than ``ranked_at_most`` values, or 1.2 / 1,024 of a group's distinct values where that is more (past
    85 million distinct readings of one column in one station-month). Where no group is that large, the second way gets
    no rows. The one or two rows at the middle ranks give the median with Spark's
    interpolation 0.5 * lo + 0.5 * hi."""
    keys = list(keys)
    group = [*keys, "col"]
    hist = _histogram(df, columns, keys)
    # The row count is taken along, so this reads the histogram's own exchange again instead of counting anew.
    large = hist.groupBy(*group).agg(F.count(F.lit(1)).alias("d"), F.sum("c").alias("n")) \
        .where(F.col("d") > ranked_at_most).select(*group, "n")
    salted = hist.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    marked = _join_each(salted, _for_each_salt(large), [*group, "salt"], "left")
    # One exchange of the (small) histogram by group serves the windows of all columns.
    small = marked.where(F.col("n").isNull()).select(*group, "v", "c").repartition(*[F.col(k) for k in keys])
    whole = Window.partitionBy(*group).orderBy("v").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_value = Window.partitionBy(*group).orderBy("v")
    found = _covering(small.withColumn("n", F.sum("c").over(whole)), by_value, F.lit(0)).select(*group, "v")
    middle = middle_ranges(marked.where(F.col("n").isNotNull()).drop("n"), group)
    by_range = Window.partitionBy(*group, "range").orderBy("v")
    both = found.unionByName(_covering(middle, by_range, F.col("off")).select(*group, "v"))
    meds = []
    for c in columns:
        here = F.when(F.col("col") == c, F.col("v"))
        lo, hi = F.min(here), F.max(here)
        meds.append(F.when(lo == hi, lo).otherwise(F.lit(0.5) * lo + F.lit(0.5) * hi).alias(f"__med_{c}"))
    # groups whose readings are all missing have no histogram rows; they simply find no median later
    return both.groupBy(*keys).agg(*meds)


def group_medians(df: DataFrame, columns=None, keys=IMPUTE_KEYS, method: str = "histogram",
                  accuracy: int = 100_000) -> DataFrame:
    """Median of each weather column per (station_id, month), all eight columns in one pass; an
    all-missing group yields NULL.

    ``method="histogram"`` (default): exact, via ``histogram_medians`` — a hot station-month's values are
    merged across many reducers, and the only per-group task ranks the group's distinct values.
    ``method="bucketed"``: exact as well, via ``bucketed_medians`` — additionally splits one group's
    distinct values over value buckets, for continuous (unquantised) readings.
    ``method="narrowed"``: exact, via ``narrowed_medians`` — only groups of more than ``RANKED_AT_MOST`` distinct values
    are cut, each at its own quantiles, and only their middle is ranked. For inputs with hot station-months of
    continuous readings; its larger plan took about 3 s more at sf0.1, hence not the default.
    ``method="exact"``: Spark's exact ``median`` (interpolated, like pandas); same result, but the final merge
    of a group's partial value -> count maps (one per map task) happens in one reducer, fine for small data
    or coarse readings. ``method="approx"``: ``percentile_approx`` with ``accuracy``, bounded memory — an
    explicit opt-in, results may differ from pandas."""
    cols = [c for c in (columns or WEATHER_COLUMNS) if c in df.columns]
    if method == "histogram":
        return histogram_medians(df, cols, keys)
    if method == "narrowed":
        return narrowed_medians(df, cols, keys)
    if method == "bucketed":
        return bucketed_medians(df, cols, keys)
    if method == "approx":
        return df.groupBy(*keys).agg(*[F.percentile_approx(c, 0.5, accuracy).cast("double").alias(f"__med_{c}")
                                       for c in cols])
    return df.groupBy(*keys).agg(*[F.median(c).alias(f"__med_{c}") for c in cols])


def _join_medians(df: DataFrame, medians: DataFrame, keys=IMPUTE_KEYS) -> DataFrame:
    """Left join on the group keys with NULL-safe equality. A plain equality would make the optimizer
    infer ``IS NOT NULL`` filters for the median side only; the two copies of the de-duplication below
    the join would then differ and its shuffle would run twice instead of being reused."""
    med = medians.select(*[F.col(k).alias(f"__key_{k}") for k in keys],
                         *[c for c in medians.columns if c not in keys])
    cond = None
    for k in keys:
        e = df[k].eqNullSafe(med[f"__key_{k}"])
        cond = e if cond is None else cond & e
    return df.join(med, cond, "left")


def _keys_present(keys=IMPUTE_KEYS):
    cond = None
    for k in keys:
        e = F.col(k).isNotNull()
        cond = e if cond is None else cond & e
    return cond


def impute_with_medians(df: DataFrame, medians: DataFrame, columns=None, keys=IMPUTE_KEYS) -> DataFrame:
    """Fill NULL weather readings with their group median; column order is preserved. Rows with a
    NULL group key are left as they are."""
    cols = [c for c in (columns or WEATHER_COLUMNS) if c in df.columns]
    joined = _join_medians(df, medians, keys)
    has_key = _keys_present(keys)
    out = []
    for c in df.columns:
        if c in cols:
            out.append(F.coalesce(F.col(c), F.when(has_key, F.col(f"__med_{c}"))).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def deduplicated_readings(df: DataFrame, by_fingerprint: bool = False) -> DataFrame:
    """C1 up to D3: what cleaning keeps, before weather readings are filled. Imputation changes weather columns only,
    so a mart that reads none of them takes this frame: one dedup shuffle, no medians, and its own filters on the
    grouping columns go below the dedup."""
    kept = remove_negative(drop_redundant(df))
    return remove_duplicates_by_fingerprint(kept) if by_fingerprint else remove_duplicates(kept)


def clean_data(df: DataFrame, median_broadcast_max_rows: int = BROADCAST_MAX_ROWS,
               median_rows_bound: int | None = None, median_method: str = "histogram",
               by_fingerprint: bool = False) -> DataFrame:
    """The full cleaning, lazily planned (one dedup shuffle, the median histogram, one join).

    ``median_rows_bound``: a known upper bound of the (station_id, month) keys, e.g. stations x 12 from the
    stations dimension; under ``median_broadcast_max_rows`` the medians are hinted as broadcast. Without it the
    adaptive planner decides from the size the medians turn out to have. ``by_fingerprint``: see
    ``remove_duplicates_by_fingerprint`` (one job runs at once)."""
    base = deduplicated_readings(df, by_fingerprint)
    if not all(k in base.columns for k in IMPUTE_KEYS):
        return base
    medians = group_medians(base, method=median_method)
    if median_rows_bound is not None:
        medians = broadcast_if_bounded(medians, bound=median_rows_bound, max_rows=median_broadcast_max_rows)
    return impute_with_medians(base, medians)


def imputation_audit(df: DataFrame) -> DataFrame:
    """Per weather column, missing before / after imputation and values filled, plus a total row.

    One aggregate pass over the de-duplicated rows joined with their medians: a reading is filled exactly
    when it is missing and its group median is not."""
    base = deduplicated_readings(df)
    cols = [c for c in WEATHER_COLUMNS if c in base.columns]
    joined = _join_medians(base, group_medians(base))
    has_key = _keys_present()
    aggs = []
    for c in cols:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"b_{c}"))
        aggs.append(F.count_if(F.col(c).isNull() & ~(has_key & F.col(f"__med_{c}").isNotNull())).alias(f"a_{c}"))
    one = joined.agg(*aggs)
    tb = " + ".join(f"b_{c}" for c in cols)
    ta = " + ".join(f"a_{c}" for c in cols)
    pairs = [f"'{c}', b_{c}, a_{c}" for c in cols] + [f"'total', {tb}, {ta}"]
    long = one.selectExpr(f"stack({len(pairs)}, {', '.join(pairs)}) AS (column_name, missing_before, missing_after)")
    return long.select("column_name",
                       F.col("missing_before").cast("long").alias("missing_before"),
                       F.col("missing_after").cast("long").alias("missing_after"),
                       (F.col("missing_before") - F.col("missing_after")).cast("long").alias("filled"))
