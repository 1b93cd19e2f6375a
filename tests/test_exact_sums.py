"""Exact sums, averages and deviations: the same bits for any order and partitioning, equal to rational arithmetic."""

import math
import random
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F
from raw_rows import SF_SMALL

from aerolake.functions import exact_avg, exact_std, exact_sum_sql
from aerolake.plans import registry


def _reading(rng):
    kind = rng.random()
    if kind < 0.4:
        return round(rng.uniform(-500, 500), rng.randint(0, 6))
    if kind < 0.6:
        return rng.uniform(-1, 1) * 2.0 ** rng.randint(-60, 60)
    if kind < 0.8:
        return rng.choice([0.0, -0.0, 1.0, -1.0, 2.0**-60, -2.0**60, 2.0**119, -2.0**119, 3.55e-15, 2.0**-119, 1e30, -1e25])
    return float(rng.randint(-2**62, 2**62))


def _groups(n):
    rng = random.Random(n)
    groups = []
    for k in range(n):
        xs = [_reading(rng) for _ in range(rng.randint(1, 12))]
        groups.append(xs + [-x for x in xs[:-1]] if k % 3 == 0 else xs)  # cancellation
    return [[x for x in xs if (Fraction(x) * 2**120).denominator == 1] or [0.1] for xs in groups]


def test_sums_equal_rational_arithmetic(spark):
    groups = _groups(250)
    rows = [(g, x) for g, xs in enumerate(groups) for x in xs]
    df = spark.createDataFrame(rows, "g int, v double").repartition(7)
    for r in df.groupBy("g").agg(F.expr(exact_sum_sql("v")).alias("s"), exact_avg("v").alias("m")).collect():
        want = float(sum(Fraction(x) for x in groups[r.g]))
        assert (r.s, r.m) == (want, want / len(groups[r.g]))


@pytest.mark.parametrize("parts", [1, 4, 211])
def test_same_bits_for_any_partitioning(spark, parts):
    rng = random.Random(9)
    rows = [(k % 3, rng.uniform(0, 500) if k % 2 else round(rng.uniform(0, 500), 2)) for k in range(3000)]
    want = {g: float(sum(Fraction(v) for k, v in rows if k == g)) for g in range(3)}
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g int, v double").repartition(parts)
    got = {r.g: r.s for r in df.groupBy("g").agg(F.expr(exact_sum_sql("v")).alias("s")).collect()}
    assert got == want


def test_expressions_nulls_and_what_the_grid_does_not_hold(spark):
    df = spark.createDataFrame([(1, 1.5, 1.0), (1, None, 2.0), (2, None, None), (3, math.inf, 1.0), (3, 1.0, 1.0), (4, 1e40, 1.0)],
                               "g int, a double, b double")
    got = {r.g: (r.m, r.d) for r in df.groupBy("g").agg(exact_avg("a").alias("m"), exact_avg("abs(a - b)").alias("d")).collect()}
    assert got == {1: (1.5, 0.5), 2: (None, None), 3: (math.inf, math.inf), 4: (1e40, 1e40)}


def test_deviation(spark):
    xs = [1e9 + 0.01 * k for k in range(200)]
    mean = sum(map(Fraction, xs)) / len(xs)
    want = math.sqrt(sum((Fraction(x) - mean) ** 2 for x in xs) / (len(xs) - 1))
    got = set()
    for parts in (1, 5, 50):
        df = spark.createDataFrame([(x,) for x in xs], "v double").repartition(parts)
        got.add(df.agg(exact_std("v", df.agg(exact_avg("v")).first()[0])).first()[0])
    assert len(got) == 1 and got.pop() == pytest.approx(want, rel=1e-6)
    one = spark.createDataFrame([(1.0,)], "v double")
    assert one.agg(exact_std("v", 1.0)).first()[0] is None


@pytest.mark.parametrize("name", ["forecast_mae", "station_means", "station_rank"])
def test_ties_do_not_depend_on_threads_or_partitions(spark, name):
    """Errors such as 116.965 are ties at two decimals: both engines give the same answer in every run."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_SMALL}/events.parquet'")
    answers, before = set(), spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in (1, 4, 211):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            frame = registry.queries()[name](spark, SF_SMALL)
            columns = sorted(frame.columns)
            answers.add(tuple(sorted(map(str, (tuple(r[c] for c in columns) for r in frame.collect())))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for threads in (1, 2, 8, 3, 5, 7, 4, 6):
        con.execute(f"SET threads = {threads}")
        rows = con.execute(registry.oracle_sql()[name])
        names = [d[0] for d in rows.description]
        answers.add(tuple(sorted(map(str, (tuple(dict(zip(names, r))[c] for c in columns) for r in rows.fetchall())))))
    assert len(answers) == 1
