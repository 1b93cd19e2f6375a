"""Incremental month-by-month aggregation equals the one-shot batch result."""

import glob
import os

from aerolake.operators.clean import clean_data
from aerolake.operators.transform import batch_stats, level_counts
from aerolake.sources.fixture import load_fixture_raw
from aerolake.sources.partitioned import partition_dataset, replace_months
from aerolake.streaming import run_incremental, run_monthly

from raw_rows import SF_SMALL, make_raw


def _canon(df):
    return sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


def test_streamed_batch_stats_equal_batch(spark, tmp_out):
    clean = clean_data(load_fixture_raw(spark, SF_SMALL))
    root = os.path.join(tmp_out, "months")
    partition_dataset(clean, root)
    out, ckpt = os.path.join(tmp_out, "stats"), os.path.join(tmp_out, "ckpt")
    q = run_incremental(spark, root, batch_stats, out, ckpt, files_per_trigger=5)
    assert q.lastProgress is not None
    assert _canon(spark.read.parquet(out)) == _canon(batch_stats(clean))
    # a restart over the same checkpoint finds nothing new and keeps the snapshot
    run_incremental(spark, root, batch_stats, out, ckpt, files_per_trigger=5)
    assert spark.read.parquet(out).count() == 120


def test_streamed_level_counts(spark, tmp_out, mock):
    clean = clean_data(mock)
    root = os.path.join(tmp_out, "m")
    partition_dataset(clean, root)
    out, ckpt = os.path.join(tmp_out, "lc"), os.path.join(tmp_out, "ck")
    run_incremental(spark, root, level_counts, out, ckpt)
    assert _canon(spark.read.parquet(out)) == _canon(level_counts(clean))


def test_arriving_months_leave_the_others_alone(spark, tmp_out):
    """Months arrive, nothing arrives, one month is replaced: the mart equals the batch, other months keep their files."""
    raw = make_raw(spark, [{"month": 1 + k % 3, "value": float(k), "pollutant": p} for k in range(12) for p in ("pm25", "no2")])
    rows = [raw.where("month = 1"), raw.where("month <> 1")]
    root, mart, ckpt = (os.path.join(tmp_out, n) for n in ("months", "mart", "ckpt"))

    def load(df):
        replace_months(df, root)
        run_monthly(spark, root, batch_stats, mart, ckpt)

    files = lambda: set(glob.glob(f"{mart}/*/*/*.parquet"))
    load(rows[0])
    january = files()
    load(rows[1])
    both = files()
    assert january < both
    assert _canon(spark.read.parquet(mart)) == _canon(batch_stats(raw))
    run_monthly(spark, root, batch_stats, mart, ckpt)
    assert files() == both
    load(rows[0])  # the same month once more: counted once
    assert both - files() == january
    assert _canon(spark.read.parquet(mart)) == _canon(batch_stats(raw))
