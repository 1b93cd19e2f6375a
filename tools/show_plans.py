"""Print the formatted physical plans of the headline queries over stored star tables, to check column
pruning (ReadSchema), pushdown (PushedFilters), dynamic partition pruning (PartitionFilters), broadcast
joins, exchange reuse and top-k.

    python tools/show_plans.py [sf_dir]
"""

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from aerolake.operators.clean import clean_data  # noqa: E402
from aerolake.operators.transform import batch_stats  # noqa: E402
from aerolake.plans import benchmark as B  # noqa: E402
from aerolake.plans.catalog import create_raw_schema, load_raw_data  # noqa: E402
from aerolake.session import get_session, scratch_path  # noqa: E402
from aerolake.sources.fixture import load_fixture_raw  # noqa: E402
from aerolake.sources.parquet import load_raw  # noqa: E402


def main(sf_dir: str) -> None:
    spark = get_session("local[8]", shuffle_partitions=8,
                        extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="aerolake-plans-")})
    raw_path = scratch_path(spark, "raw")
    load_fixture_raw(spark, sf_dir).repartition(8).write.parquet(raw_path)
    create_raw_schema(spark, "plans_db")
    load_raw_data(spark, "plans_db", raw_path)
    m, p, s = (spark.table("plans_db.measurements"), spark.table("plans_db.pollutants"),
               spark.table("plans_db.stations"))
    clean = clean_data(load_raw(spark, raw_path))
    for name, df in [("Q1 star", B.q1_avg_pm25_per_month(spark, m, p)),
                     ("Q2 star top-3", B.q2_top3_pm10(spark, m, p, s)),
                     ("Q4 star one station", B.q4_daily_peak_no2(spark, m, p, s)),
                     ("Q1 on the Parquet file", B.q1_direct_on_path(spark, raw_path)),
                     ("clean", clean),
                     ("batch stats over clean", batch_stats(clean))]:
        print(f"\n===================== {name}")
        df.explain("formatted")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
