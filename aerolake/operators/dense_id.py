"""A dense 1..N surrogate id over a large table, assigned in a defined total order.

SQL's ``ROW_NUMBER() OVER ()`` on a fact table funnels every row through one task. Instead:

1. Collapse identical rows into one row with a multiplicity (hash aggregate with map-side partial
   aggregation — a hot group of copies shrinks to one row per map task), then expand the multiplicity
   back chunk-wise as (row, copy index). Every row is now unique, so the order on (all columns, copy index)
   is total: range partitions are balanced even when one row has billions of copies, and every later step
   is deterministic, also when tasks are retried.
2. Range-partition and sort, then checkpoint to the shared checkpoint folder, so the id pass reads a fixed
   partitioning and the lineage is cut.
3. Collect one row count per partition — at most #partitions small rows — and turn them into offsets.
4. id = partition offset + partition-local row index (``monotonically_increasing_id`` keeps the index in
   its low 33 bits); the offsets arrive through a broadcast join of the #partitions-row offset table.

Copies of a row get consecutive ids; since they are identical, which copy gets which id is immaterial.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.operators.util import expand_counts
from aerolake.session import checkpoint_root

_N = "__n"
_K = "__k"


def _offset_ids(ordered: DataFrame, cols: list[str], id_col: str, start: int) -> DataFrame:
    """Ids for a frame whose partitioning and row order are fixed (checkpointed or a stable file scan).

    Partition id and local index are taken on the scan side; the per-partition offsets (one small row per
    partition, a bound known up front) are attached by a broadcast hash join, which keeps the streamed
    side's partitions and row order — so no offset table is inlined into every task."""
    spark = ordered.sparkSession
    totals = ordered.groupBy(F.spark_partition_id().alias("pid")).agg(F.count(F.lit(1)).alias("rows")).collect()
    if not totals:
        return ordered.select(F.lit(None).cast("long").alias(id_col), *cols)
    offsets, acc = [], start
    for r in sorted(totals, key=lambda r: r["pid"]):
        offsets.append((r["pid"], acc))
        acc += r["rows"]
    offs = spark.createDataFrame(offsets, "__pid int, __off long")
    pid = F.spark_partition_id()
    tagged = ordered.select(pid.alias("__pid"),
                            (F.monotonically_increasing_id() - pid.cast("long") * F.lit(1 << 33)).alias("__local"),
                            *cols)
    # A partition that was not counted means that the two passes saw different partitions: fail, never lose rows.
    offset = F.coalesce("__off", F.raise_error(F.lit("dense ids: input partitions changed between passes")).cast("long"))
    return tagged.join(F.broadcast(offs), "__pid", "left").select((offset + F.col("__local")).alias(id_col), *cols)


def assign_dense_ids(df: DataFrame, id_col: str = "id", order_cols: list[str] | None = None,
                     start: int = 1, num_partitions: int | None = None, stable_input: bool = False) -> DataFrame:
    """Return ``df`` with ``id_col`` (bigint, ``start``..``start+N-1``) first.

    With ``order_cols`` the ids follow the ascending order (NULLs first) of ``order_cols`` and then of the
    remaining columns — reproducible on any engine (steps 1-4 above).

    Without ``order_cols`` the ids follow the input's own partition order, like an unordered
    ``ROW_NUMBER() OVER ()``, and no shuffle is needed: one counting pass, one assigning pass. Both passes
    must see identical partitions, so the input is checkpointed first unless the caller vouches that it is
    ``stable_input`` (a file scan plus narrow operators such as a broadcast join or filter)."""
    spark = df.sparkSession
    checkpoint_root(spark)
    cols = df.columns
    if order_cols is None:
        fixed = df if stable_input else df.checkpoint(eager=True)
        return _offset_ids(fixed, cols, id_col, start)

    lead = list(order_cols)
    order = lead + [c for c in cols if c not in lead]
    grouped = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(_N))
    unique = expand_counts(grouped, _N, index_col=_K, spread_partitions=num_partitions)
    sort_exprs = [F.col(c).asc_nulls_first() for c in order] + [F.col(_K).asc()]
    # Without an explicit count AQE sizes the range partitions from the shuffle statistics.
    ranged = unique.repartitionByRange(num_partitions, *sort_exprs) if num_partitions else \
        unique.repartitionByRange(*sort_exprs)
    ordered = ranged.sortWithinPartitions(*sort_exprs)
    return _offset_ids(ordered.checkpoint(eager=True), cols, id_col, start)
