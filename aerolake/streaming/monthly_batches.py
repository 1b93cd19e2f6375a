"""Month-at-a-time batch processing as an incremental Structured Streaming job.

The source processes data "in discrete monthly batches on a fixed schedule". On Spark the natural form is a
file stream over the hive-partitioned layout (``year=YYYY/month=MM``): each trigger picks up the month
files that arrived since the last one, the mart builder (batch statistics, level counts, monthly averages,
daily peaks — any aggregate) runs as a stateful streaming aggregation, and the complete, bounded result is
written as a snapshot after every micro-batch. The checkpoint location records which files were consumed
and the aggregation state, so a restarted job (or a lost executor) resumes without double counting;
``availableNow`` processes everything present and stops, which is the "scheduled batch" behaviour.

Because the builders use order-independent aggregates (exact sums, counts, min/max; the sample deviation
differs in its last bits at most, which its two decimals do not show), the streamed result equals the one-shot batch result no matter how files are split into
micro-batches.

``run_monthly`` is the form for marts that are large themselves: it rewrites the directories of the months that arrived.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def incremental_aggregate(spark: SparkSession, partitioned_root: str, builder: Callable[[DataFrame], DataFrame],
                          schema: StructType | None = None, files_per_trigger: int = 1) -> DataFrame:
    """A streaming DataFrame: ``builder`` applied to a file stream over the partitioned layout.

    ``schema`` must include the partition columns (year, month); by default it is taken from the files
    already present. ``files_per_trigger`` bounds the work per micro-batch."""
    sch = schema or spark.read.parquet(partitioned_root).schema
    stream = (spark.readStream.schema(sch).option("maxFilesPerTrigger", files_per_trigger)
              .parquet(partitioned_root))
    return builder(stream)


def run_incremental(spark: SparkSession, partitioned_root: str, builder: Callable[[DataFrame], DataFrame],
                    output_path: str, checkpoint_location: str, schema: StructType | None = None,
                    files_per_trigger: int = 1, available_now: bool = True, timeout_s: float | None = None,
                    state_partitions: int = 16):
    """Run the incremental aggregation to a Parquet snapshot at ``output_path``.

    Complete output mode: every micro-batch rewrites the (bounded) aggregate, so the snapshot always holds
    the result over all months seen so far; a retried micro-batch rewrites the same content. With
    ``available_now`` the query stops once every present file is processed. Returns the finished query.

    ``state_partitions``: the aggregation state holds one row per output group (months x pollutants), so a
    few state partitions suffice at any input volume — the map side still runs on every input split, with
    partial aggregation before the state shuffle. The number is fixed by the first run of a checkpoint."""
    agg = incremental_aggregate(spark, partitioned_root, builder, schema, files_per_trigger)

    def write_snapshot(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(output_path)

    writer = (agg.writeStream.outputMode("complete").foreachBatch(write_snapshot)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    previous = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        query = writer.start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)
    if available_now:
        query.awaitTermination(timeout_s)
    return query


def refresh_months(spark: SparkSession, partitioned_root: str, builder: Callable[[DataFrame], DataFrame], mart_root: str,
                   months: DataFrame) -> None:
    """Bring a mart up to date after some months were loaded or replaced: ``builder``'s groups of those months are made
    anew from their month directories alone and replace the mart's directories of the same months. Every group belongs to
    one (year, month), so all of its rows are in the directory that is read, and all other groups, with their files, stay
    as they are. ``months``: (year, month) of the months touched, as ``replace_months`` returns them."""
    touched = F.broadcast(months.select("year", "month").distinct())  # one row a month; prunes the directories
    rows = spark.read.parquet(partitioned_root).join(touched, ["year", "month"], "left_semi")
    builder(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("year", "month").parquet(mart_root)


def run_monthly(spark: SparkSession, partitioned_root: str, builder: Callable[[DataFrame], DataFrame], mart_root: str,
                checkpoint_location: str, schema: StructType | None = None, files_per_trigger: int = 1000,
                timeout_s: float | None = None):
    """Process every month file that arrived since the last run, and write only the months it belongs to.

    Each micro-batch takes from its files nothing but their (year, month), and ``refresh_months`` makes those months'
    groups anew from the month directories. So no state is kept, a retried micro-batch writes the same again, a replaced
    month (``replace_months``) counts once, and all other months' files in the mart stay as they are, where
    ``run_incremental`` rewrites the whole snapshot. ``builder``'s groups must hold ``year`` and ``month``, and
    ``partitioned_root`` must be complete for a month once its files are there. Files that a later load replaced before they
    were read are passed over: the files in their place are arrivals of their own. Returns the finished query."""
    stream = (spark.readStream.schema(schema or spark.read.parquet(partitioned_root).schema)
              .option("maxFilesPerTrigger", files_per_trigger).option("ignoreMissingFiles", "true")
              .parquet(partitioned_root).select("year", "month"))

    def refresh(batch: DataFrame, epoch_id: int) -> None:
        refresh_months(batch.sparkSession, partitioned_root, builder, mart_root, batch)

    query = (stream.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint_location)
             .trigger(availableNow=True).start())
    query.awaitTermination(timeout_s)
    return query
