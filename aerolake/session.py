"""Session construction and shared-storage helpers.

Everything that has to outlive a task (lineage cuts, scratch tables) goes under the folder the cluster names
in ``spark.checkpoint.dir``. A local fallback is only created when that setting is absent (tests, laptops).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on. Time zone: the source is UTC-aware and the fact tables store zone-less
# timestamps, so the session must render and extract in UTC.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


MB = 1 << 20


def scale_conf(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Settings sized for the input volume and the cluster, so partitions fit executor memory.

    * Scans: 256 MB splits (100 TB -> ~400k scan tasks instead of ~800k with the 128 MB default).
    * Shuffles: the widest shuffle is the full-row de-duplication, about the size of the input; start with
      one partition per ~200 MB of it (at least 2 x cores) and let AQE coalesce towards 256 MB partitions,
      so no reducer has to spill gigabytes.
    * Skew: a partition 4x the median and above 512 MB is split by AQE's skew-join handling.
    * Broadcast: dimensions and the median table are small; 64 MB lets AQE broadcast them at runtime.
    """
    partitions = max(2 * total_cores, input_bytes // (200 * MB) + 1)
    return {
        "spark.sql.files.maxPartitionBytes": str(256 * MB),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * MB),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * MB),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * MB),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * MB),
    }


def get_session(master: str | None = None, app_name: str = "aerolake",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    On a cluster call it without ``master``; the launcher decides. ``shuffle_partitions`` should be sized so
    one shuffle partition is ~128-256 MB of the widest shuffle (the dedup in cleaning).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session; set a local one only when the cluster names none."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="aerolake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder (never a machine-local temp dir on a cluster)."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so plain-Python code (report writer, tests) can use the path."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)


def run_concurrently(spark: SparkSession, *steps):
    """Run independent Spark actions from separate driver threads so the scheduler overlaps their jobs
    (Spark accepts jobs from several threads of one application). Local properties such as the job
    description are inherited; the first error is re-raised after all steps finished."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target

    with ThreadPoolExecutor(max_workers=max(1, len(steps))) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    errors = [f.exception() for f in futures if f.exception() is not None]
    if errors:
        raise errors[0]
    return [f.result() for f in futures]
