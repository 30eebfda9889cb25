"""SparkSession defaults and the shared checkpoint folder."""

from __future__ import annotations

import math
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, partitions: int | None = None,
                  app: str = "critiq", driver_memory: str = "16g") -> SparkSession:
    """Session for local runs and tests.

    On a cluster the caller's session (spark-submit) is used instead and only
    :func:`ensure_checkpoint_dir` is applied to it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    cpus = os.cpu_count() or 8
    conf = {
        "spark.sql.shuffle.partitions": str(partitions or cpus),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": driver_memory,
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _in_one_process(master: str) -> bool:
    """Do the executors of this master live in the driver's own process (``local``, ``local[...]``)?"""
    return re.fullmatch(r"local(\[.*\])?", master) is not None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the folder used by ``DataFrame.checkpoint``.

    The folder the cluster names in ``spark.checkpoint.dir`` (a shared file
    system) always wins. Only a session whose executors live in the driver's
    own process (master ``local`` or ``local[...]``: tests, a laptop) gets a
    scratch folder where that setting is missing; with any other master,
    ``local-cluster`` included, a missing setting is an error, because other
    machines could not read a machine-local folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # no SparkContext handle (Spark Connect): the server's setting applies
        return spark.conf.get(CHECKPOINT_CONF, None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if not _in_one_process(sc.master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder (e.g. on HDFS or an object store)")
        configured = tempfile.mkdtemp(prefix="critiq-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def materialize(df):
    """Write ``df`` once to the checkpoint folder and return a frame that reads it.

    For a result that several branches of one query consume (e.g. TF for the
    scores, DF and the group count): they then read the same files instead
    of each re-running the plan below, and the lineage is cut, so a lost
    executor does not send the recomputation back to the raw input.

    A checkpoint keeps the size estimate of the plan it cuts, and a join
    multiplies the estimates of its sides, so in a chain of materialised
    joins the digits of the estimate double with each step until the driver
    spends its time multiplying. The frame returned is therefore built anew
    over the checkpointed rows and has the default estimate; adaptive
    execution goes by the real sizes.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    kept = df.checkpoint(eager=True)
    if not hasattr(spark, "_jsparkSession"):  # Spark Connect: no handle on the rows
        return kept
    rows = kept._jdf.queryExecution().toRdd()
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(rows, kept._jdf.schema(), False), spark)


def shared_folder(spark: SparkSession, name: str) -> str:
    """URI of a fresh folder below the shared checkpoint folder, for files that the executors write and read."""
    ensure_checkpoint_dir(spark)
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get(CHECKPOINT_CONF)
    return re.sub(r"^file:/+", "file:///", f"{base}/{name}-{uuid.uuid4().hex}")


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python tasks of a local session, wherever the driver found it.

    The package folder is added to the session's files, which are on the
    import path of its Python workers. On a cluster the package comes with
    the job, as usual (``--py-files`` or an installed package).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # no SparkContext handle (Spark Connect)
        return
    folder = os.path.dirname(os.path.abspath(__file__))
    if _in_one_process(sc.master) and not any(f.rstrip("/").endswith(folder) for f in sc.listFiles):
        sc.addFile(folder, recursive=True)


_MIB = 1024 * 1024


def scale_conf(shuffle_bytes: int, cores: int, partition_bytes: int = 256 * _MIB,
               max_partitions: int = 100_000) -> dict[str, str]:
    """SQL settings for a run whose largest shuffle moves about ``shuffle_bytes``.

    * shuffle partitions: about ``partition_bytes`` each (so a task's sort
      and aggregation buffers fit in executor memory without heavy spill),
      at least two per core; ``max_partitions`` bounds this number alone
      (map-status and scheduling cost on the driver): partitions then grow,
      no row is left out. AQE then merges small partitions of
      the lighter shuffles (most shuffles here follow a map-side partial
      aggregation and are far smaller than the largest one).
    * skewed join partitions (a key holding a large share of the rows) are
      split by AQE once they exceed five times the median and 512 MiB.
    * scan splits of 512 MiB keep the task count of a 100 TB scan manageable.
    * the broadcast threshold is raised to 64 MiB: Spark's size check still
      decides, so a dimension that grows past it falls back to a sort-merge join.
    """
    partitions = math.ceil(shuffle_bytes / partition_bytes)
    partitions = max(2 * cores, min(max_partitions, partitions))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * _MIB),
        "spark.sql.files.maxPartitionBytes": str(512 * _MIB),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * _MIB),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * _MIB),
        "spark.sql.exchange.reuse": "true",
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    """Set runtime SQL settings on an existing session."""
    for k, v in conf.items():
        spark.conf.set(k, v)
