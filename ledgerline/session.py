"""Session construction and checkpoint-directory handling."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every ledgerline job relies on.  ANSI stays on (bad casts raise
# unless written as try_cast); AQE coalesces small shuffles, splits skewed
# join partitions and converts joins to broadcast from *measured* sizes.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(input_bytes: int, total_cores: int,
                 target_partition_bytes: int = 256 * 1024 ** 2) -> dict:
    """Settings for a cluster run over ``input_bytes`` of Parquet.

    Scans split at ``target_partition_bytes``; the initial shuffle partition
    count is sized so one partition holds about that much (at least 3 waves
    of ``total_cores``), and AQE then coalesces small ones and splits skewed
    join partitions.  Returned as a dict to pass as ``extra`` to
    :func:`get_session` or to ``spark-submit --conf``."""
    parts = max(3 * total_cores, int(input_bytes // target_partition_bytes) + 1)
    size = str(target_partition_bytes)
    return {
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        # planner estimates come from compressed file sizes: keep them small;
        # AQE decides from measured shuffle output, which may go higher
        "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 ** 2),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
    }


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ledgerline", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the ledgerline defaults.

    ``master`` is only set when given, so on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only in local mode.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that value is
    used as is.  Only when nothing is configured *and* the master is local (tests,
    laptops) do we create a private scratch folder.  On a cluster with no
    directory configured we refuse rather than write to a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if configured.startswith("file:") and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is a machine-local folder; "
                               "name one that all executors share")
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; ledgerline needs a shared "
            "checkpoint folder on a cluster")
    path = tempfile.mkdtemp(prefix="ledgerline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def freeze(df: DataFrame, label: str = "frozen") -> DataFrame:
    """Cut lineage by writing ``df`` as a Parquet table under the reliable
    checkpoint folder and reading it back.

    Used where later steps must see *one* fixed layout (values derived from
    partition ids and row indexes): a lost executor then re-reads the written
    files instead of recomputing a possibly different layout.  Parquet keeps
    the copy columnar, so later passes read only the columns they need."""
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new name under the checkpoint folder; :func:`release_frozen` deletes what is written there."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerline-{label}-{uuid.uuid4().hex}"
    _frozen.append(path)
    return path


_frozen: list[str] = []


def release_frozen(spark: SparkSession) -> int:
    """Delete the folders that :func:`freeze` wrote, and return how many there were.

    To be called when results that read them have been written; a DataFrame that
    still reads a frozen folder fails afterwards."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    count = 0
    while _frozen:
        path = jvm.org.apache.hadoop.fs.Path(_frozen.pop())
        count += bool(path.getFileSystem(conf).delete(path, True))
    return count
