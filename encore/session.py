"""Session helpers: a tuned local session for tests/bench, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins and coalesces small shuffle
# partitions at run time; skew-join splits hot join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Day partitions are yyyyMMdd *strings*; never let path discovery turn them into ints.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    # Remove checkpoint files (global_row_number) once their DataFrame is garbage.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def cluster_conf(largest_shuffle_bytes: int, target_partition_bytes: int = 256 << 20,
                 max_partitions: int = 200_000) -> dict[str, str]:
    """Settings for a cluster run sized by the largest shuffle of the day's jobs (e.g. the
    30-day play scan after column pruning).  AQE coalesces small partitions and splits
    skewed ones at run time, so this is an upper bound, not an exact count."""
    parts = max(200, min(max_partitions, -(-largest_shuffle_bytes // target_partition_bytes)))
    return {
        **{k: v for k, v in DEFAULT_CONF.items() if k != "spark.ui.enabled"},
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "encore", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``; we only pick our own folder when
    that setting is absent (local tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            conf_dir = None
    if not conf_dir:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("name a folder that all machines share in spark.checkpoint.dir")
        conf_dir = tempfile.mkdtemp(prefix="encore-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_path`` named, on whatever file system it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (on a cluster the one that spark.checkpoint.dir names)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/scratch/{name}-{uuid.uuid4().hex[:12]}"
