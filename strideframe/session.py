"""Session helpers.

``build_session`` is for tests, the CLI and the bench; library code never
creates a session, it receives one.  ``shared_dir`` resolves the folder that
every executor can see (``spark.checkpoint.dir``); it only falls back to a
fresh local folder when the setting is unset, which is the local/test case.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "strideframe", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for the input: shuffle partitions ~ input / 256 MB
    (AQE coalesces small ones and splits skewed ones at run time), scan
    splits of 256 MB, broadcast of runtime-measured small sides only."""
    parts = max(200, input_bytes // partition_bytes)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def apply_if_unset(spark: SparkSession, conf: dict[str, str]) -> None:
    """Set each option only where the session does not already define it."""
    for k, v in conf.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)


def shared_dir(spark: SparkSession, name: str | None = None) -> str:
    """A path under the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset
    on a local master (local runs, tests) a private folder is created and
    registered as the checkpoint dir, so ``DataFrame.checkpoint()`` works as
    well; on a cluster an unset setting is an error, never a machine-local
    folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = jdir.get() if jdir.isDefined() else None
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach "
                               "(a distributed file system or object store)")
        base = tempfile.mkdtemp(prefix="strideframe-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    if name is None:
        return base
    return base.rstrip("/") + "/" + name + "-" + uuid.uuid4().hex[:12]


def reliable_checkpoint(df, name: str = "table"):
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder
    and return a frame that reads it back — lineage cut at the files.

    For intermediate tables that are read several times and may be large:
    the files survive the loss of any executor, so a later read never
    replays the upstream shuffles, and the columnar files are cheaper to
    re-read than an RDD checkpoint.  Each call writes a new folder."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


__all__ = ["build_session", "cluster_conf", "apply_if_unset", "shared_dir", "reliable_checkpoint"]
