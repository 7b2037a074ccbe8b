"""Session construction and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at any scale: AQE re-plans joins and partition counts
# from runtime sizes, splits skewed join partitions, and coalesces tiny
# shuffle partitions.  Partition count and file split size are left to the
# caller: on a large cluster set ``spark.sql.shuffle.partitions`` so that one
# shuffle partition holds roughly 128-256 MB.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "shelfcast",
    shuffle_partitions: int | None = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    Used by tests and ``bench.py``; library functions take any session.
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system folder and is read,
    never overridden.  Only a ``local`` session that leaves it unset gets one
    under the system temp folder; on a cluster that folder would be another on
    each machine, so there an unset setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="shelfcast-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh folder path under the shared checkpoint folder.

    Intermediate tables (landing files, bronze/silver/gold outputs written by
    the query catalog) live here so every executor can read them and lineage
    can be cut by reading a written table back.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    name = "-".join(p.strip("/").replace("/", "_") for p in parts if p)
    return f"{base}/shelfcast/{name}-{uuid.uuid4().hex[:12]}"


#: Rows that one task sorts for windows or writes, when a shuffle is dealt by size.
TASK_ROWS = 500_000


def partitions_for(spark: SparkSession, rows: int) -> int:
    """Partitions for a shuffle of ``rows``: the session's number, and more of
    them where a partition would hold more than ``TASK_ROWS``."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))


__all__ = [
    "DEFAULT_CONF",
    "build_session",
    "ensure_checkpoint_dir",
    "partitions_for",
    "scratch_path",
]
