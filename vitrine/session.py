"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("vitrine")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: executors of a
    cluster do not share one machine's disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="vitrine-")
        spark.conf.set("spark.checkpoint.dir", base) if spark.conf.isModifiable(
            "spark.checkpoint.dir"
        ) else None
    return f"{base.rstrip('/')}/vitrine/{purpose}-{uuid.uuid4().hex}"
