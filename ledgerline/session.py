"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every plan relies on. Parallelism is left to the cluster.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the split costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_local_scratch: str | None = None


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to a session somebody else built."""
    for key, value in SQL_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerline")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SQL_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    Only a local master without ``spark.checkpoint.dir`` (a test) gets a temporary folder of this
    machine, removed at exit. On a cluster the executors would not see one, so that is an error.
    """
    global _local_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master or 'the cluster'} share")
        if _local_scratch is None:
            _local_scratch = tempfile.mkdtemp(prefix="ledgerline-")
            atexit.register(shutil.rmtree, _local_scratch, ignore_errors=True)
        base = _local_scratch
    return f"{base.rstrip('/')}/ledgerline/{name}-{uuid.uuid4().hex[:12]}"
