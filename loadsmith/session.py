"""Session helpers.

Library code never creates a session; it takes the caller's.  ``local_session``
exists for tests and the bench only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every load plan relies on.  Applied by ``local_session``; on a
# cluster put them in the job's own configuration.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys (one key holding a large share of rows, or many null
    # lookup keys) are split into several tasks at runtime.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Catalyst broadcasts a side whose files hold at most this much (Parquet expands in
    # memory, so the bound is low); AQE one whose measured shuffle output does.
    "spark.sql.autoBroadcastJoinThreshold": "4m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    # AQE splits skewed partitions of REBALANCE (bucketed writes).
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # A fused stage with dozens of CASE chains compiles to one method bigger
    # than the JVM will JIT (8000 bytes); such a stage then runs interpreted
    # and is ~4x slower.  Above this size Spark keeps per-operator codegen.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "loadsmith", extra_conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**RECOMMENDED_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("LOADSMITH_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the job (a shared file system path); an
    unset value is an error there.  Only in local mode (tests) is a scratch
    folder created when it is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(materialized batches and key sets are written there)")
        configured = tempfile.mkdtemp(prefix="loadsmith-ckpt-")   # local mode only
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()
