"""Session helpers: building a session for tests/bench, checkpoint folder."""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "retailq",
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster, the cluster's own settings win."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "8g"))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; unset on a local master take a scratch one, elsewhere raise."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="retailq-ckpt-", dir=os.environ.get("RETAILQ_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(configured)
    return configured
