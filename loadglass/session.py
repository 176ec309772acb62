"""Session settings and the shared scratch folder."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution picks the final number of shuffle partitions, splits skewed
# ones and may turn a join into a broadcast once it has seen the real size.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Shuffled rows per task and, for rebalanced writes, per file. Logs compress well.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
}

# Local runs only; a cluster sets its own.
LOCAL_SETTINGS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

LOCAL_SCRATCH = os.path.join(tempfile.gettempdir(), "loadglass-scratch")


def session(
    name: str = "loadglass",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """A session with our settings; ``master`` is for local runs."""
    builder = SparkSession.builder.appName(name)
    chosen = dict(SETTINGS)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            chosen.update(LOCAL_SETTINGS)
    chosen.update(settings or {})
    for key, value in chosen.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the one the cluster shares in ``spark.checkpoint.dir``.

    Without that setting only a local session has a folder of its own, ``LOCAL_SCRATCH``:
    executors of a cluster could not see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = LOCAL_SCRATCH
    return f"{shared.rstrip('/')}/loadglass/{purpose}-{uuid.uuid4().hex}"
