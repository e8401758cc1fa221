"""Session construction and the shared scratch location.

Settings every job relies on:

* ``spark.sql.session.timeZone=UTC`` — dates and timestamps compare the same way on every executor.
* ``spark.sql.caseSensitive=false`` — column names are matched case-insensitively.
* AQE on, with partition coalescing and skew-join splitting, so shuffle partition counts sized for the
  largest input do not hurt small inputs, and a hot key is split at run time.

Scratch output (round trips, derived tables, lineage cuts) goes under the shared folder the cluster
names in ``spark.checkpoint.dir``. Only where the session has none and its master is local is a
folder of this machine set, once per session, and removed when the process ends.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings for a local session (tests, bench). On a cluster, pass ``cluster_conf()`` instead.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
    "spark.driver.memory": "8g",
}


PARTITION_BYTES = 1 << 30
MAX_PARTITIONS = 50_000


def cluster_conf(total_cores: int, largest_shuffle_bytes: int = 0) -> dict[str, str]:
    """Settings for a large cluster reading tens of terabytes.

    Scans split files into 1 GB partitions, so that 100 TB are about 100,000 scan tasks. The initial
    shuffle partition count covers the largest shuffle expected at about 1 GB per partition, at least
    3 per core and at most 50,000: the blocks of a shuffle are scan tasks times partitions, and the
    driver keeps a size for each. A shuffle of 100 TB then has 2 GB per partition, which sorts
    and spills within a few GB of executor memory per core. AQE coalesces small shuffles toward 256 MB
    and splits skewed partitions. Example: 8,000 cores and 20 TB give 24,000 initial partitions.
    """
    wanted = max(200, 3 * total_cores, -(-largest_shuffle_bytes // PARTITION_BYTES))
    return {
        "spark.sql.autoBroadcastJoinThreshold": str(32 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.caseSensitive": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(min(MAX_PARTITIONS, wanted)),
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
    }


def build_session(master: str = "local[8]", app: str = "boreal",
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**LOCAL_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def submitted_session(app: str) -> SparkSession:
    """The session the program was submitted with; only what jobs rely on and nobody set is added."""
    spark = SparkSession.builder.appName(app).getOrCreate()
    submitted = spark.sparkContext.getConf()
    for key in ("spark.sql.session.timeZone", "spark.sql.caseSensitive"):
        if not submitted.contains(key):
            spark.conf.set(key, LOCAL_CONF[key])
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; where it is unset, a temporary one if the
    master is local, and an error on a cluster, whose executors would not see it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    root = root or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="boreal-ckpt-")
        atexit.register(shutil.rmtree, root, True)
        spark.conf.set("spark.checkpoint.dir", root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), "boreal", f"{name}-{uuid.uuid4().hex}")
