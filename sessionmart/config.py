"""Session settings and the shared working folder.

The pipeline relies on three session properties:

* ``spark.sql.session.timeZone=UTC`` -- bar timestamps are UTC instants; the
  New York conversion is explicit (``functions.to_et``) and must not depend on
  the JVM zone.
* ANSI mode on (the 4.x default) -- bad casts fail loudly instead of becoming NULL.
* AQE on -- runtime coalescing of shuffle partitions, size-checked broadcast
  conversion of joins, and skew-join splitting.

Lineage is cut with reliable ``checkpoint()`` into the folder named by
``spark.checkpoint.dir`` (a shared filesystem on a cluster). The folder is read
from the session; a private folder is only created when none is configured
(local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "sessionmart", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the pipeline assumes.

    The master and the number of shuffle partitions are the submitter's unless given here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_session_conf(spark)
    return spark


def sizing(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20,
           broadcast_bytes: int = 64 << 20) -> dict[str, str]:
    """Partition settings for a given input size and cluster width.

    * file splits of ``target_partition_bytes`` (fewer, larger scan tasks at
      100 TB: ~400k splits of 256 MB instead of ~800k of 128 MB);
    * initial shuffle partitions so a partition holds about one split's worth
      of data, never fewer than 2x the cores; AQE then coalesces small ones
      toward the same advisory size and splits skewed ones;
    * a broadcast threshold that AQE applies to *measured* shuffle sizes.
    """
    shuffle = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(target_partition_bytes // 16),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def apply_session_conf(spark: SparkSession) -> None:
    """Set what results depend on (zone, ANSI casts) and adaptive execution on the caller's session.

    This changes the given session; nothing else of it is touched.
    """
    for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled"):
        if spark.conf.get(k, None) != SESSION_CONF[k]:
            spark.conf.set(k, SESSION_CONF[k])


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared working folder (``spark.checkpoint.dir``).

    Read from the session. Only when nothing is configured (local runs, tests)
    a private folder is created and registered, so later calls agree.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- a remote (Connect) session has no context
        sc = None
    path = spark.conf.get(CHECKPOINT_CONF, None) or (sc.getCheckpointDir() if sc else None)
    if not path:
        master = sc.master if sc else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder on shared storage; "
                               "a machine-local folder does not survive executor loss")
        path = tempfile.mkdtemp(prefix="sessionmart-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared folder for one written table."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
