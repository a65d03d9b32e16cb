"""Session construction and the shared checkpoint folder.

The library never picks a machine-local folder on a cluster: the
checkpoint folder is read from ``spark.checkpoint.dir``.  Only when that
setting is absent *and* the master is local (tests, laptops) do we fall
back to a fresh scratch folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on.  Time zone: the supplied timestamps are
# zone-less (timestamp_ntz); pinning UTC keeps any cast through TIMESTAMP exact.
_REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(
    master: str | None = None,
    app_name: str = "valuescope",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _REQUIRED_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    Reads ``spark.checkpoint.dir``; sets a scratch folder only when the
    setting is unset and the session runs in local mode.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a shared (cluster-visible) folder is required"
            )
        configured = tempfile.mkdtemp(prefix="valuescope-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def let_workers_import(spark: SparkSession) -> None:
    """Python workers find this package where the driver does, whatever folder the session was started in."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in (paths := env.get("PYTHONPATH", "").split(os.pathsep)):
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
