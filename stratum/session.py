"""Session helpers.

Library code never changes global session state except for one thing: when
the cluster names no checkpoint folder (``spark.checkpoint.dir``), a folder
under the session's warehouse directory is chosen so that staging tables and
stream checkpoints have a shared home. On a real cluster the setting is read
as given; the fallback is for local tests and the verification driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_TEST_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def local_session(
    app_name: str = "stratum",
    master: str = "local[8]",
    checkpoint_dir: str | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests and benchmarks (a cluster job receives its own)."""
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in {**_TEST_CONF, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # a configured spark.checkpoint.dir wins; ours is only the fallback
    sc = spark.sparkContext
    if checkpoint_dir and not sc.getConf().get("spark.checkpoint.dir", None) and not sc.getCheckpointDir():
        sc.setCheckpointDir(checkpoint_dir)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables.

    Reads ``spark.checkpoint.dir`` (or a folder already set on the context). Only in local mode, where one machine
    holds everything, does it pick one under the warehouse directory when neither is set;
    on a cluster that would be another folder on each machine, so it raises.
    """
    sc = spark.sparkContext
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        # getCheckpointDir() returns <root>/<application uuid>
        return current.rstrip("/").rsplit("/", 1)[0]
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    root = f"{warehouse}/_checkpoints"
    sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/stratum/{purpose}-{uuid.uuid4().hex[:12]}"
