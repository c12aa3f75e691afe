"""Session builder with the settings the operators rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def session(master: str | None = None, partitions: int | None = None, **conf: str) -> SparkSession:
    """UTC, ANSI, adaptive execution. On a cluster leave master and partitions to spark-submit."""
    builder = SparkSession.builder.appName("fieldlens")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    if master:
        builder = builder.master(master)
        settings.setdefault("spark.driver.memory", os.environ.get("FIELDLENS_DRIVER_MEMORY", "8g"))
        settings.setdefault("spark.ui.enabled", "false")
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see, by spark.checkpoint.dir. A local master that names none gets a temporary one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="fieldlens-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path
