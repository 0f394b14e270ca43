"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", app: str = "tallygrove") -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Plans have thousands of expressions; recording a call site for each is slow.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _one_process(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    Where that setting is missing, a local temporary folder takes its place if
    driver and executors are one process; on a cluster it is an error.
    """
    settings = spark.sparkContext.getConf()
    base = spark.conf.get("spark.checkpoint.dir", None) or settings.get("spark.checkpoint.dir")
    if not base:
        if not _one_process(settings.get("spark.master", "")):
            raise ValueError(
                "set spark.checkpoint.dir to a folder that the driver and all executors reach"
            )
        base = tempfile.mkdtemp(prefix="tallygrove-")
    return f"{base.rstrip('/')}/tallygrove/{name}-{uuid.uuid4().hex}"
