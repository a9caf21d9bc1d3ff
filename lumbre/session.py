"""Session defaults shared by the bench, the tests and the command line."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session: UTC clock, AQE on, no UI."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lumbre")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster whose executors do not share that folder, ship it with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    own = spark.sparkContext.environment
    paths = own.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        own["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
