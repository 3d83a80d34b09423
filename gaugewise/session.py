"""Session settings for local runs; on a cluster the platform's session is used as it is."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(
    app_name: str = "gaugewise", cpus: int | str = "*", shuffle_partitions: int = 8, extra: dict[str, str] | None = None
) -> SparkSession:
    """A `local[cpus]` session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("GAUGEWISE_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
