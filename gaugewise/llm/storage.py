"""Tables written to the folder that the cluster shares, to cut lineage and to survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; on a local master without one, a fresh folder, which is then set.

    Raises on a cluster that names no shared folder: a machine-local one would not be seen by its executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="llm-tables-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once as Parquet in the shared folder and read it back.

    The files stay as long as the returned frame may be read; the cluster's retention for the folder removes them.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
