"""How stored tables lie on disk: partitions and row groups that a station query skips, buckets that join in place."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CLUSTER = ("station_name", "variable_name")
BUCKETS = 64
JOIN_KEY = "join_key"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def clustered(df: DataFrame, partition: str = "year", cluster: Sequence[str] = CLUSTER) -> DataFrame:
    """Rows dealt by ranges of (partition, cluster) and sorted in them.

    A year has as few files as its size needs, a large one is split between stations, and the value ranges of
    files and row groups do not overlap. One station is read from one stretch of each year, one variable after
    another.
    """
    return df.repartitionByRange(partition, *cluster).sortWithinPartitions(partition, *cluster)


def write_clustered(
    df: DataFrame, name: str, partition: str = "year", cluster: Sequence[str] = CLUSTER, row_group_bytes: int | None = None
) -> None:
    """Replace a catalog table partitioned by `partition`, its files as `clustered` deals them."""
    writer = clustered(df, partition, cluster).write.mode("overwrite").partitionBy(partition)
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.saveAsTable(name)


def table_folder(spark: SparkSession, name: str) -> str | None:
    """Where a catalog table lies, or None without such a table."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"describe table extended {name}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a table's folder from whatever file system it is on; a missing one is no error."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def repair_partitions(
    spark: SparkSession, name: str, condition: Column, repair: Callable[[DataFrame], DataFrame],
    partition: str = "year", cluster: Sequence[str] = CLUSTER,
) -> list:
    """Apply `repair` to the partitions of a stored table that hold a row with `condition`, and rewrite only those.

    The rows to repair are looked up first, from the columns of `condition` alone; the list is one value for a
    partition. The rewrite replaces partitions one by one as the job commits; it may be repeated after a failure.
    `repair` must not move rows between partitions. Returns the partitions rewritten.
    """
    stored = spark.table(name)
    affected = sorted((r[0] for r in stored.where(condition).select(partition).distinct().collect()), key=lambda v: (v is None, v))
    if not affected:
        return []
    known = [v for v in affected if v is not None]
    chosen = F.col(partition).isin(known) if known else F.lit(False)
    if len(known) < len(affected):
        chosen = chosen | F.col(partition).isNull()
    rows = clustered(repair(stored.where(chosen)), partition, cluster).select(*stored.columns)
    mode = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")  # new files first, old ones of the same partitions go at the commit
    try:
        rows.write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(OVERWRITE_MODE, mode)
    spark.catalog.refreshTable(name)
    return affected


def null_safe_key(*columns: str) -> Column:
    """One text for a list of key values: equal exactly where all are equal, missing ones included."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int = BUCKETS, key_names: Sequence[str] | None = None) -> None:
    """Replace a catalog table dealt into buckets by its key, sorted in them; tables alike join without a shuffle.

    `key_names` are the names under which the other table knows the keys. The key holds every join column, such as
    station and day, so the rows of a hot station are spread over all buckets.
    """
    named = list(zip(keys, key_names or keys, strict=True))
    keyed = df.withColumn(JOIN_KEY, F.to_json(F.struct(*[F.col(c).alias(n) for c, n in named]), {"ignoreNullFields": "false"}))
    dealt = keyed.repartition(buckets, JOIN_KEY)
    dealt.write.mode("overwrite").bucketBy(buckets, JOIN_KEY).sortBy(JOIN_KEY).saveAsTable(name)


def join_bucketed(spark: SparkSession, left: str, right: str, columns: Sequence[str], how: str = "left") -> DataFrame:
    """Rows of `left` with `columns` of `right`, both written by `write_bucketed` on the same keys."""
    other = spark.table(right).select(JOIN_KEY, *columns)
    return spark.table(left).join(other, JOIN_KEY, how).drop(JOIN_KEY)
