"""Writing: tables, delimited text, and chart rows laid out by station and variable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_table(df: DataFrame, name: str) -> None:
    """Replace a catalog table."""
    df.write.mode("overwrite").saveAsTable(name)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def flatten_lists(df: DataFrame, separator: str = ",") -> DataFrame:
    """List columns as joined text, for formats without lists."""
    lists = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    return df.withColumns({c: F.array_join(F.col(c).cast("array<string>"), separator) for c in lists})


def write_delimited(df: DataFrame, path: str) -> None:
    """Delimited text with a header; NULL is written as an empty field, lists as joined text."""
    flatten_lists(df).write.mode("overwrite").option("header", True).csv(path)


def write_chart_rows(df: DataFrame, path: str, keys: Sequence[str] = ("station_name", "variable_name")) -> None:
    """One folder per key combination; rebalancing keeps files even when one combination is much larger."""
    df.hint("rebalance", *keys).write.mode("overwrite").partitionBy(*keys).parquet(path)
