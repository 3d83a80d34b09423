"""Reading: delimited text with explicit schemas, flow archives with pushed-down filters, parametrised SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugewise.functions.text import snake_case

# Texts that mean "no value" besides the empty field.
NULL_TEXT = "NA"


def read_delimited(spark: SparkSession, path: str, schema: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Delimited text with a header; without a schema every column is text (no inference pass).

    Empty fields and `NA` are NULL. A schema is matched by position, so it also renames.
    """
    reader = spark.read.option("header", True).option("nullValue", NULL_TEXT).option("multiLine", False)
    df = (reader.schema(schema) if schema else reader).csv(path)
    return df.select(*columns) if columns else df


def with_position(df: DataFrame) -> DataFrame:
    """Where each row stands in its input, as columns that sort in file order: file, split, row in the split.

    Take it from a frame straight out of a reader, before any shuffle: a task reads the rows of a split in the
    order of the file, and running numbers grow along a task.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def clean_names(df: DataFrame) -> DataFrame:
    """Headers in snake_case; repeated names get a number."""
    seen: dict[str, int] = {}
    names = []
    for header in df.columns:
        name = snake_case(header)
        seen[name] = seen.get(name, 0) + 1
        names.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return df.toDF(*names)


def read_daily_flow(
    spark: SparkSession, path: str, stations: Sequence[str], first_date: str, last_date: str, parameter: str = "Flow"
) -> DataFrame:
    """Daily flow (date, station_number, value) of the listed stations and dates, filtered in the scan."""
    return (
        spark.read.parquet(path)
        .where(
            F.col("station_number").isin(list(stations))
            & F.col("date").between(F.lit(first_date).cast("date"), F.lit(last_date).cast("date"))
            & (F.col("parameter") == parameter)
        )
        .select("date", "station_number", "value")
    )


def read_flow_stations(spark: SparkSession, path: str, stations: Sequence[str]) -> DataFrame:
    return (
        spark.read.parquet(path)
        .where(F.col("station_number").isin(list(stations)))
        .select("station_number", "station_name", "drainage_area_gross")
    )


def run_query(spark: SparkSession, text: str, parameters: Sequence = ()) -> DataFrame:
    """SQL with positional `?` markers."""
    return spark.sql(text, args=list(parameters)) if parameters else spark.sql(text)
