"""Catalog tables for later queries, with the known unit repairs applied on the way in."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugewise.fixed_values import UNIT_REPAIRS
from gaugewise.operators.conform import repair_units
from gaugewise.plans.gates import STAGED, Gate, matched_flow, publish
from gaugewise.sources.layout import clustered, repair_partitions


def register_tables(
    obs: DataFrame, flow: DataFrame, guidelines: DataFrame, prefix: str = "", gates: Mapping[str, Sequence[Gate]] | None = None
) -> None:
    """Replace the tables `consolidated_data`, `daily_flow` and `guideline` together, or none of them.

    Observations lie by year, sorted by station and variable; flow by station and date. While the tables are written
    their gates are counted (by default: every flow row has a sampling station); `gates` adds more by table name.
    """
    more = gates or {}
    frames = {
        "consolidated_data": clustered(repair_units(obs)),
        "daily_flow": flow.orderBy("station_name", "date"),
        "guideline": guidelines,
    }
    partitions = {"consolidated_data": ["year"]}
    checked = {f"{prefix}{name}": [*more.get(name, ()), *([matched_flow()] if name == "daily_flow" else [])] for name in frames}

    def write(df: DataFrame, staged: str, folder: str) -> None:
        name = staged.removeprefix(prefix).removesuffix(STAGED)
        df.write.mode("overwrite").partitionBy(*partitions.get(name, ())).option("path", folder).saveAsTable(staged)

    publish(obs.sparkSession, {f"{prefix}{name}": df for name, df in frames.items()}, checked, write)


def repair_stored_units(
    spark: SparkSession, name: str = "consolidated_data", rules: Sequence[tuple[str, str, str]] = UNIT_REPAIRS
) -> list:
    """Known unit repairs on a stored table: only the years that hold a wrong unit are read and rewritten."""
    wrong = F.lit(False)
    for variable, unit, _ in rules:
        wrong = wrong | ((F.col("variable_name") == variable) & (F.col("unit_code") == unit))
    return repair_partitions(spark, name, wrong, lambda df: repair_units(df, rules))
