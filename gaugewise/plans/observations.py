"""The view of the finished observation table that every chart starts from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugewise.functions import calendar
from gaugewise.operators.censoring import detection_condition, effective_value


def observation_view(obs: DataFrame, station: str | None = None, variable: str | None = None) -> DataFrame:
    """Usable results of named stations with effective value, detection condition, year and water season.

    Restricted to one station and one variable only where they are given.
    """
    if station is not None:
        obs = obs.where(F.col("station_name") == station)
    if variable is not None:
        obs = obs.where(F.col("variable_name") == variable)
    return obs.select(
        "station_name",
        "variable_name",
        "sample_date",
        effective_value().alias("measurement_value"),
        detection_condition().alias("detection_condition"),
        F.year("sample_date").alias("year"),
        calendar.season("sample_date", "water").alias("season"),
        "daily_flow_cms",
        "unit_code",
    ).where("measurement_value is not null and station_name is not null")


def ordered(view: DataFrame) -> DataFrame:
    return view.orderBy("variable_name", "sample_date")
