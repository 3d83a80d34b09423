"""What exists: stations, variables, periods, and the combinations that are missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugewise.fixed_values import COUNT_VARIABLE, FLOW_PANEL, NOT_A_FLUX, UNAVAILABLE
from gaugewise.operators.lookups import join_same
from gaugewise.operators.pairing import with_every

STATION = "station_name"


def stations(obs: DataFrame, station: str = STATION) -> DataFrame:
    return obs.where(F.col(station).isNotNull()).select(station).distinct()


def stations_with_flow(obs: DataFrame, flow: DataFrame, station: str = STATION) -> DataFrame:
    """Stations that have both samples and flow rows."""
    return stations(flow, station).join(stations(obs, station), station, "left_semi")


def variables(obs: DataFrame, only_concentrations: bool = False, count_variable: str = COUNT_VARIABLE) -> DataFrame:
    """Variable names; optionally those measured per litre, or counted."""
    if only_concentrations:
        obs = obs.where((F.col("variable_name") == count_variable) | F.col("unit_code").like("%g/L"))
    return obs.select("variable_name").distinct()


def sampled_units(obs: DataFrame, excluded_unit: str | None = None) -> DataFrame:
    pairs = obs.select("variable_name", "unit_code").distinct()
    return pairs if excluded_unit is None else pairs.where(F.col("unit_code") != excluded_unit)


def period(obs: DataFrame, date: str = "sample_date") -> DataFrame:
    """First and last date of the whole table, and their years."""
    low, high = F.min(date), F.max(date)
    return obs.agg(
        F.year(low).alias("min_year"), F.year(high).alias("max_year"), low.alias("min_date"), high.alias("max_date")
    )


def flow_series(flow: DataFrame, station: str | None = None) -> DataFrame:
    """Distinct (date, flow) per station, or of one station."""
    if station is not None:
        flow = flow.where(F.col(STATION) == station)
    return flow.select(STATION, F.col("date").alias("sample_date"), F.col("value").alias("daily_flow_cms")).distinct()


def with_each(df: DataFrame, names: DataFrame, name: str) -> DataFrame:
    """Every row of `df` with every name that is not missing."""
    return with_every(df, names.where(F.col(name).isNotNull()).select(name).distinct())


def task_grid(obs: DataFrame, station: str = STATION) -> DataFrame:
    """All stations with all variables, sampled or not."""
    return with_each(stations(obs, station), variables(obs), "variable_name")


def combination_counts(obs: DataFrame, station: str = "station") -> DataFrame:
    """Samples per (station, variable) over all combinations of observed names; NULL where there is none."""
    counted = obs.groupBy(station, "variable_name").agg(F.count(F.lit(1)).alias("n"))
    grid = with_each(counted.select(station).distinct(), counted, "variable_name")
    return join_same(grid, counted, [station, "variable_name"])


def expected_panels(panels: Sequence[str]) -> Column:
    """(rank, title) of the expected panels, one row each."""
    return F.posexplode(F.array(*[F.lit(p) for p in panels]))


def missing_panels(
    present: DataFrame,
    flow: DataFrame,
    panels: Sequence[str],
    non_flux: Sequence[str] = (),
    flow_panel: str = FLOW_PANEL,
    station: str = STATION,
) -> DataFrame:
    """Expected panels a station has no data for, with the text to show there.

    `present` holds (station, facet_title); the flow panel is missing when the station has no observed flow.
    """
    usable = flow.where("daily_flow_cms is not null").select(station, F.lit(flow_panel).alias("facet_title"))
    titles = present.where(F.col("facet_title") != flow_panel).select(station, "facet_title")
    have = titles.unionByName(usable).distinct()
    grid = present.select(station).distinct().select(station, expected_panels(panels).alias("facet_rank", "facet_title"))
    text = F.when(F.col("facet_title").isin(list(non_flux)), F.lit(NOT_A_FLUX)).otherwise(F.lit(UNAVAILABLE))
    return join_same(grid, have, [station, "facet_title"], "left_anti").withColumn("text", text)
