"""Link observations to flow stations and to the flow of the same day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugewise.functions import calendar
from gaugewise.operators.lookups import join_same

LOOKUP_COLUMNS = ("station_name_wq", "flow_station_number", "flow_station_name", "station_name")
FLOW_KEYS = {
    "flow_station_number": "flow_station_number",
    "flow_station_name": "flow_station_name",
    "sample_date": "date",
    "station_name": "station_name",
}


def flow_with_station(flow: DataFrame, lookup: DataFrame) -> DataFrame:
    """Station names on the flow series; flow without a lookup entry stays."""
    return join_same(flow, lookup.select(*LOOKUP_COLUMNS), ["flow_station_number"])


def unmatched_flow_stations(flow_named: DataFrame) -> DataFrame:
    """Flow stations that no sampling station stands for."""
    return flow_named.where("station_name_wq is null").select("flow_station_number").distinct()


def require_matched(flow_named: DataFrame) -> DataFrame:
    """The same table, after checking that every flow station has a sampling station.

    The error gives their exact number and the first by name; `unmatched_flow_stations` is the whole list.
    """
    missing = unmatched_flow_stations(flow_named).agg(F.count(F.lit(1)).alias("n"), F.min("flow_station_number").alias("first")).first()
    if missing["n"]:
        raise ValueError(f"{missing['n']} flow station(s) without a sampling station, the first is {missing['first']}")
    return flow_named


def obs_with_station(obs: DataFrame, lookup: DataFrame) -> DataFrame:
    """Flow station and report name on observations; stations without an entry stay."""
    return join_same(obs, lookup.select(*LOOKUP_COLUMNS), {"station": "station_name_wq"})


def obs_with_flow(obs: DataFrame, flow_named: DataFrame) -> DataFrame:
    """Same-day flow on observations, and the calendar columns of the finished table.

    Dates must be equal, NULL keys match NULL keys. Both sides are large: the join is shuffled on station
    and date, and a hot station-day on the observation side is split by adaptive execution.
    """
    flow = flow_named.select(
        *dict.fromkeys(FLOW_KEYS.values()), "station_name_wq", F.col("value").alias("daily_flow_cms")
    )
    return join_same(obs, flow, FLOW_KEYS).withColumns(
        {
            "year": F.year("sample_date"),
            "month_year": calendar.month_start("sample_date"),
            "season": calendar.season("sample_date", "ice"),
            "month_abb": calendar.month_label("sample_date"),
        }
    )


def missing_flow(obs: DataFrame) -> DataFrame:
    return obs.where("daily_flow_cms is null")


def missing_flow_by_month(obs: DataFrame, station: str = "station") -> DataFrame:
    """Per month and station the dates and variables of the samples without flow, each with its number of rows."""
    return missing_flow(obs).groupBy("month_year", station, "sample_date", "variable_name").agg(F.count(F.lit(1)).alias("n_rows"))


def missing_flow_by_year(obs: DataFrame, station: str = "station") -> DataFrame:
    """Per station and year the variables and months of the samples without flow, each with its number of rows."""
    return missing_flow(obs).groupBy(station, "year", "variable_name", "month_abb").agg(F.count(F.lit(1)).alias("n_rows"))


def stations_with_usable_flow(obs: DataFrame, station: str = "station_name") -> DataFrame:
    """Stations with at least one observed same-day flow, and how many."""
    return obs.groupBy(station).agg(F.count("daily_flow_cms").alias("n_flow")).where("n_flow > 0")
