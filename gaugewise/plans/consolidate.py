"""From agency files to the finished observation and flow tables, as one lazy plan per table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugewise import fixed_values as fixed
from gaugewise.functions import calendar
from gaugewise.functions.rules import recode
from gaugewise.functions.text import to_number
from gaugewise.operators import components, conform
from gaugewise.operators.censoring import flag_censored, substitute_limits
from gaugewise.operators.linkage import flow_with_station, obs_with_flow, obs_with_station
from gaugewise.schema import OBSERVATION_COLUMNS


@dataclass(frozen=True)
class AgencyTables:
    """Raw agency tables, with the columns of `gaugewise.schema`."""

    city: DataFrame
    provincial: DataFrame
    provincial_supplement: DataFrame
    federal: DataFrame
    provincial_supplied: DataFrame


def with_total_nitrogen(city: DataFrame) -> DataFrame:
    """City samples, their times parsed, with the derived total of the later years appended."""
    timed = city.withColumn("sample_date", calendar.parse_time("sample_date", fixed.CITY_TIME))
    later = timed.where(F.year("sample_date") > fixed.TOTAL_AFTER_YEAR)
    ids = ["sample_site", "sample_date", "result_units"]
    derived = components.component_total(later, ids, fixed.TOTAL_COMPONENTS, fixed.TOTAL_NAME)
    return components.append_new_rows(timed, derived)


def city_observations(city: DataFrame) -> DataFrame:
    df = conform.with_reach(with_total_nitrogen(city), "sample_site", fixed.CITY_REACHES)
    renames = {
        "sample_site": "station",
        "parameter": "variable_name",
        "numeric_result": "measurement_value",
        "result_qualifier": "measurement_flag",
        "result_units": "unit_code",
    }
    df = conform.recode_variables(conform.conform(df, renames, "City of Calgary"), fixed.CITY_VARIABLES)
    df = df.withColumn("sample_datetime", F.col("sample_date")).withColumn("sample_date", F.to_date("sample_date"))
    return _listed(df, fixed.CITY_STATIONS)


def provincial_observations(first: DataFrame, second: DataFrame) -> DataFrame:
    parsed = [
        df.withColumn("sample_date_time", calendar.parse_date("sample_date_time", pattern))
        for df, pattern in ((first, fixed.PROVINCIAL_TIME), (second, fixed.PROVINCIAL_SUPPLEMENT_TIME))
    ]
    df = conform.with_reach(conform.union_all(*parsed), "station", fixed.PROVINCIAL_REACHES)
    df = conform.conform(df, {"sample_date_time": "sample_date"}, "Alberta Environment and Protected Areas")
    return _listed(conform.recode_variables(df, fixed.PROVINCIAL_VARIABLES), fixed.PROVINCIAL_STATIONS)


def federal_observations(federal: DataFrame) -> DataFrame:
    df = federal.withColumn("date_time", calendar.parse_date("date_time", fixed.FEDERAL_TIME))
    df = conform.with_reach(df, "site_no", fixed.FEDERAL_REACHES)
    df = df.withColumn("site_no", recode("site_no", fixed.FEDERAL_STATION_NAMES, F.lit(None).cast("string")))
    renames = {
        "site_no": "station",
        "date_time": "sample_date",
        "variable": "variable_name",
        "value": "measurement_value",
        "flag": "measurement_flag",
        "unit": "unit_code",
    }
    df = conform.exclude(conform.conform(df, renames, "Environment Canada"), "variable_name", fixed.FEDERAL_DROPPED_VARIABLE)
    return _listed(conform.recode_variables(df, fixed.FEDERAL_VARIABLES), tuple(fixed.FEDERAL_STATION_NAMES.values()))


def _listed(df: DataFrame, stations: tuple[str, ...]) -> DataFrame:
    return conform.keep_listed(conform.keep_listed(df, "station", stations), "variable_name", fixed.VARIABLES)


def supplied_observations(supplied: DataFrame) -> DataFrame:
    """Variables delivered later; they join after the period cut and keep their spelling of the reach."""
    df = supplied.where(F.col("VariableName").isin(list(fixed.SUPPLIED_VARIABLES))).withColumns(
        {
            "sample_datetime": calendar.parse_time("SampleDateTime", fixed.GAUGE_TIME),
            "SampleDate": F.to_date(F.col("SampleDate").try_cast("timestamp_ntz")),
            "MeasurementValue": to_number("MeasurementValue"),
        }
    )
    renames = {
        "Station": "station",
        "VariableName": "variable_name",
        "SampleDate": "sample_date",
        "MeasurementValue": "measurement_value",
        "MeasurementFlag": "measurement_flag",
        "UnitCode": "unit_code",
    }
    df = conform.with_reach(df.withColumnsRenamed(renames), "station", fixed.PROVINCIAL_REACHES)
    return df.withColumns(
        {
            "agency": F.lit(fixed.PROVINCIAL_AGENCY),
            "detection_limit": F.lit(None).cast("double"),
            "flow_cms": F.lit(None).cast("double"),
        }
    )


def consolidated_observations(tables: AgencyTables) -> DataFrame:
    """All agencies in one layout, the study period, and the supplied variables put in place."""
    numeric = [
        df.withColumn("measurement_value", to_number("measurement_value"))
        for df in (
            city_observations(tables.city),
            provincial_observations(tables.provincial, tables.provincial_supplement),
            federal_observations(tables.federal),
        )
    ]
    df = conform.upper_names(conform.standard_units(conform.union_all(*numeric)))
    df = conform.keep_years(df, "sample_date", fixed.FIRST_YEAR, fixed.LAST_YEAR)
    df = df.withColumn("sample_datetime", F.coalesce("sample_datetime", F.col("sample_date").cast("timestamp_ntz")))
    return conform.replace_variable(
        df, fixed.REPLACED_VARIABLE, fixed.PROVINCIAL_AGENCY, supplied_observations(tables.provincial_supplied)
    )


def finished_observations(
    tables: AgencyTables, limits: DataFrame, lookup: DataFrame, flow: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """The finished observation table and the flow table with station names.

    That every flow station has a sampling station is checked where the tables are written
    (`database.register_tables`), in the same pass; `linkage.require_matched` checks it on its own.
    """
    named_flow = flow_with_station(flow, lookup)
    censored = substitute_limits(flag_censored(consolidated_observations(tables)), limits)
    obs = obs_with_flow(obs_with_station(censored, lookup), named_flow)
    return obs.select(*OBSERVATION_COLUMNS), named_flow
