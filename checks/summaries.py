"""Overviews, stations, variables and periods."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.roles import COUNT_VARIABLE, Roles
from gaugewise.operators import coverage, quality
from gaugewise.operators.flux import daily_flux
from gaugewise.operators.linkage import stations_with_usable_flow
from gaugewise.operators.summary import overview

VARIABLES = ("ECONOMY", "LARGE", "SMALL")


def overview_sql(source: str, keys: str, value: str, more: str = "") -> str:
    return f"""select {keys}, count(*) as count_samples, min(sample_date) as min_date, max(sample_date) as max_date,
      count({value}) as count_values, sum(cen_logic::int)::bigint as count_lflag,
      coalesce(array_to_string(list_sort(list(distinct measurement_value) filter (where cen_logic)), ','), '') as list_dls,
      count(distinct year(sample_date)) as count_years, count(*) as count_months,
      count(distinct date_trunc('month', sample_date)) as distinct_months, min({value}) as min,
      round(avg({value}), 6) as mean, max({value}) as max, round(stddev_samp({value}), 6) as st_dev,
      round(100.0 * sum(cen_logic::int) / nullif(count(measurement_value), 0), 6) as perc_bdl,
      round(quantile_cont({value}, 0.1), 6) as p10, round(quantile_cont({value}, 0.25), 6) as p25,
      round(quantile_cont({value}, 0.5), 6) as median, round(quantile_cont({value}, 0.75), 6) as p75,
      round(quantile_cont({value}, 0.9), 6) as p90 {more} from {source} group by all"""


SUBSTITUTED = """, case when count(measurement_flag2) = count(*) then sum(measurement_flag2::int)::bigint end as count_lflag2,
  round(100.0 * case when count(measurement_flag2) = count(*) then sum(measurement_flag2::int) end
    / nullif(count(measurement_max_dl_sub), 0), 6) as perc_bdl2"""
FLOW = """, round(avg(daily_flow_cms), 6) as mean_flow, round(median(daily_flow_cms), 6) as median_flow"""
SUB = "measurement_max_dl_sub"


@query(
    "overview_agency_variable",
    overview_sql("obs", "agency, variable_name", "measurement_value", ", count(distinct station) as count_stns"),
)
def _(r: Roles):
    return overview(r.observations(), ["agency", "variable_name"], stations=True)


@query("overview_substituted", overview_sql("sub", "agency, variable_name", SUB, SUBSTITUTED))
def _(r: Roles):
    return overview(r.substituted(), ["agency", "variable_name"], SUB, substituted=True)


@query(
    "overview_station_variable",
    overview_sql("fin", "station, station_name, variable_name", SUB, SUBSTITUTED + FLOW),
)
def _(r: Roles):
    return overview(r.finished(), ["station", "station_name", "variable_name"], SUB, substituted=True, flow=True)


@query("overview_annual", overview_sql("fin", "station, station_name, variable_name, year", SUB, SUBSTITUTED + FLOW))
def _(r: Roles):
    keys = ["station", "station_name", "variable_name", "year"]
    return overview(r.finished(), keys, SUB, substituted=True, flow=True)


@query(
    "overview_annual_flux",
    overview_sql(
        """(select *, case when variable_name = 'ECONOMY' then measurement_max_dl_sub * 0.01 * (daily_flow_cms * 86400)
             when variable_name in ('LARGE', 'SMALL') then measurement_max_dl_sub * 0.001 * (daily_flow_cms * 86400) end as flux
           from fin)""",
        "station, variable_name, year", SUB,
        SUBSTITUTED + FLOW + ", round(case when count(flux) = count(*) then sum(flux) end, 3) as sum_flux",
    ),
)
def _(r: Roles):
    df = daily_flux(r.finished(), VARIABLES, count_variable=COUNT_VARIABLE)
    out = overview(df, ["station", "variable_name", "year"], SUB, substituted=True, flow=True, flux="flux")
    return out.withColumn("sum_flux", F.round("sum_flux", 3))


@query("stations", "select distinct station_name from fin where station_name is not null")
def _(r: Roles):
    return coverage.stations(r.finished())


@query(
    "stations_with_flow",
    "select distinct f.station_name from named_flow f join fin on f.station_name = fin.station_name",
)
def _(r: Roles):
    return coverage.stations_with_flow(r.finished(), r.named_flow())


@query(
    "stations_with_usable_flow",
    "select station_name, count(daily_flow_cms) as n_flow from fin group by 1 having count(daily_flow_cms) > 0",
)
def _(r: Roles):
    return stations_with_usable_flow(r.finished())


@query(
    "concentration_variables",
    "select distinct variable_name from obs where variable_name = 'ECONOMY' or unit_code like '%g/L'",
)
def _(r: Roles):
    return coverage.variables(r.observations(), only_concentrations=True, count_variable=COUNT_VARIABLE)


@query("sampled_units", "select distinct variable_name, raw_unit as unit_code from raw where raw_unit <> 'PH'")
def _(r: Roles):
    return coverage.sampled_units(r.raw_observations().withColumn("unit_code", F.col("raw_unit")), "PH")


@query(
    "unit_check",
    """select variable_name, count(distinct raw_unit) as n_units, string_agg(distinct raw_unit, ', ' order by raw_unit) as units,
      false as has_missing_unit from raw group by all""",
)
def _(r: Roles):
    return quality.unit_report(r.raw_observations().withColumn("unit_code", F.col("raw_unit")))


@query(
    "min_max_year",
    """select year(min(sample_date)) as min_year, year(max(sample_date)) as max_year, min(sample_date) as min_date,
      max(sample_date) as max_date from obs""",
)
def _(r: Roles):
    return coverage.period(r.observations())


@query(
    "flow_series",
    """select distinct station_name, date as sample_date, value as daily_flow_cms from named_flow
      where station_name = 'Site u/s NATION_3'""",
)
def _(r: Roles):
    return coverage.flow_series(r.named_flow(), "Site u/s NATION_3")
