"""Flow derivations and statistics, links between samples and flow, missing days."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.roles import Roles, sql_list
from gaugewise.operators import flow as f
from gaugewise.operators import linkage

STATIONS = [f"N{i}" for i in range(25)]  # all there are
STATS = """min({d}) filter (where {v} is not null) as min_date, max({d}) filter (where {v} is not null) as max_date,
  count({v}) as count_flow, count(*) - count({v}) as count_na_flow, min({v}) as min, round(avg({v}), 6) as mean,
  max({v}) as max, round(stddev_samp({v}) / avg({v}), 6) as cv, round(quantile_cont({v}, 0.1), 6) as q10,
  round(median({v}), 6) as median, round(quantile_cont({v}, 0.9), 6) as q90""".format(d="date", v="value")
DERIVED = """date_diff('day', min_date, max_date) + 1 as total_days,
  round_even((date_diff('day', min_date, max_date) + 1 - count_flow) / (date_diff('day', min_date, max_date) + 1)::double * 100, 1)
    as perc_missing"""


@query(
    "flow_overall_stats",
    f"""select *, year(min_date) as min_yr, year(max_date) as max_yr, {DERIVED} from
      (select flow_station_number, {STATS} from flow group by all)""",
)
def _(r: Roles):
    return f.overall_statistics(r.flow())


@query(
    "flow_annual_stats",
    f"""select *, {DERIVED}, month(min_date) as mo_from, month(max_date) as mo_to,
      case when month(min_date) = 1 and month(max_date) = 12 then 'Continuous' else 'Seasonal' end as seasonal_flag from
      (select flow_station_number, year(date) as year, {STATS} from flow group by all)""",
)
def _(r: Roles):
    return f.annual_statistics(r.flow())


@query(
    "gauge_daily_mean",
    """select reading_time::date as date, round(avg(flow_cms), 6) as value, case when site = 'PC2A' then 'PC' else 'NC' end
        as flow_station_number, count(*) over () as n_days
      from gauge group by site, reading_time::date having count(flow_cms) = count(*)""",
)
def _(r: Roles):
    daily = f.gauge_station_codes(f.gauge_daily_mean(r.gauge_readings()))
    n = daily.agg(F.count(F.lit(1))).scalar()
    return daily.withColumn("n_days", n)


@query(
    "runoff_depth",
    """select date, flow_station_number as station_number, value, n_name as station_name,
      round(value / (1000.7 + n_nationkey)::double * 86400 / 1e6 * 1e3, 6) as runoff_mm_d
      from flow left join nation on flow_station_number = 'N' || n_nationkey""",
)
def _(r: Roles):
    stations = r.table("nation").selectExpr(
        "concat('N', n_nationkey) as station_number", "n_name as station_name",
        "1000.7D + n_nationkey as drainage_area_gross",
    )
    flow = r.flow().withColumnRenamed("flow_station_number", "station_number")
    return f.with_runoff(f.with_station_details(flow, stations)).drop("drainage_area_gross")


SYNTHETIC = """select date, 'SYN' as flow_station_number, max(case when flow_station_number = 'N3' then value end)
  - max(case when flow_station_number = 'N7' then value end) as value from flow
  where flow_station_number in ('N3', 'N7') group by date"""


@query("synthetic_station", f"select date, flow_station_number, round(value, 6) as value from ({SYNTHETIC})")
def _(r: Roles):
    return f.synthetic_station(r.flow(), "SYN", "N3", "N7")


@query(
    "flow_nonnegative",
    f"select date, flow_station_number, round(case when value >= 0 then value end, 6) as value from ({SYNTHETIC})",
)
def _(r: Roles):
    return f.nonnegative(f.synthetic_station(r.flow(), "SYN", "N3", "N7"))


@query(
    "flow_wide",
    "select date, "
    + ", ".join(f'max(case when flow_station_number = \'{s}\' then value end) as "{s}"' for s in STATIONS)
    + f" from flow where flow_station_number in ({sql_list(STATIONS)}) group by date",
)
def _(r: Roles):
    return f.flow_wide(r.flow().where(F.col("flow_station_number").isin(STATIONS)), STATIONS)


FIRST, MORE = STATIONS[:12], STATIONS[12:]


def _wide_sql(stations: list[str], prefix: str = "") -> str:
    columns = ", ".join(f'max(case when flow_station_number = \'{s}\' then value end) as "{prefix}{s}"' for s in stations)
    return f"(select date, {columns} from flow where flow_station_number in ({sql_list(stations)}) group by date)"


@query(
    "flow_wide_joined",
    f"""select w.*, e.* exclude (date) from {_wide_sql(FIRST)} w left join {_wide_sql(MORE, 'E_')} e on w.date = e.date""",
)
def _(r: Roles):
    wide = f.flow_wide(r.flow().where(F.col("flow_station_number").isin(FIRST)), FIRST)
    more = f.flow_wide(r.flow().where(F.col("flow_station_number").isin(MORE)), MORE)
    return f.add_station_columns(wide, more.withColumnsRenamed({s: f"E_{s}" for s in MORE}))


GRID_SQL = f"""select d.date, s.flow_station_number, v.value from
  (select distinct date from flow where flow_station_number in ({sql_list(STATIONS)})) d
  cross join (select unnest([{sql_list(STATIONS)}]) as flow_station_number) s
  left join flow v on v.date = d.date and v.flow_station_number = s.flow_station_number"""


@query("flow_long_grid", GRID_SQL)
def _(r: Roles):
    wide = f.flow_wide(r.flow().where(F.col("flow_station_number").isin(STATIONS)), STATIONS)
    return f.flow_long(wide, STATIONS)


@query("flow_grid", GRID_SQL)
def _(r: Roles):
    return f.flow_grid(r.flow(), STATIONS)


@query(
    "flow_assembly",
    """select date, flow_station_number, round(value, 6) as value from (
      with arch as (select * from flow where flow_station_number in ('N3', 'N5')),
      dates as (select distinct date from arch),
      meas as (select * from arch union all select flow.* from flow join dates using (date) where flow_station_number = 'N7'),
      syn as (select date, max(case when flow_station_number = 'N3' then value end)
        - max(case when flow_station_number = 'N7' then value end) as value from meas
        where flow_station_number in ('N3', 'N7') group by date),
      allm as (select date, flow_station_number, value from meas union all select date, 'SYN', value from syn)
      select d.date, s.flow_station_number, v.value from dates d
        cross join (select unnest(['N3', 'N5', 'N7', 'SYN']) as flow_station_number) s
        left join allm v on v.date = d.date and v.flow_station_number = s.flow_station_number
      union all select date, 'BHC', value from flow where flow_station_number = 'N11' and value is not null
      union all select reading_time::date, case when site = 'PC2A' then 'PC' else 'NC' end, avg(flow_cms) from gauge
        group by site, reading_time::date having count(flow_cms) = count(*))""",
)
def _(r: Roles):
    flow = r.flow()
    spring = flow.where("flow_station_number = 'N11'").withColumn("flow_station_number", F.lit("BHC"))
    gauges = f.gauge_station_codes(f.gauge_daily_mean(r.gauge_readings()))
    archive = flow.where("flow_station_number in ('N3', 'N5')")
    return f.assemble_flow(archive, flow, spring, gauges, ["N3", "N5"], ["N7"], ("SYN", "N3", "N7"))


@query(
    "flow_with_station",
    "select date, flow_station_number, value, station_name_wq, flow_station_name, station_name from named_flow",
)
def _(r: Roles):
    return r.named_flow()


@query(
    "unmatched_flow_station",
    "select distinct flow_station_number from named_flow where station_name_wq is null",
)
def _(r: Roles):
    return linkage.unmatched_flow_stations(r.named_flow())


@query(
    "obs_with_station",
    """select station, sample_date, variable_name, measurement_value, flow_station_number, flow_station_name, station_name
      from obs left join lookup on station = station_name_wq""",
)
def _(r: Roles):
    cols = ["station", "sample_date", "variable_name", "measurement_value"]
    return linkage.obs_with_station(r.observations().select(*cols), r.station_lookup())


@query(
    "obs_with_flow",
    """select station, variable_name, sample_date, measurement_value, station_name, flow_station_number, daily_flow_cms,
      year, month_year, season, month_abb from fin""",
)
def _(r: Roles):
    return r.finished().select(
        "station", "variable_name", "sample_date", "measurement_value", "station_name", "flow_station_number",
        "daily_flow_cms", "year", "month_year", "season", "month_abb",
    )


@query(
    "missing_flow_month",
    """select month_year, station, sample_date, variable_name, count(*) as n_rows
      from fin where daily_flow_cms is null group by all""",
)
def _(r: Roles):
    return linkage.missing_flow_by_month(r.finished())


@query(
    "missing_flow_year",
    """select station, year, variable_name, month_abb, count(*) as n_rows
      from fin where daily_flow_cms is null group by all""",
)
def _(r: Roles):
    return linkage.missing_flow_by_year(r.finished())


@query(
    "daily_gap_fill",
    """select site, date, round(value, 6) as value from (
        select site, unnest(generate_series(min(date)::timestamp, max(date)::timestamp, interval 1 day))::date as date
        from daily group by site) left join daily using (site, date)""",
    ctes="""daily as (select site, reading_time::date as date, avg(flow_cms) as value from gauge group by all
      having count(flow_cms) = count(*))""",
)
def _(r: Roles):
    return f.fill_days(f.gauge_daily_mean(r.gauge_readings()), ["site"])


@query(
    "daily_gap_fill_fixed",
    """select flow_station_number, date, value from (
      select flow_station_number, unnest(generate_series(timestamp '2000-01-01', timestamp '2002-01-01', interval 1 day))::date
        as date from (select distinct flow_station_number from flow)) d full join flow using (flow_station_number, date)""",
)
def _(r: Roles):
    return f.fill_days(r.flow(), ["flow_station_number"], "date", "date'2000-01-01'", "date'2002-01-01'")
