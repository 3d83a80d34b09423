"""Conforming, filtering, unions, text and calendar rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.roles import CUTOFF, Roles
from gaugewise.functions import calendar
from gaugewise.functions.rules import recode
from gaugewise.functions.text import censored_flag, censored_number, to_number
from gaugewise.operators import components, conform
from gaugewise.sources.readers import clean_names, run_query

UNIT_SQL = """case raw_unit when 'MPN/100mL' then 'MPN/100mL' when 'NO/100ML' then 'No/100 mL' when 'PH' then 'pH units'
  when 'MG/L' then 'mg/L' else raw_unit end"""
REACHES = ({"NATION_1": "Upper", "NATION_2": "Upper", "NATION_3": "Middle"}, "Lower")
REACH_SQL = "case range when 'NATION_1' then 'Upper' when 'NATION_2' then 'Upper' when 'NATION_3' then 'Middle' else 'Lower' end"
VARIABLE_NAMES = {"LARGE": "Big", "SMALL": "Little"}
TEMPLATE = "agency, range, station, sample_date, variable_name, measurement_value, measurement_flag"


@query(
    "observations_conformed",
    f"""select upper('Agency of ' || agency) as agency, upper({REACH_SQL}) as range, upper(station) as station, sample_date,
      case variable_name when 'LARGE' then 'Big' when 'SMALL' then 'Little' else variable_name end as variable_name,
      measurement_value, measurement_flag, {UNIT_SQL} as unit_code,
      null::double as detection_limit, null::double as flow_cms, count(*) as n from raw group by all""",
)
def _(r: Roles):
    raw = r.raw_observations().withColumnsRenamed({"station": "SiteName", "variable_name": "Parameter Name"})
    df = conform.with_reach(clean_names(raw.drop("unit_code")), "range", REACHES)
    renames = {"site_name": "station", "parameter_name": "variable_name", "raw_unit": "unit_code"}
    named = conform.conform(df, renames, F.concat(F.lit("Agency of "), F.col("agency")))
    out = conform.standard_units(conform.recode_variables(named, VARIABLE_NAMES))
    return conform.upper_names(out).groupBy(*out.columns).agg(F.count(F.lit(1)).alias("n"))


@query(
    "recode_lookup",
    f"select variable_name, raw_unit, {UNIT_SQL} as unit_code, count(*) as n from raw group by all",
)
def _(r: Roles):
    return conform.standard_units(
        r.raw_observations().withColumn("unit_code", F.col("raw_unit"))
    ).groupBy("variable_name", "raw_unit", "unit_code").agg(F.count(F.lit(1)).alias("n"))


@query(
    "reach_case_when",
    f"""select station, range, {REACH_SQL} as reach,
      case station when 'Supplier#000000001' then 'One' when 'Supplier#000000002' then 'Two' end as site_name,
      count(*) as n from raw group by all""",
)
def _(r: Roles):
    known, default = REACHES
    names = {"Supplier#000000001": "One", "Supplier#000000002": "Two"}
    return r.raw_observations().groupBy(
        "station",
        "range",
        recode("range", known, F.lit(default)).alias("reach"),
        recode("station", names, F.lit(None).cast("string")).alias("site_name"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "unit_repair",
    """select variable_name, case when variable_name = 'ECONOMY' and raw_unit = 'MPN/100mL' then 'No/100 mL'
        when variable_name = 'PROMO' and raw_unit = 'PH' then 'rel units' else raw_unit end as unit_code,
      count(*) as n, sum(measurement_value) as total from raw group by all""",
    digits=3,
)
def _(r: Roles):
    rules = [("ECONOMY", "MPN/100mL", "No/100 mL"), ("PROMO", "PH", "rel units")]
    df = r.raw_observations().withColumn("unit_code", F.col("raw_unit"))
    return conform.repair_units(df, rules).groupBy("variable_name", "unit_code").agg(
        F.count(F.lit(1)).alias("n"), F.sum("measurement_value").alias("total")
    )


@query(
    "allow_list_filter",
    f"""select {TEMPLATE} from obs where range in ('NATION_1', 'NATION_7', 'NATION_20')
      and variable_name in ('LARGE', 'PROMO')""",
)
def _(r: Roles):
    df = conform.keep_listed(r.observations(), "range", ["NATION_1", "NATION_7", "NATION_20"])
    return conform.keep_listed(df, "variable_name", ["LARGE", "PROMO"]).drop("unit_code")


@query(
    "study_period_filter",
    f"select {TEMPLATE} from obs where year(sample_date) > 1996 and year(sample_date) < 1999",
)
def _(r: Roles):
    return conform.keep_years(r.observations(), "sample_date", 1997, 1998).drop("unit_code")


@query(
    "variable_exclusion",
    f"""select {TEMPLATE} from obs where variable_name <> 'LARGE' and measurement_flag <> 'X'
      and year(sample_date) <> {CUTOFF} and measurement_value is not null""",
)
def _(r: Roles):
    df = conform.exclude(r.observations(), "variable_name", "LARGE")
    df = conform.exclude(df, "measurement_flag", "X").where(F.year("sample_date") != CUTOFF)
    return df.where(F.col("measurement_value").isNotNull()).drop("unit_code")


@query(
    "censored_rows",
    "select station, sample_date, variable_name, measurement_value from obs where measurement_flag in ('L', '<')",
)
def _(r: Roles):
    from gaugewise.operators.censoring import keep_censored

    return keep_censored(r.observations()).select("station", "sample_date", "variable_name", "measurement_value")


@query(
    "param_query",
    """select station, sample_date, variable_name, measurement_value from obs
      where agency = 'ASIA' and variable_name = 'SMALL' and measurement_value > 30""",
)
def _(r: Roles):
    r.observations().createOrReplaceTempView("param_query_observations")
    return run_query(
        r.spark,
        """select station, sample_date, variable_name, measurement_value from param_query_observations
           where agency = ? and variable_name = ? and measurement_value > ? order by variable_name, sample_date""",
        ["ASIA", "SMALL", 30.0],
    )


@query(
    "agency_union",
    """select agency, station, sample_date, variable_name, measurement_value, null::double as extra from obs
        where agency = 'ASIA'
      union all select agency, station, sample_date, variable_name, null, measurement_value from obs
        where agency = 'AFRICA'
      union all select agency, station, sample_date, variable_name, measurement_value, null from obs
        where agency is null or agency not in ('ASIA', 'AFRICA')""",
)
def _(r: Roles):
    cols = ["agency", "station", "sample_date", "variable_name"]
    obs = r.observations()
    first = obs.where("agency = 'ASIA'").select(*cols, "measurement_value")
    second = obs.where("agency = 'AFRICA'").select(F.col("measurement_value").alias("extra"), *reversed(cols))
    third = obs.where("agency is null or agency not in ('ASIA', 'AFRICA')").select("measurement_value", *cols)
    return conform.union_all(first, second, third)


@query(
    "replace_variable",
    f"""select {TEMPLATE}, unit_code from obs where not (variable_name = 'SMALL' and agency = 'ASIA')
      union all select agency, range, station, sample_date, variable_name, measurement_value * 2, null, 'ratio'
        from obs where variable_name = 'SMALL' and agency = 'ASIA'""",
)
def _(r: Roles):
    obs = r.observations()
    new = obs.where("variable_name = 'SMALL' and agency = 'ASIA'").selectExpr(
        "'ratio' as unit_code", "measurement_value * 2 as measurement_value", "station", "range", "agency",
        "sample_date", "variable_name",
    )
    return conform.replace_variable(obs, "SMALL", "ASIA", new)


@query(
    "names_intersect",
    "select s_name as name from supplier intersect select station from raw",
)
def _(r: Roles):
    return conform.names_in_both(r.table("supplier"), "s_name", r.observations(), "station")


@query(
    "names_missing",
    "select o_orderkey as name from orders except select l_orderkey from lineitem",
)
def _(r: Roles):
    return conform.names_only_in_first(r.table("orders"), "o_orderkey", r.table("lineitem"), "l_orderkey")


@query(
    "censored_text_parse",
    """select event_id, formatted_result, case when formatted_result like '%<%' then '<' end as flag,
      try_cast(replace(formatted_result, '<', '') as double) as number,
      try_cast(formatted_result as double) as plain from txt""",
)
def _(r: Roles):
    return r.text_results().select(
        "event_id",
        "formatted_result",
        censored_flag("formatted_result").alias("flag"),
        censored_number("formatted_result").alias("number"),
        to_number("formatted_result").alias("plain"),
    )


@query(
    "multi_format_dates",
    """select event_id, strptime(strftime(ts, '%-m/%-d/%Y %-H:%M'), '%m/%d/%Y %H:%M')::date as city_date,
      strftime(strptime(strftime(ts, '%-m/%-d/%Y %-H:%M:%S'), '%m/%d/%Y %H:%M:%S'), '%Y-%m-%d %H:%M:%S') as supplement_time,
      strftime(strptime(strftime(ts, '%Y-%-m-%-d %-H:%M'), '%Y-%m-%d %H:%M'), '%Y-%m-%d %H:%M:%S') as federal_time,
      null::date as unreadable from events""",
)
def _(r: Roles):
    text = r.table("events").selectExpr(
        "event_id",
        "date_format(ts, 'M/d/yyyy H:mm') as city",
        "date_format(ts, 'M/d/yyyy H:mm:ss') as supplement",
        "date_format(ts, 'yyyy-M-d H:mm') as federal",
    )

    def shown(time):
        return F.date_format(time, "yyyy-MM-dd HH:mm:ss")

    return text.select(
        "event_id",
        calendar.parse_date("city", "M/d/yyyy H:mm").alias("city_date"),
        shown(calendar.parse_time("supplement", "M/d/yyyy H:mm:ss")).alias("supplement_time"),
        shown(calendar.parse_time("federal", "yyyy-M-d H:mm")).alias("federal_time"),
        calendar.parse_date("city", "yyyy-M-d H:mm").alias("unreadable"),
    )


@query(
    "calendar_attributes",
    """select distinct sample_date, day(sample_date) as day, dayofyear(sample_date) as jday, year(sample_date) as year_cal,
      month(sample_date) as month_cal, date_trunc('month', sample_date)::date as month_year,
      strftime(sample_date, '%b') as month_abb, make_date(year(sample_date), 1, 1) as year_first,
      date_diff('day', make_date(year(sample_date), 1, 1), sample_date) + 1 as days_so_far from obs""",
)
def _(r: Roles):
    from gaugewise.operators.flow import with_calendar

    dates = r.observations().select("sample_date").distinct().withColumn("value", F.lit(1.0))
    return with_calendar(dates, "sample_date").select(
        "sample_date", "day", "jday", "year_cal", "month_cal",
        calendar.month_start("sample_date").alias("month_year"),
        calendar.month_label("sample_date").alias("month_abb"),
        calendar.year_start("year_cal").alias("year_first"),
        calendar.span_days(calendar.year_start("year_cal"), "sample_date").alias("days_so_far"),
    )


@query(
    "water_year_month",
    """select distinct date, flow_station_number,
      year(date) + case when month(date) >= 11 then 1 else 0 end as year_wy,
      case when value is not null then (case when month(date) >= 10 then month(date) - 9 else month(date) + 3 end) end as month_wy
      from flow""",
)
def _(r: Roles):
    return r.flow().select(
        "date", "flow_station_number",
        calendar.water_year("date").alias("year_wy"),
        calendar.water_month("date", "value").alias("month_wy"),
    )


@query(
    "seasons",
    """select distinct sample_date,
      case when month(sample_date) in (5, 6, 7) then 'high flow' when month(sample_date) in (8, 9, 10) then 'open water'
        else 'under ice' end as water,
      case when month(sample_date) between 4 and 10 then 'Open' else 'Ice' end as ice,
      case when month(sample_date) between 4 and 11 then 'OpenWater' else 'Winter' end as flow from obs""",
)
def _(r: Roles):
    dates = r.observations().select("sample_date").distinct()
    return dates.select("sample_date", *[calendar.season("sample_date", d).alias(d) for d in ("water", "ice", "flow")])


IDS = ["sample_site", "sample_date", "result_units"]
WIDE_SQL = """select sample_site, sample_date, result_units,
  (list(formatted_result order by try_cast(formatted_result as double) desc nulls last, formatted_result desc nulls last)
    filter (where parameter = 'click'))[1] as click,
  (list(formatted_result order by try_cast(formatted_result as double) desc nulls last, formatted_result desc nulls last)
    filter (where parameter = 'view'))[1] as view
  from txt where year(sample_date) > 2018 and parameter in ('click', 'view') group by all"""
TOTAL_CTES = f"""wide as ({WIDE_SQL}),
tot as (select *, nullif(coalesce(try_cast(click as double), 0) + coalesce(try_cast(view as double), 0), 0) as total from wide),
long as (
  select sample_site, sample_date, result_units, 'click' as parameter, click as formatted_result from tot
  union all select sample_site, sample_date, result_units, 'view', view from tot
  union all select sample_site, sample_date, result_units, 'total', total::varchar from tot),
parsed as (select *, case when formatted_result like '%<%' then '<' end as result_qualifier,
  try_cast(replace(formatted_result, '<', '') as double) as numeric_result from long)"""


def _recent(r: Roles):
    return r.text_results().where(F.year("sample_date") > 2018)


@query("pivot_components", WIDE_SQL)
def _(r: Roles):
    return components.pivot_components(_recent(r), IDS, "parameter", "formatted_result", ["click", "view"])


@query("unpivot_components", "select * from long where parameter <> 'total'", ctes=TOTAL_CTES)
def _(r: Roles):
    wide = components.pivot_components(_recent(r), IDS, "parameter", "formatted_result", ["click", "view"])
    return components.unpivot_components(wide, IDS, ["click", "view"], "parameter", "formatted_result")


@query(
    "component_total",
    """select sample_site, sample_date, parameter, result_qualifier, round(numeric_result, 6) as numeric_result, result_units,
        count(*) as n from (
        select sample_site, sample_date, parameter, result_qualifier, numeric_result, result_units from txt
        union all
        select sample_site, sample_date, parameter, result_qualifier, numeric_result, result_units from parsed p
        where not exists (select 1 from txt t where t.sample_site = p.sample_site and t.sample_date = p.sample_date
          and t.parameter = p.parameter and t.result_units = p.result_units
          and t.numeric_result is not distinct from p.numeric_result
          and t.result_qualifier is not distinct from p.result_qualifier
          and t.formatted_result is not distinct from p.formatted_result)) group by all""",
    ctes=TOTAL_CTES,
)
def _(r: Roles):
    derived = components.component_total(_recent(r), IDS, ["click", "view"], "total")
    out = components.append_new_rows(r.text_results(), derived)
    kept = ["sample_site", "sample_date", "parameter", "result_qualifier", "numeric_result", "result_units"]
    return out.groupBy(*kept).agg(F.count(F.lit(1)).alias("n"))
