"""Ranks of years in their history, boxes, flux."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.roles import CATEGORY_SQL, COUNT_VARIABLE, CUTOFF, LINEAR_ONLY, Roles, rank_sql
from gaugewise.operators import boxes
from gaugewise.operators.flux import daily_flux, flux
from gaugewise.operators.guidelines import guideline_bounds, overlay
from gaugewise.operators.ranking import attach_ranks, percentile_category, year_ranks
from gaugewise.plans.observations import observation_view

GROUP = ("station", "variable_name")
RANK_COLUMNS = "station, variable_name, year, round(median, 6) as median, n_history, round(perc_bin, 6) as perc_bin"
SUB_YEAR = "(select *, year(sample_date) as year from sub)"
EFF_SUB = """(select *, year(sample_date) as year, case when coalesce(measurement_flag2, false) then measurement_max_dl_sub
  else measurement_value end as ev from sub)"""


def _effective(r: Roles):
    from gaugewise.operators.censoring import effective_value

    return r.substituted().select(
        *GROUP, "sample_date", F.year("sample_date").alias("year"), effective_value().alias("measurement_value")
    )


@query("perc_bin_year", f"select {RANK_COLUMNS} from ranks", ctes=rank_sql(EFF_SUB, GROUP, "ev"))
def _(r: Roles):
    return year_ranks(_effective(r), GROUP, cutoff_year=CUTOFF)


@query(
    "perc_bin_price",
    f"select {RANK_COLUMNS} from ranks",
    ctes=rank_sql("(select *, year(sample_date) as year from raw)", GROUP, "price"),
)
def _(r: Roles):
    df = r.raw_observations().withColumn("year", F.year("sample_date"))
    return year_ranks(df, GROUP, value="price", cutoff_year=CUTOFF)


@query(
    "perc_bin_history_not_equal",
    f"select {RANK_COLUMNS} from ranks",
    ctes=rank_sql(
        SUB_YEAR, GROUP, "measurement_max_dl_sub", "year <> 1998", False, False, "year <> 1998"
    ),
)
def _(r: Roles):
    df = r.substituted().withColumn("year", F.year("sample_date"))
    return year_ranks(
        df, GROUP, value="measurement_max_dl_sub", cutoff_year=1998, history="not_equal", floor=None,
        zero_history_is_missing=False, rank_cutoff_year=False,
    )


@query(
    "perc_bin_strict_median",
    """select r.station, r.variable_name, r.year, n_history,
        case when gaps = 0 then round(median, 6) end as median, case when gaps = 0 then round(perc_bin, 6) end as perc_bin
      from ranks r join (select station, variable_name, year(sample_date) as year,
        count(*) - count(measurement_value) as gaps from obs group by all) g using (station, variable_name, year)""",
    ctes=rank_sql(
        "(select *, year(sample_date) as year from obs)", GROUP, "measurement_value", "year <> 2001", False, False
    ),
)
def _(r: Roles):
    df = r.observations().withColumn("year", F.year("sample_date"))
    return year_ranks(
        df, GROUP, cutoff_year=CUTOFF, history="not_equal", floor=None, zero_history_is_missing=False,
        strict_median=True,
    )


@query(
    "percentile_category",
    f"select station, variable_name, year, {CATEGORY_SQL} as percentile from ranks",
    ctes=rank_sql(EFF_SUB, GROUP, "ev"),
)
def _(r: Roles):
    ranks = year_ranks(_effective(r), GROUP, cutoff_year=CUTOFF)
    return ranks.select(*GROUP, "year", percentile_category("perc_bin").alias("percentile"))


@query(
    "obs_with_rank",
    f"""select e.station, e.variable_name, e.sample_date, e.year, e.ev as measurement_value, round(median, 6) as median,
      round(perc_bin, 6) as perc_bin, {CATEGORY_SQL} as percentile
      from {EFF_SUB} e left join ranks using (station, variable_name, year)""",
    ctes=rank_sql(EFF_SUB, GROUP, "ev"),
)
def _(r: Roles):
    df = _effective(r)
    return attach_ranks(df, year_ranks(df, GROUP, cutoff_year=CUTOFF), GROUP)


@query(
    "obs_with_rank_full",
    f"""select station, variable_name, year, sample_date, measurement_value, round(median, 6) as median,
      round(perc_bin, 6) as perc_bin, {CATEGORY_SQL} as percentile
      from ranks full join (select station, variable_name, year(sample_date) as year, sample_date, measurement_value
        from obs) o using (station, variable_name, year)""",
    ctes=rank_sql(SUB_YEAR, GROUP, "measurement_max_dl_sub", "year <> 2001", False, False, "year <> 2001"),
)
def _(r: Roles):
    ranks = year_ranks(
        r.substituted().withColumn("year", F.year("sample_date")), GROUP, value="measurement_max_dl_sub",
        cutoff_year=CUTOFF, history="not_equal", floor=None, zero_history_is_missing=False, rank_cutoff_year=False,
    )
    obs = r.observations().select(
        *GROUP, F.year("sample_date").alias("year"), "sample_date", "measurement_value"
    )
    return attach_ranks(obs, ranks, GROUP, how="full")


FLUX_SQL = """(select station_name, variable_name, sample_date, year, measurement_value as conc, unit_code as conc_unit,
  daily_flow_cms, case when unit_code = 'No/100 mL' then 'No/s' else 'mg/s' end as unit_code,
  measurement_value * (case when unit_code = 'No/100 mL' then 10 else 1 end) * 1000 * daily_flow_cms as measurement_value
  from vw where daily_flow_cms is not null and unit_code in ('mg/L', 'No/100 mL'))"""


@query(
    "flux",
    f"""select station_name, variable_name, sample_date, conc, conc_unit, daily_flow_cms, unit_code,
      round(measurement_value, 3) as measurement_value from {FLUX_SQL}""",
    digits=6,
)
def _(r: Roles):
    return flux(r.view()).select(
        "station_name", "variable_name", "sample_date", "conc", "conc_unit", "daily_flow_cms", "unit_code",
        F.round("measurement_value", 3).alias("measurement_value"),
    )


def _daily_sql(mass: str, count: str, mass_unit: str, count_unit: str, value: str) -> str:
    return f"""select station, variable_name, sample_date, measurement_value,
      round(case when variable_name = 'ECONOMY' then {value} * {count} * (daily_flow_cms * 86400)
        when variable_name in ('LARGE', 'SMALL') then {value} * {mass} * (daily_flow_cms * 86400) end, 3) as flux,
      case when variable_name = 'ECONOMY' then '{count_unit}' when variable_name in ('LARGE', 'SMALL') then '{mass_unit}' end
        as flux_unit from fin"""


def _daily(r: Roles, definition: str):
    df = daily_flux(r.finished(), ("ECONOMY", "LARGE", "SMALL"), definition, COUNT_VARIABLE)
    return df.select(
        "station", "variable_name", "sample_date", "measurement_value", F.round("flux", 3).alias("flux"), "flux_unit"
    )


@query("flux_kg_per_day", _daily_sql("0.001", "0.01", "kg/d", "mio No/d", "measurement_max_dl_sub"))
def _(r: Roles):
    return _daily(r, "kg_per_day")


@query("flux_first_draft", _daily_sql("0.001", "(0.1 * 0.001)::double", "mg/d", "No/d", "measurement_value"))
def _(r: Roles):
    return _daily(r, "first_draft")


SITE = ("station_name", "variable_name")


@query(
    "flux_perc_bin",
    """select station_name, variable_name, year, round(median, 3) as median, n_history, round(perc_bin, 6) as perc_bin
      from ranks""",
    ctes=rank_sql(FLUX_SQL, SITE, "measurement_value"),
)
def _(r: Roles):
    ranks = year_ranks(flux(r.view()), SITE, cutoff_year=CUTOFF)
    return ranks.withColumn("median", F.round("median", 3))


@query(
    "flux_draft_perc_bin",
    """select station_name, variable_name, year, round(median, 3) as median, n_history, round(perc_bin, 6) as perc_bin
      from ranks""",
    ctes=rank_sql(
        """(select station_name, variable_name, year, measurement_max_dl_sub * 0.001 * (daily_flow_cms * 86400) as flux
            from fin where variable_name in ('LARGE', 'SMALL'))""",
        SITE, "flux", "year <> 2001", False, False, "year <> 2001",
    ),
)
def _(r: Roles):
    df = daily_flux(r.finished(), ("LARGE", "SMALL"), count_variable=COUNT_VARIABLE)
    df = df.where("variable_name in ('LARGE', 'SMALL')")
    ranks = year_ranks(
        df, SITE, value="flux", cutoff_year=CUTOFF, history="not_equal", floor=None, zero_history_is_missing=False,
        rank_cutoff_year=False,
    )
    return ranks.withColumn("median", F.round("median", 3))


def box_sql(source: str, keys: str, value: str) -> str:
    on = " and ".join(f"b.{k.strip()} is not distinct from h.{k.strip()}" for k in keys.split(","))
    picked = ", ".join("b." + k.strip() for k in keys.split(","))
    return f"""bx as (select {keys}, {value} as v from {source} where {value} is not null),
hinge as (select {keys}, quantile_cont(v, 0.25) as lower, median(v) as middle, quantile_cont(v, 0.75) as upper
  from bx group by all),
fenced as (select {picked}, b.v, h.lower, h.middle, h.upper,
  b.v < h.lower - 1.5 * (h.upper - h.lower) or b.v > h.upper + 1.5 * (h.upper - h.lower) as outside
  from bx b join hinge h on {on}),
box as (select {keys}, count(*) as n, round(least(any_value(lower), min(v) filter (where not outside)), 6) as ymin,
  round(any_value(lower), 6) as lower, round(any_value(middle), 6) as middle, round(any_value(upper), 6) as upper,
  round(greatest(any_value(upper), max(v) filter (where not outside)), 6) as ymax,
  count(*) filter (where outside) as n_outliers from fenced group by all)"""


BOX_KEYS = "station, variable_name, year"


@query("box_stats", "select * from box", ctes=box_sql(EFF_SUB, BOX_KEYS, "ev"))
def _(r: Roles):
    return boxes.box_stats(_effective(r), [*GROUP, "year"], "measurement_value")


@query(
    "box_outliers",
    "select station, variable_name, year, round(v, 0) as outlier, count(*) as n from fenced where outside group by all",
    ctes=box_sql("(select *, year(sample_date) as year, price * price as pp from raw)", BOX_KEYS, "pp"),
    digits=0,
)
def _(r: Roles):
    df = r.raw_observations().select(*GROUP, F.year("sample_date").alias("year"), F.expr("price * price as pp"))
    return boxes.box_outliers(df, [*GROUP, "year"], "pp")


@query(
    "box_stats_log10",
    """select station, variable_name, year, n_nonpositive, box.* exclude (station, variable_name, year)
      from (select station, variable_name, year, count(*) filter (where variable_name <> 'PROMO' and pv <= 0) as n_nonpositive
        from signed group by all) l left join box using (station, variable_name, year)""",
    ctes="signed as (select station, variable_name, year(sample_date) as year, measurement_value - 2 as pv from obs), "
    + box_sql(
        """(select *, case when variable_name = 'PROMO' then pv when pv > 0 then log10(pv) end as lv from signed)""",
        BOX_KEYS, "lv",
    ),
)
def _(r: Roles):
    df = r.observations().select(
        *GROUP, F.year("sample_date").alias("year"), F.expr("measurement_value - 2 as pv")
    )
    from gaugewise.functions.scale import scaled_value

    scaled = df.withColumn("lv", scaled_value("pv", "variable_name", LINEAR_ONLY))
    lost = scaled.groupBy(*GROUP, "year").agg(F.count_if(F.expr("pv is not null and lv is null")).alias("n_nonpositive"))
    return lost.join(boxes.box_stats(scaled, [*GROUP, "year"], "lv"), [*GROUP, "year"], "left")


BOUND_SQL = """bounds as (select source, variable_name, unit_code, exposure_duration, value as guideline_value,
  (case side when 'lower_value' then 'Lower ' else 'Upper ' end) || exposure_duration as bound
  from (unpivot guide on lower_value, upper_value into name side value value))"""


@query(
    "guideline_unpivot",
    """select *, case bound when 'Upper acute' then 1 when 'Upper chronic' then 2 when 'Lower chronic' then 3 end::bigint
      as bound_rank, case when variable_name in ('PH', 'SODIUM ADSORPTION RATIO (CALCD.)') then variable_name
      else variable_name || ' (' || unit_code || ')' end as facet_title from bounds""",
    ctes="""priced as (select 'price' as source, p_type as variable_name, 'mg/L' as unit_code,
      case when p_size <= 25 then 'chronic' else 'acute' end as exposure_duration,
      min(case when p_size between 6 and 25 then p_retailprice end) as lower_value, max(p_retailprice) as upper_value
      from part group by all), """ + BOUND_SQL.replace("unpivot guide", "unpivot priced"),
)
def _(r: Roles):
    priced = r.table("part").selectExpr(
        "'price' as source", "p_type as variable_name", "'mg/L' as unit_code",
        "case when p_size <= 25 then 'chronic' else 'acute' end as exposure_duration", "p_size", "p_retailprice",
    )
    bounds = priced.groupBy("source", "variable_name", "unit_code", "exposure_duration").agg(
        F.expr("min(case when p_size between 6 and 25 then p_retailprice end) as lower_value"),
        F.max("p_retailprice").alias("upper_value"),
    )
    return guideline_bounds(bounds)


@query(
    "guideline_overlay",
    """select station_name, sample_date, vw.variable_name, vw.unit_code, measurement_value, bound, guideline_value,
      measurement_value > guideline_value as above from vw left join bounds
      on vw.variable_name is not distinct from bounds.variable_name and vw.unit_code is not distinct from bounds.unit_code""",
    ctes=BOUND_SQL,
)
def _(r: Roles):
    joined = overlay(observation_view(r.finished()), guideline_bounds(r.guidelines()))
    return joined.select(
        "station_name", "sample_date", "variable_name", "unit_code", "measurement_value", "bound", "guideline_value",
        F.expr("measurement_value > guideline_value as above"),
    )
