"""Chart-ready rows for all stations and variables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.distribution import BOUND_SQL, FLUX_SQL, SITE, box_sql
from checks.registry import query
from checks.roles import (
    CATEGORY_SQL,
    CONCENTRATION_PANELS,
    COUNT_VARIABLE,
    CUTOFF,
    FLUX_PANELS,
    LINEAR_ONLY,
    NON_FLUX,
    Roles,
    rank_sql,
    sql_list,
)
from gaugewise.operators.coverage import stations_with_flow
from gaugewise.operators.lookups import literal_table
from gaugewise.operators.nesting import nest_rows
from gaugewise.operators.ordering import month_counts, sorted_flow
from gaugewise.operators.ranking import year_ranks
from gaugewise.plans import charts

VIEW_RANKS = rank_sql("vw", SITE, "measurement_value")
FLUX_RANKS = f"fx as (select * from {FLUX_SQL}), " + rank_sql("fx", SITE, "measurement_value")
SAFE = "replace(station_name, 'u/s', 'upstream')"
LOG = "round(case when measurement_value > 0 then log10(measurement_value) end, 6)"
ON_RANK = "k.station_name is not distinct from {0}.station_name and k.variable_name = {0}.variable_name and k.year = {0}.year"


@query("observation_view", "select * from vw")
def _(r: Roles):
    return r.view()


@query(
    "chart_concentration",
    f"""select vw.station_name, vw.variable_name, sample_date, vw.year, measurement_value, detection_condition, season,
      unit_code, round(median, 6) as median, round(perc_bin, 6) as perc_bin, {CATEGORY_SQL} as percentile,
      case when vw.variable_name = 'PROMO' then measurement_value else {LOG} end as plotted_value,
      concat_ws('_', replace(vw.station_name, 'u/s', 'upstream'), vw.variable_name, 'log_conc') as output_key
      from vw left join ranks k on {ON_RANK.format('vw')}""",
    ctes=VIEW_RANKS,
)
def _(r: Roles):
    return charts.concentration_rows(r.view(), CUTOFF, linear_only=LINEAR_ONLY).drop("daily_flow_cms")


@query(
    "chart_concentration_layers",
    f"""select b.station_name, b.variable_name, b.year, n, ymin, lower, middle, upper, ymax, n_outliers,
        round(perc_bin, 6) as perc_bin, {CATEGORY_SQL} as percentile, 'box' as layer, null as bound
      from box b left join ranks k on {ON_RANK.format('b')}
      union all select station_name, variable_name, year, count(*), null, null, round(v, 6), null, null, null, null, null,
        'outlier', null from fenced where outside group by all
      union all select station_name, u.variable_name, null, null, null, null, guideline_value, null, null, null, null, null,
        'guideline', bound
      from (select distinct station_name, variable_name, unit_code from vw) u join bounds using (variable_name, unit_code)""",
    ctes=VIEW_RANKS
    + ", "
    + BOUND_SQL
    + ", "
    + box_sql(
        f"""(select *, case when variable_name = 'PROMO' then measurement_value when measurement_value > 0
          then log10(measurement_value) end as pv from vw)""",
        "station_name, variable_name, year", "pv",
    ),
)
def _(r: Roles):
    return charts.concentration_layers(r.view(), r.guidelines(), CUTOFF, LINEAR_ONLY)


@query(
    "chart_flux",
    f"""select fx.station_name, fx.variable_name, sample_date, fx.year, round(measurement_value, 3) as measurement_value,
      unit_code, round(perc_bin, 6) as perc_bin, {CATEGORY_SQL} as percentile, {LOG} as plotted_value,
      concat_ws('_', replace(fx.station_name, 'u/s', 'upstream'), fx.variable_name, 'log_flux') as output_key
      from fx left join ranks k on {ON_RANK.format('fx')}""",
    ctes=FLUX_RANKS,
)
def _(r: Roles):
    return charts.flux_rows(r.view(), CUTOFF).select(
        *SITE, "sample_date", "year", F.round("measurement_value", 3).alias("measurement_value"), "unit_code",
        "perc_bin", "percentile", "plotted_value", "output_key",
    )


@query(
    "chart_flux_boxes",
    """select station_name, variable_name, year, 0 as n_nonpositive, n, ymin, lower, middle, upper, ymax, n_outliers from box""",
    ctes=f"fx as (select * from {FLUX_SQL}), "
    + box_sql("(select *, log10(measurement_value) as lv from fx)", "station_name, variable_name, year", "lv"),
)
def _(r: Roles):
    return charts.flux_boxes(r.view())


@query(
    "chart_scatter",
    f"""select station_name, variable_name, sample_date, measurement_value, detection_condition,
      case detection_condition when 'below detection limit' then 1 when 'detected' then 2 when 'above detection limit' then 3
        end::bigint as detection_rank, season,
      case season when 'high flow' then 1 when 'open water' then 2 else 3 end::bigint as season_rank,
      variable_name || ' (' || unit_code || ')' as axis_title,
      concat_ws('_', {SAFE}, variable_name, 'scatter') as output_key from vw""",
)
def _(r: Roles):
    return charts.scatter_rows(r.view())


SERIES = """series as (select distinct station_name, date as sample_date, value as daily_flow_cms from named_flow),
span as (select year(min(sample_date)) as y0, year(max(sample_date)) as y1 from obs)"""


@query(
    "chart_flow",
    f"""select station_name, sample_date, daily_flow_cms, concat_ws('_', {SAFE}, 'FLOW') as output_key from (
        select * from own
        union all select d.station_name, d.sample_date, null from (select station_name,
            unnest(generate_series(min(sample_date)::timestamp, max(sample_date)::timestamp, interval 1 day))::date as sample_date
            from own group by station_name) d
          where not exists (select 1 from own s where s.station_name is not distinct from d.station_name
            and s.sample_date = d.sample_date)), span
      where sample_date between make_date(y0 - 1, 1, 1) and make_date(y1 + 1, 1, 1)""",
    ctes=SERIES + ", own as (select * from series where station_name in (select station_name from fin where station_name is not null))",
)
def _(r: Roles):
    return charts.flow_rows(r.named_flow(), r.finished())


def panel_title_sql(table: str = "") -> str:
    return f"case when {table}variable_name in ('PROMO') then {table}variable_name else {table}variable_name || ' (' || {table}unit_code || ')' end"


def panel_boxes(source: str) -> str:
    """Boxes of the logarithms by panel and year."""
    titled = f"(select *, {panel_title_sql()} as facet_title, case when measurement_value > 0 then log10(measurement_value) end as pv from {source})"
    return box_sql(titled, "station_name, variable_name, facet_title, year", "pv")


def panels_sql(source: str, panels: tuple[str, ...], non_flux: tuple[str, ...], ending: str, digits: int) -> str:
    title = panel_title_sql()
    listed = sql_list(panels)
    label = f"case when facet_title in ({sql_list(non_flux)}) then 'Not a flux parameter' else 'Unavailable' end" if non_flux else "'Unavailable'"
    position = f"nullif(list_position([{listed}], facet_title), 0)::bigint"
    inside = "between date '2000-01-01' and make_date(y1 + 1, 1, 1)"
    guideline = "" if non_flux else f"""union all by name
      select station_name, facet_title, guideline_value as measurement_value, {LOG.replace('measurement_value', 'guideline_value')} as plotted_value,
        'guideline' as layer, bound
      from (select distinct station_name from vw) cross join (select *, {title} as facet_title from bounds)
      where facet_title in ({listed})"""
    return f"""select *, {position} as facet_rank, concat_ws('_', {SAFE}, '{ending}') as output_key from (
      select s.station_name, {panel_title_sql('s.')} as facet_title,
        make_date(s.year, 1, 1) as sample_date, round(measurement_value, {digits}) as measurement_value, {LOG} as plotted_value,
        s.year, round(perc_bin, 6) as perc_bin, {CATEGORY_SQL} as percentile, 'result' as layer, null as text, null as bound
      from {source} s left join ranks k on {ON_RANK.format('s')}, span
      where make_date(s.year, 1, 1) {inside}
      union all by name
      select b.station_name, facet_title, make_date(b.year, 1, 1) as sample_date, b.year, round(perc_bin, 6) as perc_bin,
        {CATEGORY_SQL} as percentile, n, ymin, lower, middle, upper, ymax, n_outliers, 'box' as layer
      from box b left join ranks k on {ON_RANK.format('b')}, span where make_date(b.year, 1, 1) {inside}
      union all by name
      select station_name, facet_title, make_date(year, 1, 1) as sample_date, year, round(v, 6) as middle, count(*) as n, 'outlier' as layer
      from fenced, span where outside and make_date(year, 1, 1) {inside} group by all
      union all by name
      select d.station_name, 'FLOW (cms)' as facet_title, d.sample_date, daily_flow_cms as measurement_value,
        {LOG.replace('measurement_value', 'daily_flow_cms')} as plotted_value, year(d.sample_date) as year, 'flow' as layer
      from (select station_name, unnest(generate_series(timestamp '2000-01-01', make_date(y1 + 1, 1, 1)::timestamp, interval 1 day))::date
          as sample_date from (select distinct station_name from {source}), span) d
        left join series f on f.station_name is not distinct from d.station_name and f.sample_date = d.sample_date
      union all by name
      select station_name, facet_title, 'label' as layer, {label} as text
      from (select distinct station_name from {source}) st cross join (select unnest([{listed}]) as facet_title) p
      where not exists (select 1 from {source} h where h.station_name is not distinct from st.station_name
          and {title} = p.facet_title)
        and not (facet_title = 'FLOW (cms)' and exists (select 1 from series f
          where f.station_name is not distinct from st.station_name and daily_flow_cms is not null))
      {guideline})"""


@query(
    "facet_concentration",
    panels_sql("vw", CONCENTRATION_PANELS, (), "log_conc", 6),
    ctes=VIEW_RANKS + ", " + SERIES + ", " + BOUND_SQL + ", " + panel_boxes("vw"),
)
def _(r: Roles):
    return charts.concentration_panels(
        r.view(), r.named_flow(), r.observations(), r.guidelines(), CONCENTRATION_PANELS, CUTOFF, LINEAR_ONLY
    )


@query(
    "facet_flux", panels_sql("fx", FLUX_PANELS, NON_FLUX, "log_flux", 3),
    ctes=FLUX_RANKS + ", " + SERIES + ", " + panel_boxes("fx"),
)
def _(r: Roles):
    out = charts.flux_panels(
        r.view(), r.named_flow(), r.observations(), FLUX_PANELS, NON_FLUX, CUTOFF, LINEAR_ONLY
    )
    rounded = F.when(F.col("layer") == "result", F.round("measurement_value", 3)).otherwise(F.col("measurement_value"))
    return out.withColumns({"measurement_value": rounded, "bound": F.lit(None).cast("string")})


@query(
    "chart_concentration_linear",
    f"""select vw.station_name, vw.variable_name, sample_date, vw.year, round(perc_bin, 6) as perc_bin, {CATEGORY_SQL} as percentile,
      measurement_value as plotted_value,
      concat_ws('_', replace(vw.station_name, 'u/s', 'upstream'), vw.variable_name, 'conc') as output_key
      from vw left join ranks k on {ON_RANK.format('vw')}""",
    ctes=VIEW_RANKS,
)
def _(r: Roles):
    rows = charts.concentration_rows(r.view(), CUTOFF, log10=False)
    return rows.select(*SITE, "sample_date", "year", "perc_bin", "percentile", "plotted_value", "output_key")


def layers_sql(digits: int) -> str:
    """Boxes with the rank of their year, and outliers."""
    return f"""select b.station_name, b.variable_name, b.year, n, {', '.join(f'round({c}, {digits}) as {c}' for c in ('ymin', 'lower', 'middle', 'upper', 'ymax'))},
        n_outliers, round(perc_bin, 6) as perc_bin, {CATEGORY_SQL} as percentile, 'box' as layer
      from box b left join ranks k on {ON_RANK.format('b')}
      union all by name select station_name, variable_name, year, round(v, {digits}) as middle, count(*) as n,
        'outlier' as layer from fenced where outside group by all"""


@query(
    "chart_concentration_layers_linear", layers_sql(6),
    ctes=VIEW_RANKS + ", " + box_sql("vw", "station_name, variable_name, year", "measurement_value"),
)
def _(r: Roles):
    return charts.yearly_layers(r.view(), CUTOFF, log10=False)


@query(
    "chart_flux_layers", layers_sql(6),
    ctes=FLUX_RANKS + ", " + box_sql("(select *, log10(measurement_value) as lv from fx)", "station_name, variable_name, year", "lv"),
)
def _(r: Roles):
    return charts.flux_layers(r.view(), CUTOFF)


@query(
    "chart_flux_layers_linear", layers_sql(2),
    ctes=FLUX_RANKS + ", " + box_sql("fx", "station_name, variable_name, year", "measurement_value"),
)
def _(r: Roles):
    out = charts.flux_layers(r.view(), CUTOFF, log10=False)
    return out.withColumns({c: F.round(c, 2) for c in ("ymin", "lower", "middle", "upper", "ymax")})


@query(
    "flux_tasks",
    f"""select station_name, variable_name, coalesce(n, 0) as n_flux, case when n is null then 'Unavailable' end as flux_label,
      concat_ws('_', {SAFE}, variable_name, 'log_flux') as output_key
      from (select distinct f.station_name from named_flow f join fin on f.station_name = fin.station_name) s
      cross join (select distinct variable_name from fin where variable_name = 'ECONOMY' or unit_code like '%g/L') v
      left join (select station_name, variable_name, count(*) as n from vw
        where daily_flow_cms is not null and unit_code in ('mg/L', 'No/100 mL') group by all) c using (station_name, variable_name)""",
)
def _(r: Roles):
    return charts.flux_tasks(r.finished(), r.named_flow(), r.view(), COUNT_VARIABLE)


@query(
    "task_grid",
    """select s.station_name, v.variable_name, coalesce(n, 0) as n_results, coalesce(nf, 0) as n_with_flow,
      case when n is null then 'Unavailable' end as concentration_label,
      case when coalesce(nx, 0) = 0 then 'Unavailable' end as flux_label
      from (select distinct station_name from fin where station_name is not null) s
      cross join (select distinct variable_name from fin) v
      left join (select station_name, variable_name, count(*) as n, count(daily_flow_cms) as nf,
          count(*) filter (where daily_flow_cms is not null and unit_code in ('mg/L', 'No/100 mL')) as nx from vw group by all) c
        using (station_name, variable_name)""",
)
def _(r: Roles):
    return charts.chart_tasks(r.finished(), r.view())


@query(
    "chart_draft",
    f"""select f.station_name, f.variable_name, month_year, f.year, measurement_max_dl_sub as plotted_value,
      round(perc_bin, 6) as perc_bin, {CATEGORY_SQL} as percentile from fin f left join ranks k on {ON_RANK.format('f')}
      where f.year <> {CUTOFF}""",
    ctes=rank_sql("fin", SITE, "measurement_max_dl_sub", f"year <> {CUTOFF}", False, False, f"year <> {CUTOFF}"),
)
def _(r: Roles):
    obs = r.finished()
    ranks = year_ranks(
        obs, SITE, value="measurement_max_dl_sub", cutoff_year=CUTOFF, history="not_equal", floor=None,
        zero_history_is_missing=False, rank_cutoff_year=False,
    )
    return charts.draft_rows(obs, "measurement_max_dl_sub", ranks, CUTOFF)


DRAFT_VARIABLES = ("ECONOMY", "LARGE", "SMALL")
DRAFT_LINES = [("LARGE (mg/L)", "Chronic", 30.0), ("LARGE (mg/L)", "Acute", 45.0), ("PROMO (pH units)", "Chronic", 6.5)]
DRAFT_RANKS = rank_sql("fin", SITE, "measurement_max_dl_sub", f"year <> {CUTOFF}", False, False, f"year <> {CUTOFF}")


def _draft_ranks(r: Roles):
    return year_ranks(
        r.finished(), SITE, value="measurement_max_dl_sub", cutoff_year=CUTOFF, history="not_equal", floor=None,
        zero_history_is_missing=False, rank_cutoff_year=False,
    )


@query(
    "chart_draft_flow",
    f"""select station_name, date_trunc('month', sample_date)::date as month_year, daily_flow_cms,
      concat_ws('_', {SAFE}, 'flow') as output_key from fin
      where station_name in (select f.station_name from named_flow f)""",
)
def _(r: Roles):
    return charts.draft_flow_line(r.finished(), stations_with_flow(r.finished(), r.named_flow()))


@query(
    "chart_draft_flux",
    f"""select f.station_name, f.variable_name, date_trunc('month', sample_date)::date as month_year, f.year,
      round(measurement_max_dl_sub * (case when f.variable_name = 'ECONOMY' then 0.01 else 0.001 end) * (daily_flow_cms * 86400), 3)
        as plotted_value, round(perc_bin, 6) as perc_bin, {CATEGORY_SQL} as percentile
      from fin f left join ranks k on {ON_RANK.format('f')}
      where f.year <> {CUTOFF} and f.variable_name in ({sql_list(DRAFT_VARIABLES)})
        and f.station_name in (select n.station_name from named_flow n)""",
    ctes=DRAFT_RANKS,
)
def _(r: Roles):
    sites = stations_with_flow(r.finished(), r.named_flow())
    out = charts.draft_flux_rows(r.finished(), _draft_ranks(r), sites, DRAFT_VARIABLES, CUTOFF, count_variable=COUNT_VARIABLE)
    return out.withColumn("plotted_value", F.round("plotted_value", 3))


@query(
    "chart_draft_panels",
    """select * from shown union all by name
      select station_name, panel, value as measurement_value, round(log10(value), 6) as plotted_value, variable_name_unit, exposure,
        'guideline' as layer from (select distinct station_name, panel from shown) cross join lines""",
    ctes=DRAFT_RANKS
    + f""", lines (variable_name_unit, exposure, value) as (values {", ".join(repr(x) for x in DRAFT_LINES)}), shown as (
        select f.station_name, f.variable_name || ' (' || unit_code || ')' as panel, f.year, measurement_value, {LOG} as plotted_value,
          round(perc_bin, 6) as perc_bin, {CATEGORY_SQL} as percentile, 'result' as layer
        from fin f left join ranks k on {ON_RANK.format('f')} where unit_code <> 'NTU')""",
)
def _(r: Roles):
    lines = literal_table(r.spark, DRAFT_LINES, "variable_name_unit string, exposure string, guideline_value double")
    return charts.draft_panels(r.finished(), _draft_ranks(r), lines, "NTU")


@query(
    "station_nested",
    """select station, year(sample_date)::bigint as year, count(*) as n_rows, round(sum(measurement_value), 3) as total,
      count(distinct (sample_date, variable_name, measurement_value, measurement_flag)) as n_entries,
      ceil(count(distinct (sample_date, variable_name, measurement_value, measurement_flag)) / 20)::bigint as n_pages
      from obs group by all""",
    digits=3,
)
def _(r: Roles):
    cols = ["station", "sample_date", "variable_name", "measurement_value", "measurement_flag"]
    nested = nest_rows(r.observations().select(*cols, F.year("sample_date").alias("year")), ["station", "year"], page_rows=20)
    return nested.groupBy("station", "year").agg(
        F.expr("sum(aggregate(data, 0L, (a, x) -> a + x.n_rows)) as n_rows"),
        F.expr("sum(aggregate(data, 0D, (a, x) -> a + coalesce(x.measurement_value, 0D) * x.n_rows)) as total"),
        F.expr("sum(cast(size(data) as long)) as n_entries"),
        F.expr("max(page) + 1 as n_pages"),
    )


@query(
    "obs_by_month",
    """select station, m.month_abb, coalesce(n, 0)::bigint as n_samples, m.month_rank from (select distinct station from fin)
      cross join (select strftime(make_date(2001, i, 1), '%b') as month_abb, i as month_rank from range(1, 13) t (i)) m
      left join (select station, month_abb, count(*) as n from fin group by all) c using (station, month_abb)""",
)
def _(r: Roles):
    return month_counts(r.finished(), ["station"]).withColumn("month_rank", F.col("month_rank").cast("long"))


@query("flow_sorted", "select date, flow_station_number, value from flow order by flow_station_number, date")
def _(r: Roles):
    return sorted_flow(r.flow()).select("date", "flow_station_number", "value")
