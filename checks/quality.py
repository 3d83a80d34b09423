"""Duplicates and missing combinations."""

from __future__ import annotations

from checks.registry import query
from checks.roles import CONCENTRATION_PANELS, LINEAR_ONLY, Roles, sql_list
from gaugewise.functions.text import panel_title
from gaugewise.operators import coverage, quality

KEYS = ["l_orderkey", "l_linenumber"]
OTHERS = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
NUMBERED = f"""numbered as (select *, row_number() over (partition by l_orderkey, l_linenumber order by
  l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) as rn,
  count(*) over (partition by l_orderkey, l_linenumber) as copies from lineitem)"""


def _columns(df):
    return df.selectExpr(*KEYS, *OTHERS.split(", "), "to_date(l_shipdate) as shipdate")


SELECT = f"select l_orderkey, l_linenumber, {OTHERS}, l_shipdate::date as shipdate from numbered"


@query("duplicate_flag", f"{SELECT} where copies > 1", ctes=NUMBERED)
def _(r: Roles):
    return _columns(quality.duplicate_rows(r.table("lineitem"), KEYS))


@query("duplicate_keep_first", f"{SELECT} where rn = 1", ctes=NUMBERED)
def _(r: Roles):
    return _columns(quality.keep_first(r.table("lineitem"), KEYS))


@query("duplicate_later_rows", f"{SELECT} where rn > 1", ctes=NUMBERED)
def _(r: Roles):
    return _columns(quality.later_rows(r.table("lineitem"), KEYS))


@query(
    "unknown_flags",
    """select station_name, variable_name, count(*) as n_unknown from vw where detection_condition is null group by all""",
)
def _(r: Roles):
    return quality.unknown_flags(r.view())


@query(
    "combination_grid",
    """select station, variable_name, n from (select distinct station from rare) cross join
      (select distinct variable_name from rare) left join
      (select station, variable_name, count(*) as n from rare group by all) using (station, variable_name)""",
    ctes="rare as (select station, variable_name || ' ' || floor(price / 2000)::bigint as variable_name from raw)",
)
def _(r: Roles):
    banded = "concat(variable_name, ' ', cast(floor(price / 2000) as bigint)) as variable_name"  # some bands miss at a station
    return coverage.combination_counts(r.raw_observations().selectExpr("station", banded))


PRESENT = f"""present as (select distinct station_name, case when variable_name in ({sql_list(LINEAR_ONLY)}) then variable_name
  else variable_name || ' (' || unit_code || ')' end as facet_title from vw)"""


@query(
    "coverage_labels",
    f"""select station_name, facet_title, facet_rank, 'Unavailable' as text from
      (select distinct station_name from present) st cross join
      (select unnest([{sql_list(CONCENTRATION_PANELS)}]) as facet_title,
        generate_subscripts([{sql_list(CONCENTRATION_PANELS)}], 1) - 1 as facet_rank) p
      where not exists (select 1 from present h where h.station_name = st.station_name and h.facet_title = p.facet_title)
        and not (facet_title = 'FLOW (cms)' and exists (select 1 from named_flow f
          where f.station_name = st.station_name and value is not null))""",
    ctes=PRESENT,
)
def _(r: Roles):
    titles = r.view().select("station_name", panel_title("variable_name", "unit_code", LINEAR_ONLY).alias("facet_title"))
    return coverage.missing_panels(titles.distinct(), coverage.flow_series(r.named_flow()), CONCENTRATION_PANELS)
