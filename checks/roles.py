"""The monitoring tables, read out of the driver's tables, in Spark and in SQL.

One supplier is a sampling station, a part type a variable, a line item a result; orders give daily flow per
nation and events give gauge readings. `PRELUDE` holds the same definitions for the SQL side.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugewise.operators.censoring import flag_censored, substitute_limits
from gaugewise.operators.linkage import flow_with_station, obs_with_flow, obs_with_station
from gaugewise.operators.lookups import literal_table
from gaugewise.plans.observations import observation_view
from gaugewise.schema import GUIDELINES, LIMITS

# explicit schemas: no job to read footers before the query itself
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}
CUTOFF = 2001
COUNT_VARIABLE = "ECONOMY"
LINEAR_ONLY = ("PROMO",)
LIMIT_ROWS = [
    ("AFRICA", "LARGE", 5.0), ("AFRICA", "MEDIUM", 10.0), ("AFRICA", "SMALL", 12.0), ("AFRICA", "STANDARD", 12.0),
    ("AMERICA", "ECONOMY", 11.0), ("AMERICA", "LARGE", 9.0), ("AMERICA", "PROMO", 7.5), ("AMERICA", "STANDARD", 3.0),
    ("ASIA", "ECONOMY", 20.0), ("ASIA", "MEDIUM", 2.0), ("ASIA", "SMALL", 9.0), ("MARS", "SMALL", 9.0),
]
GUIDELINE_ROWS = [
    ("first", "LARGE", None, 30.0, "mg/L", "chronic"), ("first", "LARGE", None, 45.0, "mg/L", "acute"),
    ("first", "PROMO", 6.5, 9.0, "pH units", "chronic"), ("second", "ECONOMY", None, 40.0, "No/100 mL", "chronic"),
    ("second", "SMALL", 2.0, None, "µg/L", "acute"),
]
CONCENTRATION_PANELS = (
    "FLOW (cms)", "ECONOMY (No/100 mL)", "LARGE (mg/L)", "MEDIUM (mg/L)", "PROMO", "SMALL (mg/L)",
    "STANDARD (mg/L)", "TURBIDITY (NTU)",
)
FLUX_PANELS = (
    "FLOW (cms)", "ECONOMY (No/s)", "LARGE (mg/s)", "MEDIUM (mg/s)", "PROMO", "SMALL (mg/s)", "STANDARD (mg/s)",
    "TURBIDITY",
)
NON_FLUX = ("PROMO", "TURBIDITY")


def sql_values(rows: list[tuple]) -> str:
    def text(x) -> str:
        return "null" if x is None else f"'{x}'" if isinstance(x, str) else f"{x!r}::double"

    return ", ".join("(" + ", ".join(text(x) for x in row) + ")" for row in rows)


def sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def once(build: Callable[[Roles], DataFrame]) -> Callable[[Roles], DataFrame]:
    """Build a table of a `Roles` object one time; the same lazy plan serves every use."""

    @wraps(build)
    def get(self: Roles) -> DataFrame:
        if build.__name__ not in self.built:
            self.built[build.__name__] = build(self)
        return self.built[build.__name__]

    return get


class Roles:
    """Monitoring tables over the driver tables of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")
        self.built: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self.built:
            self.built[name] = self.spark.read.schema(TABLES[name]).parquet(f"{self.dir}/{name}.parquet")
        return self.built[name]

    @once
    def raw_observations(self) -> DataFrame:
        """Results with units in several spellings."""
        limit = "4 + length(p_type)"
        return (
            self.table("lineitem")
            .join(self.table("part").select("p_partkey", "p_type"), F.expr("l_partkey = p_partkey"))
            .join(self.table("supplier").select("s_suppkey", "s_name", "s_nationkey"), F.expr("l_suppkey = s_suppkey"))
            .join(self.table("nation"), F.expr("s_nationkey = n_nationkey"))
            .join(self.table("region"), F.expr("n_regionkey = r_regionkey"))
            .selectExpr(
                "r_name as agency",
                "n_name as range",
                "s_name as station",
                "to_date(l_shipdate) as sample_date",
                "p_type as variable_name",
                "nullif(l_quantity, 13) as measurement_value",
                f"""case when l_returnflag = 'R' and l_quantity <= {limit} then '<'
                         when l_returnflag = 'A' and l_quantity <= {limit} then 'L'
                         when l_returnflag = 'N' and l_quantity >= 48 then 'G'
                         when l_quantity = 47 then 'X' end as measurement_flag""",
                """case when p_type = 'ECONOMY' and l_returnflag = 'R' then 'MPN/100mL'
                        when p_type = 'ECONOMY' then 'NO/100ML'
                        when p_type = 'PROMO' then 'PH'
                        when l_returnflag = 'A' then 'MG/L' else 'mg/L' end as raw_unit""",
                "case p_type when 'ECONOMY' then 'No/100 mL' when 'PROMO' then 'pH units' else 'mg/L' end as unit_code",
                "n_nationkey",
                "l_extendedprice as price",
            )
        )

    @once
    def observations(self) -> DataFrame:
        return self.raw_observations().drop("raw_unit", "n_nationkey", "price")

    @once
    def limits(self) -> DataFrame:
        return literal_table(self.spark, LIMIT_ROWS, LIMITS)

    @once
    def guidelines(self) -> DataFrame:
        return literal_table(self.spark, GUIDELINE_ROWS, GUIDELINES)

    @once
    def censored(self) -> DataFrame:
        return flag_censored(self.observations())

    @once
    def substituted(self) -> DataFrame:
        return substitute_limits(self.censored(), self.limits())

    @once
    def station_lookup(self) -> DataFrame:
        """Sampling station to flow station; one nation has none, some flow stations have no name."""
        nation = self.table("nation").where("n_nationkey <> 24")
        return self.table("supplier").join(nation, F.expr("s_nationkey = n_nationkey")).selectExpr(
            "s_name as station_name_wq",
            "concat('N', n_nationkey) as flow_station_number",
            "case when n_nationkey % 5 <> 0 then n_name end as flow_station_name",
            "concat('Site u/s ', n_name) as station_name",
        )

    @once
    def flow_lookup(self) -> DataFrame:
        """One sampling station per flow station."""
        return self.table("nation").where("n_nationkey <> 24").selectExpr(
            "n_name as station_name_wq",
            "concat('N', n_nationkey) as flow_station_number",
            "case when n_nationkey % 5 <> 0 then n_name end as flow_station_name",
            "concat('Site u/s ', n_name) as station_name",
        )

    @once
    def flow(self) -> DataFrame:
        """Daily flow per nation, in eighths so that sums are exact; the 31st of a month is missing."""
        orders = self.table("orders").select("o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("date"))
        customers = self.table("customer").select("c_custkey", "c_nationkey")
        return (
            orders.join(customers, F.expr("o_custkey = c_custkey"))
            .groupBy("date", "c_nationkey")
            .agg(F.expr("floor(avg(cast(round(o_totalprice * 100) as bigint)) / 12500) / 8D as v"))
            .selectExpr(
                "date",
                "concat('N', c_nationkey) as flow_station_number",
                "case when day(date) <> 31 then v end as value",
            )
        )

    @once
    def named_flow(self) -> DataFrame:
        return flow_with_station(self.flow(), self.flow_lookup())

    @once
    def finished(self) -> DataFrame:
        """The finished observation table."""
        return obs_with_flow(obs_with_station(self.substituted(), self.station_lookup()), self.named_flow())

    @once
    def view(self) -> DataFrame:
        return observation_view(self.finished())

    @once
    def gauge_readings(self) -> DataFrame:
        return self.table("events").selectExpr(
            "case when user_id % 50 = 0 then 'PC2A' else concat('U', user_id) end as site",
            "ts as reading_time",
            "case when value <= 150 then value end as flow_cms",
        )

    @once
    def text_results(self) -> DataFrame:
        """Results reported as text, some censored, some unusable."""
        return self.table("events").selectExpr(
            "concat('U', user_id) as sample_site",
            "to_date(ts) as sample_date",
            "event_type as parameter",
            "value as numeric_result",
            "case when value < 20 then '<' end as result_qualifier",
            """case when event_type = 'error' then 'NR'
                    else concat(case when value < 20 then '<' else '' end, cast(value as string)) end
               as formatted_result""",
            "'mg/L' as result_units",
            "event_id",
            "ts",
        )


PRELUDE = f"""
with raw as (
  select r_name as agency, n_name as range, s_name as station, cast(l_shipdate as date) as sample_date,
    p_type as variable_name, nullif(l_quantity, 13) as measurement_value,
    case when l_returnflag = 'R' and l_quantity <= 4 + length(p_type) then '<'
         when l_returnflag = 'A' and l_quantity <= 4 + length(p_type) then 'L'
         when l_returnflag = 'N' and l_quantity >= 48 then 'G'
         when l_quantity = 47 then 'X' end as measurement_flag,
    case when p_type = 'ECONOMY' and l_returnflag = 'R' then 'MPN/100mL'
         when p_type = 'ECONOMY' then 'NO/100ML' when p_type = 'PROMO' then 'PH'
         when l_returnflag = 'A' then 'MG/L' else 'mg/L' end as raw_unit,
    case p_type when 'ECONOMY' then 'No/100 mL' when 'PROMO' then 'pH units' else 'mg/L' end as unit_code,
    n_nationkey, l_extendedprice as price
  from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
    join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
), obs as (
  select *, coalesce(measurement_flag in ('L', '<'), false) as cen_logic from raw
), lim(agency, variable_name, max_dl) as (values {sql_values(LIMIT_ROWS)}
), guide(source, variable_name, lower_value, upper_value, unit_code, exposure_duration) as
  (values {sql_values(GUIDELINE_ROWS)}
), sub as (
  select obs.*,
    case when max_dl is null then cen_logic when measurement_value <= max_dl then true
         when measurement_value > max_dl then cen_logic end as measurement_flag2,
    case when max_dl is null then measurement_value when measurement_value <= max_dl then max_dl
         when measurement_value > max_dl then measurement_value end as measurement_max_dl_sub
  from obs left join lim using (agency, variable_name)
), lookup as (
  select s_name as station_name_wq, 'N' || n_nationkey as flow_station_number,
    case when n_nationkey % 5 <> 0 then n_name end as flow_station_name, 'Site u/s ' || n_name as station_name
  from supplier join nation on s_nationkey = n_nationkey where n_nationkey <> 24
), flow_lookup as (
  select n_name as station_name_wq, 'N' || n_nationkey as flow_station_number,
    case when n_nationkey % 5 <> 0 then n_name end as flow_station_name, 'Site u/s ' || n_name as station_name
  from nation where n_nationkey <> 24
), flow as (
  select cast(o_orderdate as date) as date, 'N' || c_nationkey as flow_station_number,
    case when day(cast(o_orderdate as date)) <> 31 then floor(avg(cast(round(o_totalprice * 100) as bigint)) / 12500) / 8::double end as value
  from orders join customer on o_custkey = c_custkey group by 1, 2
), named_flow as (
  select flow.*, station_name_wq, flow_station_name, station_name from flow left join flow_lookup using (flow_station_number)
), fin as (
  select sub.*, l.flow_station_number, l.flow_station_name, l.station_name, f.value as daily_flow_cms,
    f.station_name_wq, year(sample_date) as year, date_trunc('month', sample_date)::date as month_year,
    case when month(sample_date) between 4 and 10 then 'Open' else 'Ice' end as season,
    strftime(sample_date, '%b') as month_abb
  from sub left join lookup l on sub.station = l.station_name_wq
    left join named_flow f on l.flow_station_number is not distinct from f.flow_station_number
      and l.flow_station_name is not distinct from f.flow_station_name and sub.sample_date = f.date
      and l.station_name is not distinct from f.station_name
), eff as (
  select *, case when coalesce(measurement_flag2, false) then measurement_max_dl_sub else measurement_value end as ev,
    case when coalesce(measurement_flag2, false) or measurement_flag in ('L', '<') then 'below detection limit'
         when measurement_flag is null then 'detected'
         when measurement_flag in ('G', '>') then 'above detection limit' end as dc
  from fin
), vw as (
  select station_name, variable_name, sample_date, ev as measurement_value, dc as detection_condition, year,
    case when month(sample_date) in (5, 6, 7) then 'high flow' when month(sample_date) in (8, 9, 10) then 'open water'
         else 'under ice' end as season, daily_flow_cms, unit_code
  from eff where ev is not null and station_name is not null
), gauge as (
  select case when user_id % 50 = 0 then 'PC2A' else 'U' || user_id end as site, ts as reading_time,
    case when value <= 150 then value end as flow_cms from events
), txt as (
  select 'U' || user_id as sample_site, cast(ts as date) as sample_date, event_type as parameter,
    value as numeric_result, case when value < 20 then '<' end as result_qualifier,
    case when event_type = 'error' then 'NR' else (case when value < 20 then '<' else '' end) || cast(value as varchar) end
      as formatted_result, 'mg/L' as result_units, event_id, ts
  from events
)
"""


def rank_sql(
    source: str, group: tuple[str, ...], value: str, history: str = f"year < {CUTOFF}", floor: bool = True,
    zero_missing: bool = True, where: str = "true", prefix: str = "",
) -> str:
    """CTEs computing the year ranks of `source`; the last one is named `{prefix}ranks`."""
    keys = ", ".join(group)
    same = " and ".join(f"h.{g} is not distinct from m.{g}" for g in group)
    share = "n_below / nullif(n_history, 0)::double"
    rank = f"case when n_below = 0 and n_history > 0 then 0.01 else {share} end" if floor else share
    if zero_missing:
        rank = f"case when total <> 0 then {rank} end"
    return f"""
{prefix}base as (select {keys}, year, {value} as v from {source} where {value} is not null),
{prefix}hist as (select {keys}, v, count(*) as n from {prefix}base where {history} group by all),
{prefix}tot as (select {keys}, sum(n) as n_history, sum(n * v) as total from {prefix}hist group by all),
{prefix}med as (select {keys}, year, median(v) as median from {prefix}base where {where} group by all),
{prefix}below as (select {', '.join('m.' + g for g in group)}, m.year, m.median,
    coalesce(sum(case when h.v <= m.median then h.n end), 0) as n_below
  from {prefix}med m left join {prefix}hist h on {same} group by all),
{prefix}ranks as (select {', '.join('m.' + g for g in group)}, m.year, m.median,
    coalesce(h.n_history, 0)::bigint as n_history, {rank} as perc_bin
  from {prefix}below m left join {prefix}tot h on {same})
"""


CATEGORY_SQL = (
    "case when perc_bin is null or perc_bin <= 0 then 'Not ranked' when perc_bin <= 0.1 then '<10th' "
    "when perc_bin <= 0.25 then '10th - 24th' when perc_bin <= 0.75 then '25th - 75th' "
    "when perc_bin <= 0.9 then '76th - 90th' when perc_bin <= 1 then '>90th' else 'Not ranked' end"
)
