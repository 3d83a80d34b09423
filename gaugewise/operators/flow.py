"""Daily flow: derivations, statistics, gauge readings, assembly of sources, and filling of missing days."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugewise.fixed_values import GAUGE_SITE_STATIONS, SYNTHETIC_FLOW_STATION
from gaugewise.functions import calendar
from gaugewise.functions.rules import count_missing, percent, recode, strict
from gaugewise.operators.conform import union_all
from gaugewise.operators.distribution import grouped_quantiles
from gaugewise.operators.lookups import join_same

STATION, DATE, VALUE = "flow_station_number", "date", "value"


def with_station_details(flow: DataFrame, stations: DataFrame) -> DataFrame:
    """Station name and drainage area on a flow series keyed by `station_number`."""
    details = stations.select("station_number", "station_name", "drainage_area_gross")
    return join_same(flow, details, ["station_number"])


def with_runoff(df: DataFrame, value: str = VALUE, area_km2: str = "drainage_area_gross") -> DataFrame:
    """Runoff depth in mm per day from m3/s and km2."""
    return df.withColumn("runoff_mm_d", F.try_divide(F.col(value), F.col(area_km2)) * 86400 / 1e6 * 1e3)


def with_calendar(df: DataFrame, date: str = DATE, value: str = VALUE) -> DataFrame:
    return df.withColumns(
        {
            "day": F.dayofmonth(date),
            "jday": F.dayofyear(date),
            "year_cal": F.year(date),
            "month_cal": F.month(date),
            "year_wy": calendar.water_year(date),
            "season_flow": calendar.season(date, "flow"),
            "month_wy": calendar.water_month(date, value),
        }
    )


def nonnegative(df: DataFrame, value: str = VALUE) -> DataFrame:
    """Negative flow is not a flow: make it missing."""
    return df.withColumn(value, F.when(F.col(value) >= 0, F.col(value)))


def flow_statistics(
    df: DataFrame, keys: Sequence[str], date: str = DATE, value: str = VALUE, with_months: bool = False
) -> DataFrame:
    """Period, completeness, quantiles and variation of a flow series per group.

    `with_months` adds the first and last month with data and whether the series covers the whole year.
    """
    observed = F.when(F.col(value).isNotNull(), F.col(date))
    extra = [F.min(F.month(observed)).alias("mo_from"), F.max(F.month(observed)).alias("mo_to")]
    base = df.groupBy(*keys).agg(
        F.min(F.year(observed)).alias("min_yr"),
        F.max(F.year(observed)).alias("max_yr"),
        F.min(observed).alias("min_date"),
        F.max(observed).alias("max_date"),
        F.count(value).alias("count_flow"),
        count_missing(value).alias("count_na_flow"),
        F.min(value).alias("min"),
        F.avg(value).alias("mean"),
        F.max(value).alias("max"),
        F.try_divide(F.stddev_samp(value), F.avg(value)).alias("cv"),
        *(extra if with_months else []),
    )
    base = base.withColumn("total_days", calendar.span_days("min_date", "max_date"))
    base = base.withColumn(
        "perc_missing", percent(F.col("total_days") - F.col("count_flow"), F.col("total_days"), 1)
    )
    if with_months:
        whole_year = (F.col("mo_from") == 1) & (F.col("mo_to") == 12)
        base = base.withColumn(
            "seasonal_flag", F.when(whole_year, F.lit("Continuous")).when(~whole_year, F.lit("Seasonal"))
        )
    quantiles = grouped_quantiles(df, keys, value, {"q10": 0.1, "median": 0.5, "q90": 0.9})
    return join_same(base, quantiles, list(keys))


def overall_statistics(df: DataFrame, station: str = STATION, date: str = DATE, value: str = VALUE) -> DataFrame:
    return flow_statistics(df, [station], date, value)


def annual_statistics(df: DataFrame, station: str = STATION, date: str = DATE, value: str = VALUE) -> DataFrame:
    yearly = df.withColumn("year", F.year(date))
    return flow_statistics(yearly, [station, "year"], date, value, with_months=True).drop("min_yr", "max_yr")


def gauge_daily_mean(
    readings: DataFrame, site: str = "site", time: str = "reading_time", value: str = "flow_cms"
) -> DataFrame:
    """Daily mean per site; a day with one missing reading is dropped."""
    return (
        readings.groupBy(site, F.to_date(time).alias(DATE))
        .agg(strict(F.avg, value).alias(VALUE))
        .where(F.col(VALUE).isNotNull())
    )


def gauge_station_codes(
    daily: DataFrame, site: str = "site", codes: tuple[Mapping[str, str], str] = GAUGE_SITE_STATIONS
) -> DataFrame:
    known, other = codes
    return daily.select(DATE, VALUE, recode(site, known, F.lit(other)).alias(STATION))


def synthetic_station(
    flow: DataFrame, name: str, upstream_total: str, minus: str,
    station: str = STATION, date: str = DATE, value: str = VALUE,
) -> DataFrame:
    """A station whose flow is one station minus another on the same day, NULL if either is missing.

    Stays in long form: the two stations meet in one grouped sum instead of a pivot of all stations.
    """
    both = flow.where(F.col(station).isin(upstream_total, minus))

    def of(code: str):
        return F.max(F.when(F.col(station) == code, F.col(value)))

    return both.groupBy(date).agg((of(upstream_total) - of(minus)).alias(value)).select(
        F.col(date), F.lit(name).alias(station), F.col(value)
    )


def flow_wide(
    flow: DataFrame, stations: Sequence[str], station: str = STATION, date: str = DATE, value: str = VALUE
) -> DataFrame:
    """One column per listed station."""
    return flow.groupBy(date).pivot(station, list(stations)).agg(F.max(value))


def add_station_columns(wide: DataFrame, more: DataFrame, date: str = DATE) -> DataFrame:
    """More station columns by date; only the dates of `wide` are kept."""
    return join_same(wide, more, [date])


def flow_long(
    wide: DataFrame, stations: Sequence[str], station: str = STATION, date: str = DATE, value: str = VALUE
) -> DataFrame:
    """Back to one row per (date, station); days without flow stay, as NULL."""
    return wide.unpivot([date], [F.col(f"`{s}`") for s in stations], station, value)


def flow_grid(
    flow: DataFrame, stations: Sequence[str], station: str = STATION, date: str = DATE, value: str = VALUE
) -> DataFrame:
    """The full (observed date x listed station) table, missing flows as NULL.

    The same rows as `flow_wide` followed by `flow_long`, without one aggregate per station.
    """
    listed = flow.where(F.col(station).isin(list(stations)))
    grid = listed.select(date).distinct().withColumn(station, F.explode(F.array(*[F.lit(s) for s in stations])))
    measured = listed.groupBy(date, station).agg(F.max(value).alias(value))
    return join_same(grid, measured, [date, station])


def assemble_flow(
    archive: DataFrame,
    estimated: DataFrame,
    spring: DataFrame,
    gauges: DataFrame,
    archive_stations: Sequence[str],
    estimated_stations: Sequence[str],
    synthetic: tuple[str, str, str] = SYNTHETIC_FLOW_STATION,
) -> DataFrame:
    """All flow sources in one long table (date, station, value).

    Archive and estimated stations and the synthetic one are given for every date of the archive, missing
    flows as NULL; spring and gauge series are appended as they are.
    """
    columns = [DATE, STATION, VALUE]
    dates = archive.where(F.col(STATION).isin(list(archive_stations))).select(DATE).distinct()
    on_dates = estimated.where(F.col(STATION).isin(list(estimated_stations))).join(dates, DATE, "left_semi")
    measured = union_all(archive.select(*columns), on_dates.select(*columns))
    name, total, minus = synthetic
    derived = synthetic_station(measured, name, total, minus)
    stations = [*archive_stations, *estimated_stations, name]
    grid = flow_grid(union_all(measured, derived.select(*columns)), stations)
    return union_all(grid, spring.where(F.col(VALUE).isNotNull()).select(*columns), gauges.select(*columns))


def daily_spine(
    df: DataFrame, keys: Sequence[str], date: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Every day per group, from its first to its last date or between fixed SQL date expressions."""
    bounds = df.groupBy(*keys).agg(F.min(date).alias("_first"), F.max(date).alias("_last"))
    days = f"explode(sequence({first or '_first'}, {last or '_last'}, interval 1 day))"
    return bounds.where("_first is not null").select(*keys, F.expr(days).alias(date))


def fill_days(
    df: DataFrame, keys: Sequence[str], date: str = DATE, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Add a row of NULLs for every missing day; all given rows stay, also those outside the range.

    The anti join meets each (group, day) at most once on either side, so a day reported many times does
    not concentrate work.
    """
    present = df.select(*keys, date).distinct()
    missing = join_same(daily_spine(df, keys, date, first, last), present, [*keys, date], "left_anti")
    return df.unionByName(missing, allowMissingColumns=True)
