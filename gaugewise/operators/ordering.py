"""Columns whose values have an order of their own, and tables sorted by it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugewise.fixed_values import CONCENTRATION_PANELS, DETECTION_CONDITIONS, MONTHS, SEASON_ORDER

DOMAINS: dict[str, Sequence[str]] = {
    "month_abb": MONTHS,
    "season": SEASON_ORDER,
    "detection_condition": DETECTION_CONDITIONS,
    "facet_title": CONCENTRATION_PANELS,
}


def category_rank(column: str, order: Sequence[str]) -> Column:
    """Position of a value in its category order; NULL for values outside it."""
    return F.nullif(F.array_position(F.array(*[F.lit(x) for x in order]), F.col(column)), F.lit(0)).cast("int")


def with_category_ranks(df: DataFrame, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """`<column>_rank` for each ordered column, for readers that sort or fill in categories themselves."""
    return df.withColumns({f"{column}_rank": category_rank(column, order) for column, order in domains.items()})


def in_order(df: DataFrame, columns: Sequence[str], domains: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """The table sorted as a whole: ordered columns by their categories, all others by value.

    Values outside a category order come after it, by value; missing values come last. The sort deals ranges of
    rows to tasks, so a frequent category is split by the columns after it.
    """
    domains = DOMAINS if domains is None else domains
    keys = []
    for column in columns:
        if column in domains:
            keys.append(F.asc_nulls_last(category_rank(column, domains[column])))
        keys.append(F.asc_nulls_last(column))
    return df.orderBy(*keys)


def sorted_flow(flow: DataFrame, station: str = "flow_station_number", date: str = "date") -> DataFrame:
    """The flow table by station and date."""
    return in_order(flow, [station, date], {})


def month_counts(obs: DataFrame, keys: Sequence[str] = (), month: str = "month_abb") -> DataFrame:
    """Samples by month and `keys`, every month of the year present, in the order of the year.

    A month without samples counts 0 for every key that has samples in another month.
    """
    counts = obs.groupBy(*keys, month).agg(F.count(F.lit(1)).alias("n_samples"))
    named = counts.where(F.col(month).isNotNull())
    months = F.explode(F.array(*[F.lit(m) for m in MONTHS])).alias(month)
    grid = named.select(*keys).distinct().select(*keys, months) if keys else named.limit(1).select(months)
    zero = grid.withColumn("n_samples", F.lit(0).cast("long"))
    full = counts.unionByName(zero).groupBy(*keys, month).agg(F.sum("n_samples").alias("n_samples"))
    return in_order(full.withColumn("month_rank", category_rank(month, MONTHS)), [*keys, month], {month: MONTHS})
