"""Rank of a year's median within the historical distribution of its group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugewise.fixed_values import CUTOFF_YEAR, NOT_RANKED, RANK_BREAKS, RANK_FLOOR, RANK_LABELS
from gaugewise.functions.rules import as_col
from gaugewise.operators.distribution import KEY, N, VALUE, crowded_groups, quantiles_of_counts, share_at_or_below, value_counts
from gaugewise.operators.lookups import join_same

GROUP = ("station", "variable_name")
HISTORY = {"before": "{year} < {cutoff}", "not_equal": "{year} <> {cutoff}"}


def year_ranks(
    df: DataFrame,
    group: Sequence[str] = GROUP,
    year: str = "year",
    value: str = "measurement_value",
    cutoff_year: int = CUTOFF_YEAR,
    history: str = "before",
    floor: float | None = RANK_FLOOR,
    zero_history_is_missing: bool = True,
    rank_cutoff_year: bool = True,
    strict_median: bool = False,
) -> DataFrame:
    """One row per (group, year): `median`, `n_history` and `perc_bin`.

    `perc_bin` is the share of the historical values at or below the year's median. History is every
    non-missing value of the years before the cutoff, or of all other years (`history="not_equal"`). A share
    of 0 becomes `floor`. With `zero_history_is_missing` a history that is empty or sums to zero gives NULL.
    `strict_median` makes the median of a year with a missing value NULL.

    One counted shuffle of (group, year, value) feeds both the medians and the history.
    """
    counts = value_counts(df, [*group, year], value)
    result = ranks_of_counts(counts, group, year, cutoff_year, history, floor, zero_history_is_missing, rank_cutoff_year)
    if not strict_median:
        return result
    gaps = df.groupBy(*group, year).agg(F.count_if(F.col(value).isNull()).alias("_gaps"))
    blank = {c: F.when(F.col("_gaps") == 0, F.col(c)) for c in ("median", "perc_bin")}
    return join_same(result, gaps, [*group, year]).withColumns(blank).drop("_gaps")


def ranks_of_counts(
    counts: DataFrame,
    group: Sequence[str] = GROUP,
    year: str = "year",
    cutoff_year: int = CUTOFF_YEAR,
    history: str = "before",
    floor: float | None = RANK_FLOOR,
    zero_history_is_missing: bool = True,
    rank_cutoff_year: bool = True,
) -> DataFrame:
    """`year_ranks` of values that are already counted by (group, year)."""
    # one list of crowded groups serves the medians of their years, too
    crowded = crowded_groups(counts, group)
    medians = quantiles_of_counts(counts, {"median": 0.5}, crowded, group)
    if not rank_cutoff_year:
        medians = medians.where(f"not ({KEY}.`{year}` <=> {int(cutoff_year)})")
    group_struct = "named_struct(" + ", ".join(f"'{g}', {KEY}.`{g}`" for g in group) + ")"
    is_history = HISTORY[history].format(year=f"{KEY}.`{year}`", cutoff=int(cutoff_year))
    # a conditional count, not a filter: a filter would reach below the shared shuffle and split it in two
    past = counts.selectExpr(f"{group_struct} as _group", VALUE, f"case when {is_history} then {N} else 0L end as {N}")
    past = past.withColumnRenamed("_group", KEY)
    probes = medians.selectExpr(f"{group_struct} as _group", f"{KEY}.`{year}` as _year", "median").withColumnRenamed(
        "_group", KEY
    )
    ranked = share_at_or_below(past, probes, "median", crowded)
    rank = "_share" if floor is None else f"case when _share = 0 then {float(floor)!r}D else _share end"
    if zero_history_is_missing:
        rank = f"case when _sum <> 0 then {rank} end"
    return ranked.selectExpr(
        *[f"{KEY}.`{g}` as `{g}`" for g in group],
        f"_year as `{year}`",
        "median",
        "_total as n_history",
        f"{rank} as perc_bin",
    )


def percentile_category(rank: Column | str) -> Column:
    """Label of the right-closed bin a rank falls into; 0, NaN and NULL are not ranked."""
    r = as_col(rank)
    label = F.when(r.isNull() | F.isnan(r) | (r <= RANK_BREAKS[0]), F.lit(NOT_RANKED))
    for upper, name in zip(RANK_BREAKS[1:], RANK_LABELS, strict=True):
        label = label.when(r <= upper, F.lit(name))
    return label.otherwise(F.lit(NOT_RANKED))


def attach_ranks(
    df: DataFrame, ranks: DataFrame, group: Sequence[str] = GROUP, year: str = "year", how: str = "left"
) -> DataFrame:
    """Put each year's rank and category on the rows of that year."""
    slim = ranks.select(*group, year, "median", "perc_bin")
    if how == "full":
        return join_same(slim, df, [*group, year], "full").withColumn("percentile", percentile_category("perc_bin"))
    return join_same(df, slim, [*group, year], how).withColumn("percentile", percentile_category("perc_bin"))
