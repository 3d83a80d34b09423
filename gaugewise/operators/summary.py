"""Summaries of observations: counts, censoring, coverage, quantiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugewise.functions.rules import n_unique, n_unique_few, percent, strict
from gaugewise.operators.censoring import is_censored
from gaugewise.operators.distribution import quantiles_of_columns, sorted_quantile
from gaugewise.operators.lookups import join_same

SIZE_PARTS, SMALL_ROWS = 1 << 18, 1 << 13
QUANTILES = {"p10": 0.1, "p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.9}


def overview(
    df: DataFrame,
    keys: Sequence[str],
    value: str = "measurement_value",
    substituted: bool = False,
    stations: bool = False,
    flow: bool = False,
    flux: str | None = None,
) -> DataFrame:
    """One row per group.

    Always: rows, period, non-missing values, censored results and their share, the list of censored limits,
    years, months (`count_months` counts rows, as its users expect; `distinct_months` months), min, mean, max, standard deviation and the quantiles of `value`. `substituted` adds the censoring
    state after limit substitution, `stations` the number of stations, `flow` mean and median of the same-day
    flow, `flux` the sum of that column. Dates, `count_lflag2` and the flux sum are NULL when an input is.

    Rows are counted first by `SIZE_PARTS` parts of the groups. Groups of parts of at most `SMALL_ROWS` rows are
    shuffled once, as rows, and summed up where they lie. For the others simple measures combine before the shuffle
    and quantiles come from `quantiles_of_columns`, so that no task holds a large group.
    """
    censored = is_censored()
    n_lflag, n_values = F.count_if(censored), F.count(value)
    measures = [
        F.count(F.lit(1)).alias("count_samples"),
        strict(F.min, "sample_date").alias("min_date"),
        strict(F.max, "sample_date").alias("max_date"),
        n_values.alias("count_values"),
        n_lflag.alias("count_lflag"),
        F.array_sort(F.collect_set(F.when(censored, F.col("measurement_value")))).alias("list_dls"),
        n_unique_few(F.year("sample_date")).alias("count_years"),
        F.count(F.lit(1)).alias("count_months"),
        n_unique_few(F.trunc("sample_date", "MM")).alias("distinct_months"),
        F.min(value).alias("min"),
        F.avg(value).alias("mean"),
        F.max(value).alias("max"),
        F.stddev_samp(value).alias("st_dev"),
    ]
    if substituted:
        n_lflag2 = strict(F.sum, F.col("measurement_flag2").cast("long"))
        measures += [
            percent(n_lflag, F.count("measurement_value")).alias("perc_bdl"),
            n_lflag2.alias("count_lflag2"),
            percent(n_lflag2, n_values).alias("perc_bdl2"),
        ]
    else:
        measures.append(percent(n_lflag, n_values).alias("perc_bdl"))
    if stations:
        measures.append(n_unique("station").alias("count_stns"))
    if flow:
        measures.append(F.avg("daily_flow_cms").alias("mean_flow"))
    if flux:
        measures.append(strict(F.sum, flux).alias("sum_flux"))
    wanted = {value: QUANTILES}
    if flow:
        wanted["daily_flow_cms"] = {"median_flow": 0.5}

    part = F.pmod(F.xxhash64(*keys), F.lit(SIZE_PARTS))
    sizes = df.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # at most one number for each part
    large = F.array_sort(F.collect_list(F.when(F.col("_rows") > SMALL_ROWS, F.col("_part"))))
    n_small, large = sizes.agg(F.count_if(F.col("_rows") <= SMALL_ROWS), large).first()
    if not large:
        return _small_groups(df, keys, measures, wanted)
    if not n_small:
        return _large_groups(df, keys, measures, wanted)
    parts = F.broadcast(df.sparkSession.createDataFrame([(p,) for p in large], "_part long"))
    few = df.join(parts, part == parts["_part"], "left_anti")
    many = df.join(parts, part == parts["_part"], "left_semi")
    return _small_groups(few, keys, measures, wanted).unionByName(_large_groups(many, keys, measures, wanted))


def _large_groups(
    df: DataFrame, keys: Sequence[str], measures: Sequence[Column], wanted: Mapping[str, Mapping[str, float]]
) -> DataFrame:
    return join_same(df.groupBy(*keys).agg(*measures), quantiles_of_columns(df, keys, wanted), list(keys))


def _small_groups(
    df: DataFrame, keys: Sequence[str], measures: Sequence[Column], wanted: Mapping[str, Mapping[str, float]]
) -> DataFrame:
    """The same, with one shuffle of the rows; a group's values are held as a sorted array."""
    lists = [
        F.sort_array(F.collect_list(F.nanvl(F.col(c).cast("double"), F.lit(None)) + F.lit(0.0))).alias(f"_sorted_{c}")
        for c in wanted
    ]
    out = df.repartition(*keys).groupBy(*keys).agg(*measures, *lists)
    quantiles = {
        name: F.expr(sorted_quantile(f"`_sorted_{column}`", p)) for column, probs in wanted.items() for name, p in probs.items()
    }
    return out.withColumns(quantiles).drop(*[f"_sorted_{column}" for column in wanted])
