"""Detection limits: which results are censored, the highest limit per variable, and its substitution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugewise.fixed_values import ABOVE_LIMIT_FLAGS, BELOW_LIMIT_FLAGS, DETECTION_CONDITIONS
from gaugewise.functions.rules import is_member, percent, strict
from gaugewise.operators.lookups import join_same

LIMIT_KEYS = ("agency", "variable_name")


def is_censored(flag: str = "measurement_flag") -> Column:
    return is_member(flag, BELOW_LIMIT_FLAGS)


def flag_censored(df: DataFrame) -> DataFrame:
    """Add `cen_logic`, never NULL."""
    return df.withColumn("cen_logic", is_censored())


def keep_censored(df: DataFrame) -> DataFrame:
    return df.where(F.col("measurement_flag").isin(list(BELOW_LIMIT_FLAGS)))


def censoring_summary(df: DataFrame, keys: Sequence[str] = LIMIT_KEYS) -> DataFrame:
    """Censored results against all results, per group."""
    n_censored, n_total = F.count_if(is_censored()), F.count("measurement_value")
    return df.groupBy(*keys).agg(
        n_censored.alias("n_censored"),
        n_total.alias("n_total"),
        percent(n_censored, n_total, 2).alias("percent_censored"),
        strict(F.min, "sample_date").alias("min_date"),
        strict(F.max, "sample_date").alias("max_date"),
    )


def limit_details(df: DataFrame, keys: Sequence[str] = LIMIT_KEYS) -> DataFrame:
    """Every reported limit with its number of uses and period."""
    return keep_censored(df).groupBy(*keys, "measurement_value").agg(
        F.count(F.lit(1)).alias("n"),
        strict(F.min, "sample_date").alias("min_date"),
        strict(F.max, "sample_date").alias("max_date"),
    )


def highest_limits(details: DataFrame, keys: Sequence[str] = LIMIT_KEYS) -> DataFrame:
    """The highest limit per group; NULL if one of the group's limits is missing."""
    return details.groupBy(*keys).agg(strict(F.max, "measurement_value").alias("max_dl"))


def limit_differences(computed: DataFrame, chosen: DataFrame, keys: Sequence[str] = LIMIT_KEYS) -> DataFrame:
    """Groups whose chosen limit differs from the computed one, or that only one of the two knows."""
    a = computed.select(*keys, F.col("max_dl").alias("computed_max_dl"))
    b = chosen.select(*keys, F.col("max_dl").alias("chosen_max_dl"))
    return join_same(a, b, list(keys), "full").where("not (computed_max_dl <=> chosen_max_dl)")


def substitute_limits(df: DataFrame, limits: DataFrame, keys: Sequence[str] = LIMIT_KEYS) -> DataFrame:
    """Raise results at or below their group's limit to the limit.

    Adds `measurement_flag2` (below the limit, or censored) and `measurement_max_dl_sub` (the value to use).
    Groups without a limit keep their flag and value; a missing value in a group with a limit gives NULL in
    both. A censored result above the limit keeps its value and stays flagged. `limits` must hold one row
    per group.
    """
    marked = limits.select(*keys, F.col("max_dl").alias("_limit"), F.lit(True).alias("_has_limit"))
    at_or_below = F.col("measurement_value") <= F.col("_limit")
    no_limit = F.col("_has_limit").isNull()
    return (
        join_same(df, marked, list(keys))
        .withColumns(
            {
                "measurement_flag2": F.when(no_limit, F.col("cen_logic"))
                .when(at_or_below, F.lit(True))
                .when(~at_or_below, F.col("cen_logic")),
                "measurement_max_dl_sub": F.when(no_limit, F.col("measurement_value"))
                .when(at_or_below, F.col("_limit"))
                .when(~at_or_below, F.col("measurement_value")),
            }
        )
        .drop("_limit", "_has_limit")
    )


def rows_without_limit(df: DataFrame, limits: DataFrame, keys: Sequence[str] = LIMIT_KEYS) -> DataFrame:
    return join_same(df, limits.select(*keys), list(keys), "left_anti")


def _below() -> Column:
    return F.coalesce(F.col("measurement_flag2"), F.lit(False))


def effective_value() -> Column:
    """The value charts use: the substituted one where the result is below its limit."""
    return F.when(_below(), F.col("measurement_max_dl_sub")).otherwise(F.col("measurement_value"))


def detection_condition() -> Column:
    """Below / detected / above the detection limit; NULL for a flag that means none of them."""
    flag = F.col("measurement_flag")
    below, detected, above = DETECTION_CONDITIONS
    return (
        F.when(_below() | flag.isin(list(BELOW_LIMIT_FLAGS)), F.lit(below))
        .when(flag.isNull(), F.lit(detected))
        .when(flag.isin(list(ABOVE_LIMIT_FLAGS)), F.lit(above))
    )


def censoring_before_after(df: DataFrame, keys: Sequence[str] = LIMIT_KEYS) -> DataFrame:
    """Censored share before and after substitution, in one pass over a substituted table."""
    n_values, n_sub = F.count("measurement_value"), F.count("measurement_max_dl_sub")
    before = F.sum(F.col("cen_logic").cast("long"))
    after = strict(F.sum, F.col("measurement_flag2").cast("long"))
    return df.groupBy(*keys).agg(
        n_values.alias("n_before"),
        n_sub.alias("n_after"),
        before.alias("censored_before"),
        after.alias("censored_after"),
        percent(before, n_values).alias("percent_before"),
        percent(after, n_sub).alias("percent_after"),
    )
