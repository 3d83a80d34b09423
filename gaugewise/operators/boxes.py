"""Box statistics per group: hinges, whiskers within 1.5 inter-quartile ranges, and the rows beyond."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugewise.functions.scale import scaled_value
from gaugewise.operators.distribution import KEY, N, VALUE, quantiles_of_counts, value_counts
from gaugewise.operators.lookups import join_same

WHISKER_REACH = 1.5
HINGES = {"lower": 0.25, "middle": 0.5, "upper": 0.75}


def log10_counts(counts: DataFrame, linear: str | None = None) -> DataFrame:
    """Counted values on the log10 scale; those without a logarithm are left out.

    `linear` is a condition on the packed key for groups that keep their values.
    """
    scaled = f"case when {VALUE} > 0 then log10({VALUE}) end"
    if linear:
        scaled = f"case when {linear} then {VALUE} else {scaled} end"
    return counts.withColumn(VALUE, F.expr(scaled)).where(f"{VALUE} is not null")


def _fenced(counts: DataFrame) -> DataFrame:
    """Counted values of each group with the group's hinges and whether they lie beyond the fences."""
    reach = f"{WHISKER_REACH}D * (upper - lower)"
    return counts.join(quantiles_of_counts(counts, HINGES), KEY).withColumn(
        "_outside", F.expr(f"{VALUE} < lower - {reach} or {VALUE} > upper + {reach}")
    )


def box_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per group: n, whisker ends, hinges, number of outliers."""
    return boxes_of_counts(value_counts(df, keys, value))


def boxes_of_counts(counts: DataFrame) -> DataFrame:
    """`box_stats` of counted values."""
    inside = f"case when not _outside then {VALUE} end"
    return (
        _fenced(counts)
        .groupBy(KEY, *HINGES)
        .agg(
            F.sum(N).alias("n"),
            F.expr(f"least(lower, min({inside}))").alias("ymin"),
            F.expr(f"greatest(upper, max({inside}))").alias("ymax"),
            F.expr(f"sum(case when _outside then {N} else 0L end)").alias("n_outliers"),
        )
        .select(f"{KEY}.*", "n", "ymin", *HINGES, "ymax", "n_outliers")
    )


def box_outliers(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Values beyond the fences with the number of times they occur."""
    return outliers_of_counts(value_counts(df, keys, value))


def layers_of_counts(counts: DataFrame) -> DataFrame:
    """Boxes and outliers of counted values in one pass, told apart by `layer`.

    Every value goes into its group's box, and one beyond the fences into a row of its own as well: `middle` is
    its place and `n` the number of times it occurs.
    """
    inside = f"case when not _outside then {VALUE} end"
    of_box = "layer = 'box'"
    rows = _fenced(counts).selectExpr(
        "*", "explode(case when _outside then array('box', 'outlier') else array('box') end) as layer"
    )
    rows = rows.withColumn("_place", F.expr(f"case when layer = 'outlier' then {VALUE} end"))
    hinges = [F.expr(f"case when {of_box} then {h} end").alias(h) for h in HINGES]
    return (
        rows.groupBy(KEY, "layer", "_place", *HINGES)
        .agg(
            F.sum(N).alias("n"),
            F.expr(f"case when {of_box} then least(lower, min({inside})) end").alias("ymin"),
            F.expr(f"case when {of_box} then greatest(upper, max({inside})) end").alias("ymax"),
            F.expr(f"case when {of_box} then sum(case when _outside then {N} else 0L end) end").alias("n_outliers"),
        )
        .select(f"{KEY}.*", "layer", "n", "ymin", "ymax", "n_outliers", "_place", *hinges)
        .withColumn("middle", F.coalesce("middle", "_place"))
        .drop("_place")
    )


def outliers_of_counts(counts: DataFrame) -> DataFrame:
    """`box_outliers` of counted values."""
    beyond = _fenced(counts).where("_outside").groupBy(KEY, VALUE).agg(F.sum(N).alias("n"))
    return beyond.select(f"{KEY}.*", F.col(VALUE).alias("outlier"), "n")


def log_box_stats(df: DataFrame, keys: Sequence[str], value: str, variable: str = "variable_name") -> DataFrame:
    """Boxes on the log10 scale; values that have no logarithm are counted in `n_nonpositive`."""
    scaled = df.withColumn("_scaled", scaled_value(value, variable))
    lost = scaled.groupBy(*keys).agg(
        F.count_if(F.col(value).isNotNull() & F.col("_scaled").isNull()).alias("n_nonpositive")
    )
    return join_same(lost, box_stats(scaled, keys, "_scaled"), list(keys))
