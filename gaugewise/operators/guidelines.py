"""Guideline bounds: from one row per guideline to one row per bound, and next to the results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugewise.fixed_values import GUIDELINE_BOUNDS, TITLE_WITHOUT_UNIT
from gaugewise.functions.text import panel_title
from gaugewise.operators.lookups import join_same


def guideline_bounds(guidelines: DataFrame, bare_titles: Sequence[str] = TITLE_WITHOUT_UNIT) -> DataFrame:
    """One row per existing bound, named `Lower <exposure>` or `Upper <exposure>`."""
    ids = ["source", "variable_name", "unit_code", "exposure_duration"]
    long = guidelines.unpivot(ids, ["lower_value", "upper_value"], "_side", "guideline_value")
    side = F.when(F.col("_side") == "lower_value", F.lit("Lower ")).otherwise(F.lit("Upper "))
    order = F.array_position(F.array(*[F.lit(b) for b in GUIDELINE_BOUNDS]), F.col("bound"))
    return (
        long.where("guideline_value is not null")
        .withColumn("bound", F.concat(side, F.col("exposure_duration")))
        .withColumns({"bound_rank": F.nullif(order, F.lit(0)), "facet_title": panel_title("variable_name", "unit_code", bare_titles)})
        .drop("_side")
    )


def overlay(results: DataFrame, bounds: DataFrame) -> DataFrame:
    """Each result next to the bounds of its variable and unit; results without a guideline stay."""
    slim = bounds.select("variable_name", "unit_code", "bound", "guideline_value")
    return join_same(results, slim, ["variable_name", "unit_code"])
