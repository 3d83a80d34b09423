"""Logarithmic scale for charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugewise.fixed_values import LINEAR_ONLY_VARIABLES
from gaugewise.functions.rules import ColumnOrName, as_col


def log10_or_null(c: ColumnOrName) -> Column:
    """log10 of positive values; zero and negative values have no place on a log axis."""
    v = as_col(c)
    return F.when(v > 0, F.log10(v))


def scaled_value(
    value: ColumnOrName, variable: ColumnOrName, linear_only: Sequence[str] = LINEAR_ONLY_VARIABLES
) -> Column:
    """log10 of the value, except for variables that are already logarithmic."""
    return F.when(as_col(variable).isin(list(linear_only)), as_col(value)).otherwise(log10_or_null(value))
