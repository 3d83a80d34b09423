"""Bring agency tables to one layout, restrict them, and put them together."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugewise.fixed_values import UNIT_REPAIRS, UNITS
from gaugewise.functions.rules import recode
from gaugewise.schema import CONFORMED_COLUMNS


def with_reach(df: DataFrame, station: str, reaches: tuple[Mapping[str, str], str | None]) -> DataFrame:
    """Add `range`, the reach of a station; stations without an entry get the default reach."""
    known, default = reaches
    return df.withColumn("range", recode(station, known, F.lit(default).cast("string")))


def conform(df: DataFrame, renames: Mapping[str, str], agency: str | Column) -> DataFrame:
    """Rename to the template, add the agency (a name, or a column of the source) and the two columns no source fills, order the columns."""
    return (
        df.withColumnsRenamed(dict(renames))
        .withColumns(
            {
                "agency": agency if isinstance(agency, Column) else F.lit(agency),
                "detection_limit": F.lit(None).cast("double"),
                "flow_cms": F.lit(None).cast("double"),
            }
        )
        .select(*CONFORMED_COLUMNS)
    )


def recode_variables(df: DataFrame, names: Mapping[str, str], column: str = "variable_name") -> DataFrame:
    return df.withColumn(column, recode(column, names))


def standard_units(df: DataFrame, units: Mapping[str, str] = UNITS, column: str = "unit_code") -> DataFrame:
    return df.withColumn(column, recode(column, units))


def upper_names(df: DataFrame, columns: Sequence[str] = ("station", "agency", "range")) -> DataFrame:
    return df.withColumns({c: F.upper(c) for c in columns})


def repair_units(df: DataFrame, rules: Sequence[tuple[str, str, str]] = UNIT_REPAIRS) -> DataFrame:
    """Replace a unit known to be wrong for a variable, for each (variable, wrong, right)."""
    unit = F.col("unit_code")
    repaired: Column | None = None
    for variable, wrong, right in rules:
        test = (F.col("variable_name") == variable) & (unit == wrong)
        repaired = F.when(test, F.lit(right)) if repaired is None else repaired.when(test, F.lit(right))
    return df if repaired is None else df.withColumn("unit_code", repaired.otherwise(unit))


def keep_listed(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def keep_years(df: DataFrame, date: str, first_year: int, last_year: int) -> DataFrame:
    """Rows of the study period, both years included; date bounds so that the scan can skip row groups."""
    low, high = f"{first_year:04d}-01-01", f"{last_year + 1:04d}-01-01"
    return df.where((F.col(date) >= F.lit(low).cast("date")) & (F.col(date) < F.lit(high).cast("date")))


def drop_variable_of_agency(df: DataFrame, variable: str, agency: str) -> DataFrame:
    """Drop one agency's rows of one variable; a row for which the test is unknown is dropped too."""
    return df.where(~((F.col("variable_name") == variable) & (F.col("agency") == agency)))


def exclude(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose value differs from `value`; NULLs go as well."""
    return df.where(F.col(column) != F.lit(value))


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by name; columns a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def replace_variable(df: DataFrame, variable: str, agency: str, replacement: DataFrame) -> DataFrame:
    return union_all(drop_variable_of_agency(df, variable, agency), replacement)


def names_in_both(a: DataFrame, a_column: str, b: DataFrame, b_column: str) -> DataFrame:
    return a.select(F.col(a_column).alias("name")).intersect(b.select(F.col(b_column).alias("name")))


def names_only_in_first(a: DataFrame, a_column: str, b: DataFrame, b_column: str) -> DataFrame:
    return a.select(F.col(a_column).alias("name")).subtract(b.select(F.col(b_column).alias("name")))
