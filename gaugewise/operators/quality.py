"""Quality checks: duplicates and units."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugewise.operators.lookups import join_same

# columns that `readers.with_position` adds: file, start of the split in it, running number inside the split
INPUT_POSITION = ("_file", "_block", "_row")
DUPLICATE_KEYS = ("station", "sample_date", "variable_name", "measurement_value")


def duplicate_rows(df: DataFrame, keys: Sequence[str] = DUPLICATE_KEYS) -> DataFrame:
    """Every row whose keys occur more than once.

    Keys are counted with partial sums and met again by a semi join, which adaptive execution can split; a
    window over the keys would bring a group of copies into one task.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    return join_same(df, repeated, list(keys), "left_semi")


def keep_first(df: DataFrame, keys: Sequence[str] = DUPLICATE_KEYS, order: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first in the order of `order` (by default all other columns, NULLs first).

    With `order=INPUT_POSITION` on a table from `readers.with_position` it is the first row of the files.
    """
    others = [c for c in df.columns if c not in keys]
    ranked = [*(order or []), *[c for c in others if c not in (order or [])]]
    if not ranked:
        return df.distinct()
    first = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("_first"))
    return first.select(*keys, "_first.*").select(*df.columns)


def later_rows(df: DataFrame, keys: Sequence[str] = DUPLICATE_KEYS, order: Sequence[str] | None = None) -> DataFrame:
    """The rows `keep_first` leaves out, each as often as it occurs."""
    return df.exceptAll(keep_first(df, keys, order))


def unit_report(df: DataFrame) -> DataFrame:
    """Units per variable: how many and which; more than one, or none, is a conflict."""
    pairs = df.select("variable_name", "unit_code").distinct()
    return pairs.groupBy("variable_name").agg(
        F.count("unit_code").alias("n_units"),
        F.array_join(F.array_sort(F.collect_list("unit_code")), ", ").alias("units"),
        F.max(F.col("unit_code").isNull()).alias("has_missing_unit"),
    )


def unit_of(df: DataFrame, variable: str) -> str | None:
    """The unit of a variable; an error when it has none or several."""
    report = unit_report(df.where(F.col("variable_name") == variable)).first()
    if report is None or not report["n_units"]:
        raise ValueError(f"{variable} has no unit")
    if report["n_units"] > 1 or report["has_missing_unit"]:
        missing = " and rows without one" if report["has_missing_unit"] else ""
        raise ValueError(f"{variable} is reported in {report['n_units']} unit(s): {report['units']}{missing}")
    return report["units"]


def unknown_flags(df: DataFrame) -> DataFrame:
    """Results whose flag says neither below, nor detected, nor above the limit."""
    return df.where("detection_condition is null").groupBy("station_name", "variable_name").agg(
        F.count(F.lit(1)).alias("n_unknown")
    )
