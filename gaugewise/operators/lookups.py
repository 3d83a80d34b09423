"""Literal tables, and joins in which NULL keys match; computed lookups are left to adaptive execution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 20_000


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table written in code, marked for broadcast; its size is known here and bounded."""
    if len(rows) > MAX_BROADCAST_ROWS:
        raise ValueError(f"{len(rows)} rows are too many for a literal table; read them from a file")
    return F.broadcast(spark.createDataFrame(list(rows), schema))


def same(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str]) -> Column:
    """NULL-safe equality over key lists: NULL keys match each other."""
    condition = None
    for a, b in zip(left_on, right_on, strict=True):
        test = left[a].eqNullSafe(right[b])
        condition = test if condition is None else condition & test
    return condition


def join_same(
    left: DataFrame, right: DataFrame, on: Sequence[str] | dict[str, str], how: str = "left"
) -> DataFrame:
    """NULL-safe join that keeps the left side's key columns; `on` may map left names to right names.

    A full join fills the keys of rows that only the right side has.
    """
    pairs = dict(on) if isinstance(on, dict) else {c: c for c in on}
    renamed = right.withColumnsRenamed({b: f"_r_{b}" for b in pairs.values()})
    joined = left.join(renamed, same(left, renamed, list(pairs), [f"_r_{b}" for b in pairs.values()]), how)
    if how in ("left_semi", "left_anti"):
        return joined
    if how == "full":
        joined = joined.withColumns({a: F.coalesce(F.col(a), F.col(f"_r_{b}")) for a, b in pairs.items()})
    return joined.drop(*[f"_r_{b}" for b in pairs.values()])
