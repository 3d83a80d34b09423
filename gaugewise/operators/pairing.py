"""Every row of one table with every row of another, as an equality join of dealt blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCKS = 8  # a side: each row is copied so many times, and pairs are spread over the square of it


def _dealt(df: DataFrame) -> Column:
    return F.pmod(F.xxhash64(*df.columns), F.lit(BLOCKS)).cast("int")


def with_every(left: DataFrame, right: DataFrame) -> DataFrame:
    """All pairs of rows of two tables without common columns, for grids of names.

    Left rows are dealt to block rows and copied into all block columns, right rows the other way round, so each
    pair meets in exactly one block. No side is gathered: a task holds the pairs of one block, and where one side
    is small adaptive execution broadcasts it.
    """
    every = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1)))
    rows = left.withColumn("_block_row", _dealt(left)).withColumn("_block_column", every)
    columns = right.withColumn("_block_column", _dealt(right)).withColumn("_block_row", every)
    return rows.join(columns, ["_block_row", "_block_column"]).drop("_block_row", "_block_column")
