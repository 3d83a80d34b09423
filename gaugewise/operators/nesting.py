"""Rows of a group as lists of structs, in pages of bounded length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGE_ROWS = 1000
SLOTS = 1024  # a group's entries are numbered inside so many parts of it


def numbered_entries(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Different rows of each group with their number of copies (`n_rows`) and an ordinal from 0 (`_ordinal`).

    Equal rows become one before anything is numbered. A group is dealt into `SLOTS` parts; rows are numbered
    inside a part, behind the sizes of the parts before it: no window sees a whole group.
    """
    others = [c for c in df.columns if c not in keys]
    entries = df.groupBy(F.struct(*keys).alias("_key"), *others).agg(F.count(F.lit(1)).alias("n_rows"))
    slot = F.pmod(F.xxhash64(*others), F.lit(SLOTS)) if others else F.lit(0)
    entries = entries.withColumn("_slot", slot.cast("int"))
    sizes = entries.groupBy("_key", "_slot").agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.selectExpr("_key", "_slot", "sum(_size) over (partition by _key order by _slot) - _size as _start")
    order = ", ".join(f"`{c}`" for c in others) or "n_rows"
    inside = entries.withColumn("_inside", F.expr(f"row_number() over (partition by _key, _slot order by {order}) - 1"))
    placed = inside.join(starts, ["_key", "_slot"]).withColumn("_ordinal", F.col("_start") + F.col("_inside"))
    return placed.select("_key", *others, "n_rows", "_ordinal")


def nest_rows(df: DataFrame, keys: Sequence[str], page_rows: int = PAGE_ROWS) -> DataFrame:
    """`keys`, `page` (from 0) and `data`: at most `page_rows` different rows of the group, each with its copies.

    A group of any size comes as pages of bounded length; all but the last are full.
    """
    others = [c for c in df.columns if c not in keys]
    page = F.floor(F.col("_ordinal") / page_rows).alias("page")
    pages = numbered_entries(df, keys).groupBy("_key", page).agg(F.collect_list(F.struct(*others, "n_rows")).alias("data"))
    return pages.select("_key.*", "page", "data")
