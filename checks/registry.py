"""Registration of queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.roles import PRELUDE, Roles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Whole numbers as bigint, fractions rounded, lists as joined text: the same on both sides."""
    columns = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.IntegerType | T.ShortType | T.ByteType):
            col = col.cast("long")
        elif isinstance(field.dataType, T.DoubleType | T.FloatType):
            col = F.round(col, digits)
        elif isinstance(field.dataType, T.ArrayType):
            col = F.array_join(F.transform(col, lambda x: x.cast("string")), ",")
        columns.append(col.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None, ctes: str = "", digits: int = 6):
    """Register a function of `Roles`; `sql` reads the CTEs of `PRELUDE` and of `ctes`."""

    def register(fn: Callable[[Roles], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(Roles(spark, sf_dir)), digits)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = PRELUDE + (f", {ctes.strip()}" if ctes else "") + sql
        return fn

    return register
