"""Conditions that a table must meet, counted while it is written; nothing is published if one fails."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gaugewise.sources.layout import remove_folder, table_folder


STAGED = "__staged"  # ending of a table's name until it is published


@dataclass(frozen=True)
class Gate:
    """Metrics of one pass over a table, and what they say: a message if the table must not be published."""

    metrics: Mapping[str, Column]
    problem: Callable[[Mapping[str, Any]], str | None]


class GateError(ValueError):
    """A table that did not pass; `metrics` holds what was counted."""

    def __init__(self, messages: Sequence[str], metrics: Mapping[str, Any]):
        super().__init__("; ".join(messages))
        self.metrics = dict(metrics)


def no_rows(condition: Column, what: str, example: Column | None = None) -> Gate:
    """No row may meet `condition`; the error gives their exact number and the least `example`."""
    metrics = {"n": F.count_if(condition)}
    if example is not None:
        metrics["first"] = F.min(F.when(condition, example.cast("string")))

    def problem(found: Mapping[str, Any]) -> str | None:
        if not found["n"]:
            return None
        return f"{found['n']} {what}" + (f", the first is {found['first']}" if found.get("first") else "")

    return Gate(metrics, problem)


def matched_flow() -> Gate:
    """Every flow row has a sampling station."""
    missing = F.col("station_name_wq").isNull()
    return no_rows(missing, "flow row(s) of stations without a sampling station", F.col("flow_station_number"))


def single_unit(variable: str) -> Gate:
    """A variable that occurs has one unit, and no row of it lacks one."""
    own = F.col("variable_name") == variable
    unit = F.when(own, F.col("unit_code"))
    metrics = {"least": F.min(unit), "greatest": F.max(unit), "n_missing": F.count_if(own & F.col("unit_code").isNull())}

    def problem(found: Mapping[str, Any]) -> str | None:
        if found["n_missing"]:
            return f"{found['n_missing']} row(s) of {variable} without a unit"
        if found["least"] != found["greatest"]:
            return f"{variable} is reported in several units, among them {found['least']} and {found['greatest']}"
        return None

    return Gate(metrics, problem)


def known_flags(condition: str = "detection_condition") -> Gate:
    """Every result's flag says below, detected or above the limit."""
    return no_rows(F.col(condition).isNull(), "result(s) with an unknown flag", F.col("variable_name"))


def observed(df: DataFrame, gates: Sequence[Gate]) -> tuple[DataFrame, Callable[[], Mapping[str, Any]]]:
    """The table with its gates' metrics attached, and how to read or raise them once it has been written.

    Attach them last: a sort above would run its input a second time to sample it, and count it twice.
    """
    if not gates:
        return df, dict
    seen = Observation()
    names = {(i, m): f"gate_{i}_{m}" for i, gate in enumerate(gates) for m in gate.metrics}
    watched = df.observe(seen, *[gates[i].metrics[m].alias(name) for (i, m), name in names.items()])

    def check() -> Mapping[str, Any]:
        found = seen.get
        messages = [gate.problem({m: found[names[i, m]] for m in gate.metrics}) for i, gate in enumerate(gates)]
        if any(messages):
            raise GateError([m for m in messages if m], found)
        return found

    return watched, check


def publish(
    spark: SparkSession, tables: Mapping[str, DataFrame], gates: Mapping[str, Sequence[Gate]],
    write: Callable[[DataFrame, str, str], None],
) -> None:
    """Write all tables beside their names, then put them in place together.

    `write` gets a table, the name to write it under and the folder to write it to. Each table is written by one
    job, which also counts its gates; `tables` come as they are to lie on disk. If a gate fails, what was written
    goes and every published table stays as it was. A published table is a new version in a folder of its own
    below the warehouse; once the name points to it, the version before goes.
    """
    home = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    staged: dict[str, str] = {}
    try:
        for name, df in tables.items():
            watched, check = observed(df, gates.get(name, ()))
            staged[name] = f"{home}/versions/{name}-{uuid.uuid4().hex}"
            write(watched, name + STAGED, staged[name])
            check()
    except Exception:
        for name, folder in staged.items():
            spark.sql(f"drop table if exists {name}{STAGED}")
            remove_folder(spark, folder)
        raise
    for name, folder in staged.items():
        before = table_folder(spark, name)
        spark.sql(f"drop table if exists {name}")
        spark.sql(f"create table {name} like {name}{STAGED} location '{folder}'")
        if any(c.isPartition for c in spark.catalog.listColumns(name)):
            spark.sql(f"alter table {name} recover partitions")
        spark.sql(f"drop table {name}{STAGED}")  # the name only: its folder is the new version
        if before is not None:
            remove_folder(spark, before)
