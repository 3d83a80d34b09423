"""How tables are stored and joined, gates at write, file order, paging, grids and category order."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from gaugewise import schema
from gaugewise.fixed_values import DRAFT_GUIDELINES, MONTHS
from gaugewise.operators import nesting, pairing
from gaugewise.operators.components import pivot_components, repeated_components
from gaugewise.operators.coverage import combination_counts, task_grid
from gaugewise.operators.lookups import literal_table
from gaugewise.operators.nesting import nest_rows
from gaugewise.operators.ordering import DOMAINS, in_order, month_counts, sorted_flow, with_category_ranks
from gaugewise.operators.pairing import with_every
from gaugewise.operators.quality import INPUT_POSITION, keep_first
from gaugewise.plans.database import register_tables, repair_stored_units
from gaugewise.plans.gates import GateError, known_flags, no_rows, observed, publish, single_unit
from gaugewise.sources.layout import join_bucketed, write_bucketed, write_clustered
from gaugewise.sources.readers import read_delimited, with_position

D = dt.date


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# stored layout


def obs(spark):
    rows = [
        (f"s{k % 40:02d}", "ESCHERICHIA COLI" if k % 50 == 0 else "PH", 2000 + k % 4, D(2000 + k % 4, 1 + k % 12, 1), float(k),
         "mg/L" if k % 50 == 0 and k % 4 == 2 else "x")
        for k in range(4000)
    ]
    return spark.createDataFrame(rows + [(None, "PH", None, None, 1.0, "x")],
        "station_name string, variable_name string, year int, sample_date date, measurement_value double, unit_code string")


def table_files(spark, name):
    return {f: os.path.getmtime(f.removeprefix("file:")) for f in spark.table(name).inputFiles()}


def test_station_query_prunes_partitions_and_row_groups(spark):
    write_clustered(obs(spark), "l_clustered", row_group_bytes=4096)
    query = spark.table("l_clustered").where("year = 2001 and station_name = 's05'")
    plan = plan_of(query)
    assert "PartitionFilters: [isnotnull(year" in plan and "EqualTo(station_name,s05)" in plan
    assert query.count() == sum(1 for k in range(4000) if k % 40 == 5 and k % 4 == 1)
    bounds = spark.table("l_clustered").where("year is not null").groupBy("year", F.col("_metadata.file_path").alias("f"))
    bounds = bounds.agg(F.min("station_name").alias("a"), F.max("station_name").alias("b")).orderBy("year", "a").collect()
    for one, two in zip(bounds, bounds[1:], strict=False):
        assert one.year != two.year or one.b <= two.a  # files of a year hold ranges of stations


def test_unit_repair_rewrites_only_affected_years(spark):
    write_clustered(obs(spark), "l_repaired")
    before, rows = table_files(spark, "l_repaired"), sorted(map(repr, spark.table("l_repaired").collect()))
    rules = [("ESCHERICHIA COLI", "mg/L", "No/100 mL")]
    assert repair_stored_units(spark, "l_repaired", rules) == [2002]
    after = table_files(spark, "l_repaired")
    assert {f for f in before if "year=2002" not in f} == {f for f in after if "year=2002" not in f}
    assert all(before[f] == after[f] for f in before if "year=2002" not in f)
    assert not {f for f in before if "year=2002" in f} & {f for f in after if "year=2002" in f}
    repaired = [r.replace("unit_code='mg/L'", "unit_code='No/100 mL'") for r in rows]
    assert sorted(map(repr, spark.table("l_repaired").collect())) == sorted(repaired)
    assert repair_stored_units(spark, "l_repaired", rules) == []


def test_bucketed_tables_join_in_place(spark):
    left = spark.createDataFrame([("a", D(2000, 1, 1), 1.0), ("a", D(2000, 1, 2), 2.0), (None, D(2000, 1, 1), 3.0), ("b", None, 4.0), ("c", None, 5.0)],
                                 "station string, sample_date date, value double")
    right = spark.createDataFrame([("a", D(2000, 1, 2), 20.0), (None, D(2000, 1, 1), 30.0), ("b", None, 40.0)], "site string, date date, flow double")
    write_bucketed(left, "l_obs", ["station", "sample_date"], 4, ["site", "date"])
    write_bucketed(right, "l_flow", ["site", "date"], 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_bucketed(spark, "l_obs", "l_flow", ["flow"])
        plan = plan_of(joined)
        got = {(r.station, r.sample_date, r.value): r.flow for r in joined.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert got == {("a", D(2000, 1, 1), 1.0): None, ("a", D(2000, 1, 2), 2.0): 20.0, (None, D(2000, 1, 1), 3.0): 30.0,
                   ("b", None, 4.0): 40.0, ("c", None, 5.0): None}


# gates


def test_gate_counts_while_writing(spark, tmp_path):
    df = spark.createDataFrame([("PH", "x", 1), ("PH", "y", 2), ("PH", None, 3), ("Q", "u", 4)], "variable_name string, unit_code string, n int")
    watched, check = observed(df, [no_rows(F.col("n") > 2, "row(s) too large", F.col("n")), single_unit("Q")])
    watched.write.parquet(str(tmp_path / "out"))
    with pytest.raises(GateError, match=r"^2 row\(s\) too large, the first is 3$"):
        check()
    watched, check = observed(df, [single_unit("PH")])
    watched.write.format("noop").mode("overwrite").save()
    with pytest.raises(GateError, match="1 row.s. of PH without a unit"):
        check()
    watched, check = observed(df.where("unit_code is not null"), [single_unit("PH"), single_unit("none")])
    watched.write.format("noop").mode("overwrite").save()
    with pytest.raises(GateError, match="PH is reported in several units, among them x and y"):
        check()
    assert known_flags().problem({"n": 0, "first": None}) is None


def test_nothing_is_published_after_a_failure(spark):
    old, good = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2,)], "x int")
    write = lambda df, name, folder: df.write.mode("overwrite").option("path", folder).saveAsTable(name)
    publish(spark, {"g_one": old, "g_two": old}, {}, write)
    with pytest.raises(GateError):
        publish(spark, {"g_one": good, "g_two": good}, {"g_two": [no_rows(F.col("x") == 2, "row(s) of 2")]}, write)
    assert [spark.table(t).first().x for t in ("g_one", "g_two")] == [1, 1]
    assert not [t.name for t in spark.catalog.listTables() if t.name.endswith("__staged")]
    publish(spark, {"g_one": good, "g_two": good}, {"g_two": [no_rows(F.col("x") == 1, "row(s) of 1")]}, write)
    assert [spark.table(t).first().x for t in ("g_one", "g_two")] == [2, 2]
    home = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
    assert len([v for v in os.listdir(f"{home}/versions") if v.startswith("g_one")]) == 1  # older versions are gone


def test_unmatched_flow_stops_the_catalog_load(spark):
    flow = spark.createDataFrame([(D(2000, 1, 1), 1.0, "F9", None, "n"), (D(2000, 1, 2), 1.0, "F9", None, "n"), (D(2000, 1, 1), 1.0, "F1", "wq", "n")],
                                 "date date, value double, flow_station_number string, station_name_wq string, station_name string")
    guidelines = literal_table(spark, [("s", "v", None, 1.0, "u", "chronic")], schema.GUIDELINES)
    with pytest.raises(GateError, match="2 flow row.s. of stations without a sampling station, the first is F9"):
        register_tables(obs(spark), flow, guidelines, "stopped_")
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("stopped_")]
    register_tables(obs(spark), flow.where("station_name_wq is not null"), guidelines, "loaded_")
    assert spark.table("loaded_daily_flow").count() == 1 and spark.table("loaded_consolidated_data").count() == 4001


# file order


def test_first_row_of_the_files(spark, tmp_path):
    """Three files, read in many splits: the row kept is the first of the first file that has the key."""
    want = {}
    for f in range(3):
        lines = ["key,text"]
        for k in range(3000):
            key = (k * 7919 + f * 31) % 500
            lines.append(f"{key},{'z' if k % 2 else 'a'}{f}-{k}")
            want.setdefault(str(key), lines[-1].split(",")[1])
        (tmp_path / f"part{f}.csv").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = with_position(read_delimited(spark, str(tmp_path), "key string, text string"))
        assert df.rdd.getNumPartitions() > 10
        got = {r.key: r.text for r in keep_first(df, ["key"], INPUT_POSITION).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == want


# grids, pages, order


def test_grid_is_a_join_of_dealt_blocks(spark):
    left = spark.createDataFrame([(k,) for k in range(37)] + [(None,)], "a int")
    right = spark.createDataFrame([(f"n{k}", k) for k in range(23)], "b string, c int")
    pairs = with_every(left, right)
    assert sorted(map(repr, pairs.collect())) == sorted(repr((r)) for r in left.crossJoin(right).collect())
    assert pairs.select("a", "b").distinct().count() == 38 * 23
    rows = spark.createDataFrame([("s1", "v1"), ("s1", "v2"), ("s2", None), (None, "v3")], "station_name string, variable_name string")
    grid = task_grid(rows)
    plan = plan_of(grid)
    assert "collect_set" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert sorted(map(tuple, grid.collect())) == [(s, v) for s in ("s1", "s2") for v in ("v1", "v2", "v3")]
    counts = combination_counts(rows.withColumnRenamed("station_name", "station"))
    assert {(r.station, r.variable_name): r.n for r in counts.collect()}[("s2", "v1")] is None
    assert with_every(left.limit(0), right).count() == 0 and pairing.BLOCKS > 1


@pytest.mark.parametrize("slots", [1, 7, 1024])
def test_pages_are_bounded(spark, monkeypatch, slots):
    monkeypatch.setattr(nesting, "SLOTS", slots)
    rows = [("hot", k, f"t{k}") for k in range(2345)] + [("hot", 5, "t5")] * 9 + [(None, None, None)] * 3 + [("one", 1, "x")]
    df = spark.createDataFrame(rows, "k string, n int, t string").repartition(5)
    pages = nest_rows(df, ["k"], page_rows=100).collect()
    sizes = {}
    for r in pages:
        sizes.setdefault(r.k, {})[r.page] = len(r.data)
    assert sizes["hot"] == {p: 100 for p in range(23)} | {23: 45}
    assert sizes[None] == {0: 1} and sizes["one"] == {0: 1}
    entries = {(r.k, e.n, e.t): e.n_rows for r in pages for e in r.data}
    assert len(entries) == 2345 + 2 and entries[("hot", 5, "t5")] == 10 and entries[(None, None, None)] == 3


def test_category_order(spark):
    df = spark.createDataFrame([(m, k) for k, m in enumerate([*reversed(MONTHS), None, "Smarch", "Jan"])], "month_abb string, k int")
    got = [r.month_abb for r in in_order(df, ["month_abb", "k"]).collect()]
    assert got == ["Jan", "Jan", *MONTHS[1:], "Smarch", None]
    plan = plan_of(in_order(df, ["month_abb", "k"]))
    assert "rangepartitioning" in plan and "SinglePartition" not in plan
    flow = spark.createDataFrame([("b", D(2000, 1, 1)), ("a", D(2001, 1, 1)), ("a", D(2000, 1, 1)), (None, D(1999, 1, 1)), ("a", None)],
                                 "flow_station_number string, date date")
    assert [tuple(r) for r in sorted_flow(flow).collect()] == [
        ("a", D(2000, 1, 1)), ("a", D(2001, 1, 1)), ("a", None), ("b", D(2000, 1, 1)), (None, D(1999, 1, 1))]
    counts = month_counts(spark.createDataFrame([("s", "Mar"), ("s", "Mar"), ("t", "Jan"), ("t", None)], "station string, month_abb string"), ["station"])
    assert [(r.month_abb, r.n_samples) for r in counts.collect()][:13] == [(m, 2 * (m == "Mar")) for m in MONTHS] + [("Jan", 1)]
    ranked = with_category_ranks(spark.createDataFrame([("open water",), ("x",)], "season string"), {"season": DOMAINS["season"]})
    assert [r.season_rank for r in ranked.collect()] == [2, None]


def test_repeated_component_keeps_its_greatest_number(spark):
    rows = [("a", "N", "9"), ("a", "N", "10"), ("a", "N", "<50"), ("a", "K", "1"), ("b", "N", "<5"), ("b", "N", None), ("c", "N", "2.0"), ("c", "N", "2")]
    df = spark.createDataFrame(rows, "id string, parameter string, formatted_result string")
    wide = {r.id: r.N for r in pivot_components(df, ["id"], "parameter", "formatted_result", ["N", "K"]).collect()}
    assert wide == {"a": "10", "b": "<5", "c": "2.0"}
    found = {r.id: (r.n_reports, r.least, r.greatest) for r in repeated_components(df, ["id"], "parameter", "formatted_result", ["N", "K"]).collect()}
    assert found == {"a": (3, 9.0, 10.0), "b": (2, None, None), "c": (2, 2.0, 2.0)}


def test_draft_lines_are_numbers(spark):
    table = literal_table(spark, DRAFT_GUIDELINES, "variable_name_unit string, exposure string, guideline_value double")
    assert table.where("guideline_value > 0").count() == len(DRAFT_GUIDELINES)
