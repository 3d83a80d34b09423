"""Agency files to finished tables, sources and sinks, and the shape of physical plans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gaugewise import fixed_values as fixed
from gaugewise import schema
from gaugewise.operators.lookups import literal_table
from gaugewise.plans.consolidate import AgencyTables, consolidated_observations, finished_observations
from gaugewise.plans.database import register_tables
from gaugewise.plans.observations import observation_view, ordered
from gaugewise.sources import readers, writers

D = dt.date


@pytest.fixture(scope="module")
def tables(spark):
    city = [
        ("1", "Nose Creek Mouth", "6/1/2020 9:30", "NOx (Calculated)", 0.4, None, "0.4", "mg/L"),
        ("2", "Nose Creek Mouth", "6/1/2020 9:30", "Total Kjeldahl Nitrogen (TKN)", 0.2, "<", "<0.2", "mg/L"),
        ("3", "Nose Creek Mouth", "6/1/2018 9:30", "NOx (Calculated)", 0.4, None, "0.4", "mg/L"),
        ("4", "Nose Creek Mouth", "6/1/2020 9:30", "Turbidity", 3.0, None, "3", "NTU"),
        ("5", "Nose Creek Mouth", "6/1/2001 9:30", "Turbidity", 3.0, None, "3", "NTU"),
        ("6", "Elsewhere", "6/1/2020 9:30", "Turbidity", 3.0, None, "3", "NTU"),
        ("7", "Big Hill Creek Mouth", "6/1/2020 9:30", "E.coli", 5.0, "<", "<5", "MPN/100mL"),
    ]
    provincial = [
        ("BOW RIVER, AT CLUNY", "1/5/2010 8:00", "PH (FIELD)", "8.1", None, "PH"),
        ("BOW RIVER, AT CLUNY", "1/5/2010 8:00", "SODIUM ADSORPTION RATIO (CALCD.)", "1", None, "MG/L"),
        ("COAL CREEK, 1/2 MILE WEST OF BOW CITY", "1/5/2010 8:00", "CHLORIDE DISSOLVED", "0.5", "L", "MG/L"),
    ]
    supplement = [("BOW RIVER, AT CLUNY", "1/5/2010 8:00:00", "RESIDUE NONFILTERABLE", "12", None, "MG/L")]
    federal = [
        ("AL05BA0011", "2015-7-1 10:00", "PH", "7", None, "PH"),
        ("AL05BA0011", "2015-7-1 10:00", "PH (FIELD)", "7.5", None, "PH"),
        ("AL05BA0011", "2015-7-1 10:00", "PHOSPHORUS TOTAL", "NR", None, "MG/L"),
        ("OTHER", "2015-7-1 10:00", "PH (FIELD)", "7.5", None, "PH"),
    ]
    supplied = [
        ("BOW RIVER, AT CLUNY", "SODIUM ADSORPTION RATIO (CALCD.)", "2010/01/05 08:00:00", "2010-01-05", "2", None, "rel units"),
        ("BOW RIVER, AT CLUNY", "NITROGEN TOTAL (CALCD.)", "1999/01/05 08:00:00", "1999-01-05", "0.3", None, "mg/L"),
        ("BOW RIVER, AT CLUNY", "TURBIDITY", "2010/01/05 08:00:00", "2010-01-05", "2", None, "NTU"),
    ]
    make = spark.createDataFrame
    return AgencyTables(
        make(city, schema.CITY_SAMPLES), make(provincial, schema.PROVINCIAL_SAMPLES),
        make(supplement, schema.PROVINCIAL_SAMPLES), make(federal, schema.FEDERAL_SAMPLES),
        make(supplied, schema.PROVINCIAL_SUPPLIED),
    )


def test_consolidation(tables):
    rows = {
        (r.station, r.variable_name): (r.agency, r["range"], r.sample_date, r.measurement_value, r.measurement_flag, r.unit_code)
        for r in consolidated_observations(tables).collect()
    }
    city, provincial, federal = fixed.CITY_AGENCY, fixed.PROVINCIAL_AGENCY, fixed.FEDERAL_AGENCY
    assert rows == {
        ("NOSE CREEK MOUTH", "NITROGEN TOTAL (CALCD.)"): (city, "LOWER FOOTHILLS", D(2020, 6, 1), 0.4, None, "mg/L"),
        ("NOSE CREEK MOUTH", "TURBIDITY"): (city, "LOWER FOOTHILLS", D(2020, 6, 1), 3.0, None, "NTU"),
        ("BIG HILL CREEK MOUTH", "ESCHERICHIA COLI"): (city, "UPPER FOOTHILLS", D(2020, 6, 1), 5.0, "<", "MPN/100mL"),
        ("BOW RIVER, AT CLUNY", "PH"): (provincial, "MIDDLE BOW", D(2010, 1, 5), 8.1, None, "pH units"),
        ("COAL CREEK, 1/2 MILE WEST OF BOW CITY", "CHLORIDE DISSOLVED"): (provincial, "LOWER BOW", D(2010, 1, 5), 0.5, "L", "mg/L"),
        ("BOW RIVER, AT CLUNY", "TOTAL SUSPENDED SOLIDS (TSS)"): (provincial, "MIDDLE BOW", D(2010, 1, 5), 12.0, None, "mg/L"),
        ("BOW RIVER AT HIGHWAY 1 ABOVE LAKE LOUISE", "PH"): (federal, "UPPER BOW", D(2015, 7, 1), 7.5, None, "pH units"),
        ("BOW RIVER AT HIGHWAY 1 ABOVE LAKE LOUISE", "PHOSPHORUS TOTAL (P)"): (federal, "UPPER BOW", D(2015, 7, 1), None, None, "mg/L"),
        ("BOW RIVER, AT CLUNY", "SODIUM ADSORPTION RATIO (CALCD.)"): (provincial, "Middle Bow", D(2010, 1, 5), 2.0, None, "rel units"),
        ("BOW RIVER, AT CLUNY", "NITROGEN TOTAL (CALCD.)"): (provincial, "Middle Bow", D(1999, 1, 5), 0.3, None, "mg/L"),
    }


def test_finished_tables_and_catalog(spark, tables):
    limits = literal_table(spark, fixed.CHOSEN_LIMITS, schema.LIMITS)
    lookup = spark.createDataFrame(
        [("BOW RIVER, AT CLUNY", "F1", None, "Bow at Cluny"), ("BIG HILL CREEK MOUTH", "F2", "Hill", "Big Hill u/s mouth")],
        schema.STATION_LOOKUP,
    )
    flow = spark.createDataFrame(
        [(D(2010, 1, 5), "F1", 2.5), (D(2020, 6, 1), "F2", None)], "date date, flow_station_number string, value double"
    )
    obs, named = finished_observations(tables, limits, lookup, flow)
    assert obs.columns == list(schema.OBSERVATION_COLUMNS)
    register_tables(obs, named, literal_table(spark, fixed.GUIDELINES, schema.GUIDELINES), "t_")
    stored = spark.table("t_consolidated_data")
    assert stored.count() == 10
    coli = stored.where("variable_name = 'ESCHERICHIA COLI'").first()
    assert (coli.unit_code, coli.measurement_max_dl_sub, coli.measurement_flag2) == ("No/100 mL", 10.0, True)
    cluny = readers.run_query(
        spark, "select * from t_consolidated_data where station_name = ? and variable_name = ?", ["Bow at Cluny", "PH"]
    ).first()
    assert (cluny.daily_flow_cms, cluny.flow_station_name, cluny.season, cluny.month_abb) == (2.5, None, "Ice", "Jan")
    view = ordered(observation_view(stored, "Bow at Cluny"))
    assert [r.variable_name for r in view.collect()] == sorted(r.variable_name for r in view.collect())
    assert observation_view(stored, "Bow at Cluny", "PH").count() == 1


def test_delimited_round_trip(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('Site Name,"Value, mg",Site Name\n"a, b",NA,x\n,1.5,"NA"\n', encoding="utf-8")
    df = readers.clean_names(readers.read_delimited(spark, str(path)))
    assert df.columns == ["site_name0", "value_mg", "site_name2"] or df.columns[1] == "value_mg"
    assert [tuple(r) for r in df.collect()] == [("a, b", None, "x"), (None, "1.5", None)]
    typed = readers.read_delimited(spark, str(path), "a string, v double, b string", ["a", "v"])
    assert [tuple(r) for r in typed.collect()] == [("a, b", None), (None, 1.5)]
    out = str(tmp_path / "out")
    writers.write_delimited(typed.withColumn("l", F.array(F.lit(1.0), F.lit(2.0))), out)
    back = readers.read_delimited(spark, out)
    assert [tuple(r) for r in back.collect()] == [("a, b", None, "1.0,2.0"), (None, "1.5", "1.0,2.0")]


def test_flow_archive_filters_reach_the_scan(spark, tmp_path):
    rows = [(D(2002, 1, 1), "A", "Flow", 1.0), (D(2002, 1, 2), "A", "Level", 1.0), (D(2001, 1, 1), "A", "Flow", 1.0), (D(2002, 1, 1), "B", "Flow", 1.0)]
    writers.write_parquet(spark.createDataFrame(rows, schema.DAILY_FLOW), str(tmp_path / "flow"))
    df = readers.read_daily_flow(spark, str(tmp_path / "flow"), ["A"], "2002-01-01", "2022-12-31")
    assert [tuple(r) for r in df.collect()] == [(D(2002, 1, 1), "A", 1.0)]
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = readers.read_daily_flow(spark, str(tmp_path / "flow"), ["A"], "2002-01-01", "2022-12-31")
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(parameter,Flow)" in plan and "GreaterThanOrEqual(date" in plan
    stations = spark.createDataFrame([("A", "name", 5.0)], schema.FLOW_STATIONS)
    writers.write_parquet(stations, str(tmp_path / "stations"))
    assert readers.read_flow_stations(spark, str(tmp_path / "stations"), ["A"]).count() == 1


def test_chart_rows_sink(spark, tmp_path):
    df = spark.createDataFrame([("s", "v", 1.0), ("s", "w", 2.0)], "station_name string, variable_name string, x double")
    writers.write_chart_rows(df, str(tmp_path / "charts"))
    assert spark.read.parquet(str(tmp_path / "charts")).count() == 2
    assert (tmp_path / "charts" / "station_name=s" / "variable_name=v").is_dir()


def test_plans_stay_on_the_jvm_and_cross_nothing(spark):
    import __spark_entry__ as entry

    for name, run in entry.queries().items():
        plan = run(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        for node in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert node not in plan, (name, node)


def test_limit_join_is_broadcast(spark):
    from checks.roles import Roles

    plan = Roles(spark, "/root/testdata/sf0.001").substituted()._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
