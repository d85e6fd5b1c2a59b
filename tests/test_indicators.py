from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tierflow.functions.numbers import format_value
from tierflow.operators import indicators as ind
from tierflow.plans.indicators import run_indicators

ROW = ("country_code string, country_name string, indicator_code string, indicator_name string,"
       " year int, value double, loaded_at timestamp")


@pytest.fixture
def facts(frame):
    def build(*rows):
        return frame(ROW, *[(c[:3].upper(), c, code, "Name", y, v, datetime(2024, 1, 1, 8, 5))
                            for c, code, y, v in rows])

    return build


@pytest.fixture
def slice_(facts):
    return facts(("Japan", "X", 2020, 100.0), ("Japan", "X", 2021, 110.0),
                 ("Canada", "X", 2021, 50.0), ("Canada", "X", 2020, 50.0),
                 ("France", "X", 2021, 7.0), ("Italy", "X", 2020, 3.0),
                 ("Brazil", "X", 2021, 5.0), ("Brazil", "X", 2020, 0.0))


PAGE = """[{"page":1},[
 {"country":{"value":"Japan"},"countryiso3code":"JPN","date":"2020","value":1.5},
 {"country":{"value":"Chad"},"date":"2021","value":"2"},
 {"country":{"value":"Peru"},"countryiso3code":"PER","date":"2020","value":null},
 {"country":{"value":"Fiji"},"countryiso3code":"FJI","date":"20x5","value":1},
 {"country":{"value":"Mali"},"countryiso3code":"MLI","date":"2020.5","value":1},
 {"country":{"value":"Oman"},"countryiso3code":"OMN","date":"2020","value":"n/a"},
 {"countryiso3code":"ZZZ","date":"2020","value":1}]]"""


def test_flatten(frame):
    pages = frame("key string, body string", ("GDP", PAGE), ("DEBT", '[{"message":"none"}]'),
                  ("DEBT", '[{"page":1},null]'), ("DEBT", "garbage"), ("UNKNOWN", PAGE))
    rows = ind.flatten_payload(pages, datetime(2024, 1, 1)).orderBy("year").collect()
    assert [(r.country_code, r.country_name, r.indicator_code, r.year, r.value) for r in rows] == [
        ("JPN", "Japan", "NY.GDP.MKTP.CD", 2020, 1.5), ("", "Chad", "NY.GDP.MKTP.CD", 2021, 2.0)]


def test_load_full_then_partial(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "GDP.json").write_text(PAGE)
    (pages / "DEBT.1.json").write_text(PAGE)
    first, second = str(tmp_path / "v1"), str(tmp_path / "v2")
    summary = {r.key: r.rows_loaded for r in run_indicators(spark, str(pages), first).collect()}
    assert summary == {"GDP": 2, "DEBT": 2, "INFLATION": 0, "UNEMPLOY": 0, "EXPORTS": 0}
    (pages / "GDP.json").write_text('[{},[{"country":{"value":"Japan"},"date":"2022","value":9}]]')
    partial = run_indicators(spark, str(pages), second, keys=["GDP"], existing=first)
    assert {r.key: r.rows_loaded for r in partial.collect()} == {"GDP": 1}
    assert spark.read.parquet(second).count() == 3  # the other indicator is still there
    preview = run_indicators(spark, str(pages), str(tmp_path / "v3"), dry_run=True)
    assert preview.count() == 3 and not (tmp_path / "v3").exists()


def test_scan_and_slice(facts):
    df = facts(("Japan", "X", 2019, None), ("Japan", "X", 2020, 1.0), ("Chad", "X", 2021, 2.0),
               ("Japan", "Y", 2021, 3.0))
    assert [r.year for r in ind.indicator_scan(df).collect()] == [2021, 2021, 2020]
    assert ind.slice_indicators(df, "X", ["Japan"], 2020, 2021).count() == 1
    assert ind.filter_entities(df).count() == 3  # the default list of countries
    assert ind.select_indicators(df, ["GDP", "NOPE"]).count() == 0


def test_snapshot_uses_the_newest_year_of_the_slice(slice_):
    names = {r.country_name for r in ind.latest_snapshot(slice_.unionAll(slice_)).collect()}
    assert names == {"Japan", "Canada", "France", "Brazil"}  # Italy has no 2021
    assert [r.value for r in ind.compare_latest(slice_).collect()] == [5.0, 7.0, 50.0, 110.0]


def test_year_over_year(slice_):
    rows = {r.country_name: r for r in ind.yoy_snapshot(slice_).collect()}
    assert rows["Japan"].delta_text == "▲ 10.0% YoY" and rows["Japan"].delta == 10.0
    assert rows["Canada"].delta_text == "▼ 0.0% YoY"  # no change points down
    assert rows["France"].delta_text == "—" and rows["France"].delta is None
    assert rows["Brazil"].delta == 5.0 and rows["Brazil"].delta_pct is None  # nothing to divide by
    assert "Italy" not in rows


def test_series_needs_the_year_before(facts):
    df = facts(("Japan", "X", 2018, 1.0), ("Japan", "X", 2020, 2.0), ("Japan", "X", 2021, 3.0))
    got = {r.year: r.delta for r in ind.yoy_series(df).collect()}
    assert got == {2018: None, 2020: None, 2021: 1.0}


def test_pivot(facts):
    df = facts(*[("Japan", "X", y, float(y)) for y in range(2010, 2020)],
               ("Chad", "X", 2019, 1.0), ("Chad", "X", 2019, 3.0))
    rows = {r.country_name: r for r in ind.pivot_recent(df).collect()}
    assert rows["Japan"].__fields__ == ["country_name"] + [str(y) for y in range(2014, 2020)]
    assert rows["Chad"]["2019"] == 2.0 and rows["Chad"]["2014"] is None


def test_facets_and_freshness(slice_):
    got = {(r.facet, r.choice) for r in ind.facets(slice_).collect()}
    assert {("indicator", "X"), ("first_year", "2020"), ("last_year", "2021"),
            ("country", "Italy")} <= got and len(got) == 8
    assert ind.last_updated(slice_).first().last_updated == "01 Jan 2024 08:05 UTC"
    assert ind.last_updated(slice_.filter("false")).first().last_updated == "Unknown"


def test_tables_for_display(slice_):
    assert [r.year for r in ind.trend(slice_).collect()] == [2020] * 4 + [2021] * 4
    table = ind.display_table(slice_, "GDP")
    assert table.columns == ["Country", "Year", "GDP", "Indicator"]
    assert table.first().Country == "Brazil"


def test_preview_and_summary(facts):
    df = facts(*[("Japan", c, y, 1.0) for c in "XY" for y in range(2010, 2016)])
    assert {(r.indicator_code, r.year) for r in ind.preview(df).collect()} == {
        (c, y) for c in "XY" for y in (2013, 2014, 2015)}
    registry = {"A": ("X", "x"), "B": ("Z", "z")}
    assert {r.key: r.rows_loaded for r in ind.load_summary(df, registry).collect()} == {"A": 6, "B": 0}


@pytest.mark.parametrize("value", [0.0, 1.005, 2.675, -3.14159, 999.995, 1234.5, 1235.5, 1e9,
                                   1.239e9, 999_999_999.4, 1e12, 2.5e13, -5e9])
def test_display_texts(spark, value):
    row = spark.range(1).select(
        format_value(F.lit(value), "billions").alias("money"),
        format_value(F.lit(value), "percent").alias("percent")).first()
    expected = (f"${value / 1e12:.2f}T" if value >= 1e12 else f"${value / 1e9:.2f}B"
                if value >= 1e9 else f"${value:,.0f}")
    assert (row.money, row.percent) == (expected, f"{value:.2f}%")
