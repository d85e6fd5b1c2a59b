"""Yearly statistics in long form (entity, measure code, year, value)."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierflow.functions.numbers import format_value
from tierflow.operators.ranking import first_per_key, stored
from tierflow.schemas import INDICATOR, PAYLOAD_RECORDS

# Indicator key -> (code, name).
INDICATORS = {
    "GDP": ("NY.GDP.MKTP.CD", "GDP (Current USD)"),
    "INFLATION": ("FP.CPI.TOTL.ZG", "Inflation Rate (%)"),
    "UNEMPLOY": ("SL.UEM.TOTL.ZS", "Unemployment Rate (%)"),
    "EXPORTS": ("NE.EXP.GNFS.ZS", "Exports (% of GDP)"),
    "DEBT": ("GC.DOD.TOTL.GD.ZS", "Government Debt (% of GDP)"),
}

# Display label and value style per code.
DISPLAY = {
    "NY.GDP.MKTP.CD": ("GDP (Current USD)", "billions"),
    "FP.CPI.TOTL.ZG": ("Inflation Rate", "percent"),
    "SL.UEM.TOTL.ZS": ("Unemployment Rate", "percent"),
    "NE.EXP.GNFS.ZS": ("Exports (% of GDP)", "percent"),
    "GC.DOD.TOTL.GD.ZS": ("Government Debt (% of GDP)", "percent"),
}

# ISO-2 codes of the loaded countries.
LOADED_COUNTRIES = ["AR", "AU", "BR", "CA", "CN", "FR", "DE", "IN", "ID", "IT", "JP", "MX",
                    "RU", "SA", "ZA", "KR", "TR", "GB", "US"]

# Names of the displayed countries.
SHOWN_COUNTRIES = ["Canada", "France", "Germany", "Italy", "Japan", "United Kingdom",
                   "United States", "Indonesia"]

Registry = dict[str, tuple[str, str]]


def registry_frame(spark: SparkSession, registry: Registry) -> DataFrame:
    """The in-code registry as a small table."""
    rows = [(key, code, name) for key, (code, name) in registry.items()]
    return spark.createDataFrame(rows, "key string, indicator_code string, indicator_name string")


def select_indicators(df: DataFrame, keys: Iterable[str],
                      registry: Registry = INDICATORS) -> DataFrame:
    """Rows of the named indicators; keys the registry lacks are skipped."""
    codes = [registry[key][0] for key in keys if key in registry]
    return df.filter(F.col("indicator_code").isin(codes))


def flatten_records(body: Column) -> Column:
    """The records of a ``[metadata, [records]]`` text; NULL if it has none."""
    return F.from_json(F.get_json_object(body, "$[1]"), PAYLOAD_RECORDS)


def flatten_payload(payloads: DataFrame, loaded_at: datetime | None = None,
                    registry: Registry = INDICATORS, keep: Iterable[str] = ()) -> DataFrame:
    """Payload rows (key, body) to indicator rows, with the payload columns to ``keep``.

    Records without value, without country or with a bad year or number are
    skipped; so are payloads of keys the registry lacks.
    """
    known = F.broadcast(registry_frame(payloads.sparkSession, registry))  # fixed, a few rows
    stamp = F.lit(loaded_at).cast("timestamp") if loaded_at else F.current_timestamp()
    records = (payloads.join(known, "key")
               .select("indicator_code", "indicator_name", *keep,
                       F.explode(flatten_records(F.col("body"))).alias("r")))
    rows = records.filter(F.col("r.country").isNotNull()).select(
        F.coalesce("r.countryiso3code", F.lit("")).alias("country_code"),
        F.col("r.country.value").alias("country_name"),
        "indicator_code", "indicator_name",
        F.col("r.date").try_cast("int").alias("year"),
        F.col("r.value").try_cast("double").alias("value"),
        stamp.alias("loaded_at"), *keep)
    return rows.filter(F.col("year").isNotNull() & F.col("value").isNotNull())


def indicator_scan(table: DataFrame) -> DataFrame:
    """Rows with a value, newest year first.

    Country and code complete the order, so that a year which holds a large
    part of the rows still spreads over several sort ranges.
    """
    return (table.filter(F.col("value").isNotNull()).select(*INDICATOR.fieldNames())
            .orderBy(F.desc_nulls_last("year"), "country_code", "indicator_code"))


def load_indicators(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The stored indicator table, newest year first."""
    return indicator_scan(spark.read.format(fmt).load(path))


def filter_entities(df: DataFrame, names: Iterable[str] = tuple(SHOWN_COUNTRIES)) -> DataFrame:
    """Rows of the listed countries."""
    return df.filter(F.col("country_name").isin(list(names)))


def slice_indicators(df: DataFrame, code: str, names: Iterable[str], first_year: int,
                     last_year: int) -> DataFrame:
    """One indicator, some countries, years inclusive."""
    return filter_entities(df, names).filter(
        (F.col("indicator_code") == code) & F.col("year").between(first_year, last_year))


def facets(df: DataFrame) -> DataFrame:
    """Filter choices as (facet, choice) rows: codes, countries, year bounds."""
    named = df.select(F.expr(
        "stack(2, 'indicator', indicator_code, 'country', country_name) AS (facet, choice)"))
    years = df.agg(F.min("year").alias("low"), F.max("year").alias("high")).select(F.expr(
        "stack(2, 'first_year', CAST(low AS STRING), 'last_year', CAST(high AS STRING))"
        " AS (facet, choice)"))
    return named.distinct().unionAll(years).orderBy("facet", "choice")


def last_updated(df: DataFrame) -> DataFrame:
    """Newest load time as text, ``Unknown`` for an empty table."""
    newest = F.max("loaded_at")
    text = F.concat(F.date_format(newest, "dd MMM yyyy HH:mm"), F.lit(" UTC"))
    return df.agg(F.coalesce(text, F.lit("Unknown")).alias("last_updated"))


def preview(df: DataFrame, key: str = "indicator_code", n: int = 3) -> DataFrame:
    """At most ``n`` sample rows per key, for a dry run."""
    order = [F.desc_nulls_last("year"), F.asc_nulls_first("country_name"),
             F.asc_nulls_first("country_code"), F.asc_nulls_first("value")]
    return first_per_key(df, [key], order, n)


def load_summary(rows: DataFrame, registry: Registry = INDICATORS) -> DataFrame:
    """Rows per indicator of the registry, 0 where a load brought none."""
    counts = rows.groupBy("indicator_code").agg(F.count(F.lit(1)).alias("n"))
    return (registry_frame(rows.sparkSession, registry).join(counts, "indicator_code", "left")
            .select("key", "indicator_code", F.coalesce("n", F.lit(0)).alias("rows_loaded")))


def _first_of(condition: Column) -> Column:
    """The smallest (code, value) among the rows of a country that qualify."""
    return F.min(F.when(condition, F.struct("country_code", "value")))


def _yearly(df: DataFrame) -> tuple[DataFrame, Column]:
    """One (code, value) per country and year, and the newest year of all of them.

    The rows are written, so that the source is read once for both; repeats combine map-side.
    """
    rows = stored(df.groupBy("country_name", "year").agg(_first_of(F.lit(True)).alias("row")), "yearly")
    return rows, rows.agg(F.max("year")).scalar()


def latest_snapshot(df: DataFrame) -> DataFrame:
    """One row per country for the newest year of the whole slice; a country
    without that year is absent."""
    rows, newest = _yearly(df)
    return (rows.filter(F.col("year") == newest)
            .select("country_name", "row.country_code", "year", "row.value"))


def yoy_snapshot(df: DataFrame, style: str = "billions") -> DataFrame:
    """Snapshot compared with exactly the year before, ready to display.

    Both years come from one scan of the source: the newest and the previous
    value of a country are two conditional aggregates of its yearly rows.
    """
    rows, newest = _yearly(df)
    age = newest - F.col("year")
    both = (rows.filter(F.col("country_name").isNotNull() & age.isin(0, 1))
            .groupBy("country_name")
            .agg(F.max(F.when(age == 0, F.col("year"))).alias("year"),
                 F.max(F.when(age == 0, F.col("row"))).alias("now"),
                 F.max(F.when(age == 1, F.col("row"))).alias("before"))
            .filter(F.col("now").isNotNull()))
    value, previous = F.col("now.value"), F.col("before.value")
    delta = value - previous
    percent = F.try_divide(delta, previous) * 100
    arrow = F.when(delta > 0, "▲").otherwise("▼")
    text = F.concat(arrow, F.lit(" "), F.replace(F.format_number(F.abs(percent), 1), F.lit(","),
                                                 F.lit("")), F.lit("% YoY"))
    return both.select(
        "country_name", "year", value.alias("value"), previous.alias("previous_value"),
        delta.alias("delta"), percent.alias("delta_pct"),
        format_value(value, style).alias("value_text"),
        F.coalesce(text, F.lit("—")).alias("delta_text"))


def yoy_series(df: DataFrame) -> DataFrame:
    """Change against the year before, for all years.

    Averaging repeats first (map-side) leaves one row per year, so no window
    group is longer than the number of years.
    """
    yearly = (df.groupBy("country_name", "indicator_code", "year")
              .agg(F.avg("value").alias("value")))
    window = Window.partitionBy("country_name", "indicator_code").orderBy("year")
    before = F.when(F.lag("year").over(window) == F.col("year") - 1, F.lag("value").over(window))
    delta = F.col("value") - F.col("previous_value")
    return (yearly.withColumn("previous_value", before)
            .withColumn("delta", delta)
            .withColumn("delta_pct", F.try_divide(F.col("delta"), F.col("previous_value")) * 100))


def pivot_recent(df: DataFrame, n: int = 6) -> DataFrame:
    """Mean value per country with the last ``n`` years as columns.

    The driver learns only those ``n`` years, which also spares the pivot its
    own pass for the column list.
    """
    newest = (df.select("year").filter(F.col("year").isNotNull()).distinct()
              .orderBy(F.desc("year")).limit(n).collect())
    years = sorted(row.year for row in newest)
    return (df.filter(F.col("year").isin(years))
            .groupBy("country_name").pivot("year", years).agg(F.avg("value")))


def compare_latest(df: DataFrame) -> DataFrame:
    """The snapshot, smallest value first."""
    return latest_snapshot(df).orderBy(F.asc_nulls_last("value"), "country_name")


def trend(df: DataFrame) -> DataFrame:
    """The slice in time order."""
    return (df.select("country_name", "indicator_code", "year", "value")
            .orderBy("year", "country_name", "indicator_code"))


def display_table(df: DataFrame, label: str) -> DataFrame:
    """The slice as a table for people; ``label`` heads the value column."""
    return (df.select("country_name", "year", "value", "indicator_name")
            .orderBy("country_name", "year")
            .withColumnsRenamed({"country_name": "Country", "year": "Year",
                                 "value": label, "indicator_name": "Indicator"}))


def formatted_values(df: DataFrame) -> DataFrame:
    """Values with both display styles."""
    return df.select("country_name", "indicator_code", "year",
                     format_value("value", "billions").alias("as_money"),
                     format_value("value", "percent").alias("as_percent"))
