"""Files, layers, upkeep, and the plans Spark makes of them."""

import threading
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow import session
from tierflow.functions.numbers import money_sum
from tierflow.operators.ranking import Ordering, global_ntile
from tierflow.plans import upkeep
from tierflow.plans.commerce import FACT_PARTITIONS
from tierflow.sinks import batch
from tierflow.sources import csv
from tierflow.sources.csv import ingest_all, read_csv_bronze
from tierflow.sources.layers import (commerce_views, count_views, read_layer,
                                     register_layer_views)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(df.collect(), key=repr)


def test_csv_with_and_without_schema(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,price\n1,2.5\n2,\n")
    path = str(tmp_path / "t.csv")
    inferred = read_csv_bronze(spark, path)
    assert dict(inferred.dtypes)["id"] == "int" and inferred.filter("price IS NULL").count() == 1
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("price", T.DoubleType())])
    row = read_csv_bronze(spark, path, schema).first()
    assert row.id == "1" and row._source_file.endswith("t.csv") and row._ingested_at
    swapped = T.StructType(list(reversed(schema.fields)))
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_bronze(spark, path, swapped).collect()


def test_ingest_counts_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id\n1\n2\n")
    (tmp_path / "b.csv").write_text("id\n")
    counts = ingest_all(spark, str(tmp_path), str(tmp_path / "out"), {"a": None, "b": None})
    assert counts == {"a": 2, "b": 0}
    assert read_layer(spark, str(tmp_path / "out"), "a").count() == 2


def test_views_skip_missing_tables(spark, tmp_path, frame):
    frame("a int", (1,), (2,)).write.parquet(str(tmp_path / "silver/orders_fact"))
    made, skipped = register_layer_views(spark, commerce_views(str(tmp_path)))
    assert made == ["silver_orders_fact"] and len(skipped) == 11
    assert count_views(spark, made).first().row_count == 2


def test_overwrite_and_partitions(spark, tmp_path, frame):
    df = frame("purchase_year int, purchase_month int, v int", (2017, 1, 1), (2018, 1, 2),
               (2018, 2, 3), (None, None, 4))
    path = str(tmp_path / "fact")
    for _ in range(2):
        batch.save_partitioned(df, path, FACT_PARTITIONS)
    stored = spark.read.parquet(path)
    assert stored.count() == 4
    pruned = stored.filter("purchase_year = 2018 AND v > 2")
    assert "PartitionFilters: [isnotnull(purchase_year" in plan(pruned)
    assert "PushedFilters: [IsNotNull(v), GreaterThan(v,2)]" in plan(pruned)
    assert [r.v for r in pruned.collect()] == [3]


def test_partial_load_keeps_other_codes(spark, tmp_path, frame):
    old = frame("indicator_code string, value double", ("A", 1.0), ("B", 2.0), (None, 3.0))
    new = frame("indicator_code string, value double", ("A", 9.0))
    assert batch.load_some_indicators(old, new, ["A"], str(tmp_path / "t")) == 3
    assert {r.value for r in spark.read.parquet(str(tmp_path / "t")).collect()} == {9.0, 2.0, 3.0}


def test_new_columns_merge_in(spark, tmp_path, frame):
    path = str(tmp_path / "t")
    old, new = frame("a int", (1,)), frame("a int, b string", (2, "x"))
    batch.append_evolving(old, path)
    batch.append_evolving(new, path)
    expected = {(1, None), (2, "x")}
    assert {tuple(r) for r in batch.read_merged(spark, path).select("a", "b").collect()} == expected
    assert {tuple(r) for r in batch.read_merged(spark, path, new.schema).collect()} == expected
    assert {tuple(r) for r in batch.union_evolving(old, new).collect()} == expected


@pytest.fixture
def many_files(spark, tmp_path):
    df = spark.range(4000).select(
        F.element_at(F.array(*map(F.lit, ["FEDEX", "UPS", "DHL", None])),
                     (F.pmod(F.xxhash64("id"), F.lit(4)) + 1).cast("int")).alias("carrier_code"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.xxhash64("id", F.lit(1)),
                                                          F.lit(86_400))).alias("event_ts"), "id")
    path = str(tmp_path / "many")
    df.repartition(20).write.parquet(path)
    return path


def test_compaction_keeps_rows(spark, tmp_path, many_files):
    target = str(tmp_path / "compact")
    assert upkeep.compact(spark, many_files, target, rows_per_file=1000) == 4
    before, after = spark.read.parquet(many_files), spark.read.parquet(target)
    assert rows(before) == rows(after)
    assert 4 <= len(after.inputFiles()) < len(before.inputFiles())


def test_clustering_keeps_rows_and_separates_files(spark, tmp_path, many_files):
    target = str(tmp_path / "z")
    upkeep.zorder_layout(spark, many_files, target, ["carrier_code", "event_ts"], files=8)
    before, after = spark.read.parquet(many_files), spark.read.parquet(target)
    assert rows(before) == rows(after)
    files = after.groupBy(F.input_file_name()).agg(
        F.min("carrier_code").alias("c0"), F.max("carrier_code").alias("c1"),
        F.min("event_ts").alias("t0"), F.max("event_ts").alias("t1"))
    middle = F.timestamp_seconds(F.lit(1_700_000_000 + 43_200))
    hit = files.filter((F.col("c0") <= "UPS") & (F.col("c1") >= "UPS") & (F.col("t0") <= middle)
                       & (F.col("t1") >= middle))
    assert files.count() == 8 and hit.count() <= 3


def test_inventory(spark, tmp_path, frame):
    there = str(tmp_path / "there")
    frame("t timestamp", (datetime(2024, 1, 1),), (datetime(2024, 1, 2),)).write.parquet(there)
    missing = str(tmp_path / "missing")

    def inventory(*paths):
        found = upkeep.table_inventory(spark, {f"t{i}": (p, "t") for i, p in enumerate(paths)})
        return {r.table_name: (r.found, r.row_count, r.status) for r in found.collect()}

    assert inventory(there) == {"t0": (True, 2, "healthy")}
    assert inventory(there, missing) == {"t0": (True, 2, "degraded"), "t1": (False, 0, "degraded")}
    assert inventory(missing) == {"t0": (False, 0, "down")}


def test_scratch_is_below_the_shared_folder(spark):
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session.settings(spark, {"spark.sql.shuffle.partitions": "3"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_tiles_need_no_shuffle(spark, tmp_path):
    spark.range(100).select(F.col("id").cast("string").alias("key"), F.col("id").alias("v")) \
        .write.parquet(str(tmp_path / "t"))
    scored = global_ntile(spark.read.parquet(str(tmp_path / "t")), 5, {"s": Ordering("v", "key")})
    assert "Exchange" not in plan(scored)


def test_tables_are_loaded_side_by_side(spark, tmp_path, monkeypatch):
    """Each load waits for the other one to begin, so one after the other would not end."""
    both, save = threading.Barrier(2, timeout=60), csv.save_table

    def meet(*args):
        both.wait()
        return save(*args)

    monkeypatch.setattr(csv, "save_table", meet)
    for name, count in (("a", 3), ("b", 5)):
        spark.range(count).write.option("header", True).csv(str(tmp_path / f"{name}.csv"))
    assert csv.ingest_all(spark, str(tmp_path), str(tmp_path / "out"), {"b": None, "a": None}) == {"b": 5, "a": 3}


def test_the_first_error_of_several_jobs_is_raised(spark):
    with pytest.raises(ZeroDivisionError):
        session.at_once(spark, {"fine": lambda: spark.range(3).count(), "broken": lambda: 1 // 0})


def test_money_sums_stay_exact(spark, frame):
    rows = [("a", 0.0001), ("a", -0.0002), ("a", 26843.5456), ("a", None), ("b", None), ("c", -26843.5457),
            *[("d", 9e13)] * 30, ("d", 0.0001), ("e", -9e13), ("e", 9e13), ("e", 0.07)]
    got = frame("k string, v double", *rows).groupBy("k").agg(money_sum("v").alias("s"))
    exact = {k: [round(Decimal(repr(v)), 4) for x, v in rows if x == k and v is not None] for k, _ in rows}
    assert dict(got.collect()) == {k: float(sum(v) * 10_000) / 10_000 if v else None for k, v in exact.items()}
