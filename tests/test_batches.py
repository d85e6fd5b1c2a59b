"""Sinks by batch, partial reloads, sketches, buckets and checked CSV."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import cases
from tierflow.operators import kpi_rollup, orders
from tierflow.schemas import CORRUPT
from tierflow.sinks import batch
from tierflow.sources import adapters
from tierflow.sources.csv import read_csv_checked
from tierflow.sources.payloads import payload_stream
from tierflow.streaming import batches
from tierflow.streaming.sink import AVAILABLE_NOW

SF_DIR = "/root/testdata/sf0.001"
NOON = datetime(2024, 1, 1, 12)


def values(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


# --- sinks by batch ----------------------------------------------------------
def parsed(spark, path):
    return spark.readStream.schema(f"v int, {CORRUPT} string").parquet(path)


def test_quarantine_after_a_stop_between_its_two_writes(spark, frame, tmp_path, monkeypatch):
    base = str(tmp_path)
    frame(f"v int, {CORRUPT} string", (1, None), (None, "bad"), (2, None)).write.parquet(f"{base}/in")
    write, calls = batches.write_once, []

    def stop(df, path, number, fmt="parquet"):
        if path.endswith("/bad"):
            raise RuntimeError("stopped")
        calls.append(number)
        return write(df, path, number, fmt)

    def run():
        batches.quarantine_stream(parsed(spark, f"{base}/in"), f"{base}/good", f"{base}/bad", f"{base}/c",
                                  AVAILABLE_NOW).awaitTermination()

    monkeypatch.setattr(batches, "write_once", stop)
    with pytest.raises(Exception, match="stopped"):
        run()
    monkeypatch.undo()
    before = os.stat(f"{base}/good/batch_id=0/_SUCCESS").st_mtime_ns
    run()
    assert calls == [0] and os.stat(f"{base}/good/batch_id=0/_SUCCESS").st_mtime_ns == before  # written once
    assert values(spark.read.parquet(f"{base}/good"), "v") == [(1,), (2,)]
    assert values(spark.read.parquet(f"{base}/bad"), CORRUPT) == [("bad",)]
    frame(f"v int, {CORRUPT} string", (3, None)).write.mode("append").parquet(f"{base}/in")
    run()
    assert values(spark.read.parquet(f"{base}/good"), "v", "batch_id") == [(1, 0), (2, 0), (3, 1)]


def test_unfinished_batch_folders_are_replaced(frame, tmp_path):
    df, path = frame("a int", (1,)), str(tmp_path / "t")
    assert batches.write_once(df, path, 3) and not batches.write_once(df.union(df), path, 3)
    os.remove(f"{path}/batch_id=3/_SUCCESS")
    assert batches.write_once(df.union(df), path, 3)
    assert batches.read_batches(df.sparkSession, path).count() == 2


def test_late_rows_are_kept_and_none_is_lost(spark, frame, tmp_path):
    base, sent = str(tmp_path), []

    def run(*minutes):
        rows = [(len(sent) + i, None if m is None else NOON + timedelta(minutes=m)) for i, m in enumerate(minutes)]
        sent.extend(rows)
        frame("id int, t timestamp", *rows).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema("id int, t timestamp").parquet(f"{base}/in")
        batches.late_rows_stream(stream, "t", "10 minutes", f"{base}/out", f"{base}/c", AVAILABLE_NOW).awaitTermination()

    run(1, 30, None)
    run(2, 25, 20, 60)
    run(49, 50)
    on_time = values(spark.read.parquet(f"{base}/out/on_time"), "id")
    late = values(spark.read.parquet(f"{base}/out/late"), "id", "watermark")
    assert late == [(2, None), (3, NOON + timedelta(minutes=20)), (7, NOON + timedelta(minutes=50))]
    assert sorted([i for i, in on_time] + [i for i, _ in late]) == [i for i, _ in sent]


def test_upserts_keep_the_newest_row_and_read_each_file_once(spark, frame, tmp_path):
    folder, base = tmp_path / "in", str(tmp_path)
    folder.mkdir()

    def run():
        stream = payload_stream(spark, str(folder)).select(
            "key", F.trim("body").alias("body"), "file_time", "file_name")
        query = batches.upsert_stream(stream, ["key"], ["file_time", "file_name"], f"{base}/t", f"{base}/c", AVAILABLE_NOW)
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    (folder / "A.1.json").write_text("old")
    (folder / "A.2.json").write_text("newer")
    os.utime(folder / "A.1.json", (1_700_000_000, 1_700_000_000))
    (folder / "B.json").write_text("b")
    assert run() == 3
    assert values(batches.read_current(spark, f"{base}/t", ["key"]), "key", "body") == [("A", "newer"), ("B", "b")]
    (folder / "A.3.json").write_text("newest")
    assert run() == 1  # the new file alone
    assert run() == 0
    assert values(batches.read_current(spark, f"{base}/t", ["key"]), "key", "body") == [("A", "newest"), ("B", "b")]


# --- partial reload ----------------------------------------------------------
def test_reload_leaves_other_folders_alone(spark, frame, tmp_path):
    path, schema = str(tmp_path / "t"), "indicator_code string, country_code string, value double"
    batch.save_by_code(frame(schema, ("A", "x", 1.0), ("A", "y", 2.0), ("B b", "x", 3.0), ("C", "x", 4.0)), path)

    def times(code):
        folder = f"{path}/indicator_code={code}"
        return {f: os.stat(f"{folder}/{f}").st_mtime_ns for f in os.listdir(folder)}

    before = {c: times(c) for c in ("B b", "C")}
    assert batch.reload_indicators(frame(schema, ("A", "z", 9.0), ("C", "no", 0.0)), ["A"], path) == {"A": 1}
    assert {c: times(c) for c in ("B b", "C")} == before
    assert values(spark.read.parquet(path), "indicator_code", "value") == [("A", 9.0), ("B b", 3.0), ("C", 4.0)]
    assert batch.reload_indicators(frame(schema), ["B b", "D"], path) == {"B b": 0, "D": 0}
    assert values(spark.read.parquet(path), "indicator_code", "value") == [("A", 9.0), ("C", 4.0)]


# --- sketches ----------------------------------------------------------------
def test_merged_sketches_are_within_their_error(spark, tmp_path):
    rng = random.Random(4)
    rows = [("UPS", NOON + timedelta(seconds=i * 3600 / 20_000), int(rng.expovariate(1 / 90)) if i % 7 else None, i % 3 == 0)
            for i in range(20_000)] + [("DHL", NOON, None, None)]
    silver = spark.createDataFrame(rows, "carrier_code string, event_ts timestamp, delay_minutes int, sla_breached boolean")
    kpi_rollup.carrier_sketches(silver).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert stored.count() == 13
    hour = {r.carrier_code: r for r in kpi_rollup.kpis_of_sketches(kpi_rollup.merge_sketches(stored)).collect()}
    known = sorted(r[2] for r in rows if r[2] is not None)
    got = hour["UPS"]
    assert (got.total_events, got.delayed_events) == (20_000, sum(d > 0 for d in known))
    assert got.avg_delay_minutes == pytest.approx(sum(known) / len(known), abs=.06)
    assert got.sla_breach_rate == round(sum(r[3] for r in rows[:-1]) / 20_000, 3)
    rank = lambda side: sum(side(d) for d in known) / len(known)
    low, high = rank(lambda d: d < got.p95_delay_minutes), rank(lambda d: d <= got.p95_delay_minutes)
    assert low - .0165 <= .95 <= high + .0165  # normalised rank error of a sketch of 200
    assert hour["DHL"].p95_delay_minutes is None and hour["DHL"].total_events == 1


# --- buckets -----------------------------------------------------------------
def test_no_shuffle_by_order_id(spark, monkeypatch):
    """Even if no side is broadcast, rows move by customer and product key only."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        fact = cases.CASES["orders_fact_bucketed"](spark, SF_DIR)
        text = fact._jdf.queryExecution().executedPlan().toString()
        shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
        assert shuffles and not any("order_id" in line.split("hashpartitioning(")[1].split(")")[0] for line in shuffles)
        assert text.count("Bucketed: true") == 3 and "BroadcastExchange" not in text
        plain = orders.orders_fact(*[adapters.COMMERCE[n](spark, SF_DIR) for n in (
            "orders", "order_items", "customers", "order_payments", "products", "category_translation")])
        assert values(fact, *sorted(fact.columns)) == values(
            plain.withColumns({c: F.col(c).cast("timestamp_ntz") for c, k in plain.dtypes if k == "timestamp"}),
            *sorted(fact.columns))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# --- checked CSV -------------------------------------------------------------
def test_lines_that_do_not_fit_are_kept(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,price,day\n1,2.5,2024-01-01\nx,3,2024-01-02\n3,4\n5,6,2024-01-03,more\n7,,\n'
                                    '"a,b",1,2024-01-04\n')
    schema = T._parse_datatype_string("id int, price double, day date")
    good, bad = read_csv_checked(spark, str(tmp_path / "t.csv"), schema)
    assert values(good, "id", "price") == [(1, 2.5), (7, None)]
    assert values(bad, CORRUPT, "_reason", "price") == [
        ('"a,b",1,2024-01-04', "value", 1.0), ("3,4", "cells", 4.0), ("5,6,2024-01-03,more", "cells", 6.0),
        ("x,3,2024-01-02", "value", 3.0)]
    # A query of one column judges lines alike.
    assert good.select("price").count() == 2 and good.where("id > 1").select("price").collect()[0].price is None
    assert good.first()._source_file.endswith("t.csv")
