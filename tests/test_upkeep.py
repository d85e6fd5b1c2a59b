"""File skipping by stored bounds, and compaction of small files in place."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks import cases
from tierflow.plans import compaction, upkeep
from tierflow.sources import file_stats
from tierflow.sources.file_stats import Between, equal, read_matching, refresh_file_stats

CARRIERS = ["DHL", "FEDEX", "UPS", "USPS"]
START = datetime(2024, 1, 1)


def rows(df):
    return sorted(df.collect(), key=repr)


@pytest.fixture
def clustered(spark, tmp_path):
    """8000 rows of four carriers and a day, in 64 files by both."""
    df = spark.range(8000).select(
        F.element_at(F.array(*map(F.lit, CARRIERS)), (F.pmod(F.xxhash64("id"), F.lit(4)) + 1).cast("int"))
         .alias("carrier_code"),
        (F.lit(START) + F.make_dt_interval(secs=F.pmod(F.xxhash64("id", F.lit(1)), F.lit(86_400))
                                           .cast("decimal(18,6)"))).alias("event_ts"), "id")
    source, target = str(tmp_path / "plain"), str(tmp_path / "z")
    df.write.parquet(source)
    upkeep.zorder_layout(spark, source, target, ["carrier_code", "event_ts"], files=64)
    return target


def test_files_are_skipped_on_either_column_and_more_on_both(spark, clustered):
    everything = spark.read.parquet(clustered)
    assert refresh_file_stats(spark, clustered, ["carrier_code", "event_ts"]) == len(everything.inputFiles()) == 64
    hours = Between("event_ts", START + timedelta(hours=6), START + timedelta(hours=9))
    opened = {}
    for name, wanted in {"carrier": [equal("carrier_code", "UPS")], "time": [hours],
                         "both": [equal("carrier_code", "UPS"), hours]}.items():
        got = read_matching(spark, clustered, wanted)
        opened[name] = len(got.inputFiles())
        condition = F.lit(True)
        if name != "time":
            condition &= F.col("carrier_code") == "UPS"
        if name != "carrier":
            condition &= F.col("event_ts").between(hours.low, hours.high)
        assert rows(got) == rows(everything.where(condition)) and got.columns == everything.columns
    assert opened["both"] <= 64 // 4 and opened["both"] < opened["carrier"] < 64 and opened["time"] < 64


def test_stats_are_added_for_new_files_only(spark, clustered):
    columns = ["carrier_code", "event_ts"]
    refresh_file_stats(spark, clustered, columns)
    assert refresh_file_stats(spark, clustered, columns) == 0
    new = spark.createDataFrame([("UPS", START, 9000), (None, None, 9001)], spark.read.parquet(clustered).schema)
    new.coalesce(1).write.mode("append").parquet(clustered)
    # The new file has no bounds yet and is opened in any case.
    assert {r.id for r in read_matching(spark, clustered, [equal("carrier_code", "UPS"), equal("event_ts", START)])
            .collect()} >= {9000}
    assert refresh_file_stats(spark, clustered, columns) == 1
    none = read_matching(spark, clustered, [equal("carrier_code", "ZZZ")])
    assert none.collect() == [] and none.columns == new.columns
    assert file_stats.matching_files(spark, clustered, [equal("carrier_code", "ZZZ")]) == []
    stats = spark.read.parquet(f"{clustered}/{file_stats.STATS_FOLDER}")
    assert stats.agg(F.sum("rows"), F.sum("carrier_code.nulls")).first() == (8002, 1)


def test_files_without_values_and_partitions_with_odd_names(spark, tmp_path, frame):
    path = str(tmp_path / "odd names")
    (frame("p string, v int", ("a b:c%d", 1), ("a b:c%d", 2), (None, None), ("x", 7))
     .repartition("p").write.partitionBy("p").parquet(path))
    assert refresh_file_stats(spark, path, ["v"]) == 3
    got = read_matching(spark, path, [Between("v", 1, 5)])
    assert {tuple(r) for r in got.select("p", "v").collect()} == {("a b:c%d", 1), ("a b:c%d", 2)}
    assert len(got.inputFiles()) == 1
    assert len(file_stats.matching_files(spark, path, [Between("v")])) == 2  # not the one with nulls alone
    assert read_matching(spark, path, [Between("p", "x", "x")]).collect()[0].v == 7  # no bounds of p


def files_of(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names
            if f.endswith(".parquet") and compaction.STAGING not in d}


def test_packing_into_bins():
    sizes = {"d/a": 60, "d/b": 50, "d/c": 40, "d/e": 30, "d/big": 500, "x/f": 5, "x/g": 5, "y/alone": 5}
    bins = compaction.pack_files(sizes, 100, 100)
    assert bins == [["d/a", "d/c"], ["d/b", "d/e"], ["x/f", "x/g"]]
    assert compaction.pack_files({"d/a": 200}, 100, 100) == []


def test_only_small_files_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 200_000).coalesce(1).write.parquet(path)
    large = files_of(path)
    for i in range(9):
        spark.range(200_000 + 100 * i, 200_100 + 100 * i).coalesce(1).write.mode("append").parquet(path)
    before, size = files_of(path), max(s.st_size for f, s in files_of(path).items() if f not in large)
    bins = compaction.compact_small_files(spark, path, small=10 * size, target=3 * size)
    after = files_of(path)
    assert len(bins) == 3 and sorted(map(len, bins)) == [3, 3, 3]
    assert {f: s.st_mtime_ns for f, s in after.items() if f in before} == {f: s.st_mtime_ns for f, s in large.items()}
    assert len(after) == 4  # the large one and one file for each bin
    assert rows(spark.read.parquet(path)) == rows(spark.range(200_900))
    assert compaction.compact_small_files(spark, path, small=size // 2, target=3 * size) == []


def test_each_bin_is_a_task_of_its_own(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(12):
        spark.range(1000 * i, 1000 * i + 1000).coalesce(1).write.mode("append").parquet(path)
    size = max(s.st_size for s in files_of(path).values())
    bins = compaction.compact_small_files(spark, path, small=10 * size, target=2 * size)
    tasks = [os.path.basename(f).split("-part-")[1][:5] for f in files_of(path)]
    assert len(bins) == len(tasks) == len(set(tasks)) == 6
    assert rows(spark.read.parquet(path)) == rows(spark.range(12_000))


def test_large_files_are_bounded_in_rows(spark):
    assert [cases.large_files(spark.range(n), 10) for n in (0, 1, 10, 11, 25)] == [1, 1, 1, 2, 3]


def test_partitions_keep_their_files(spark, tmp_path, frame):
    path = str(tmp_path / "parts")
    for i in range(4):
        frame("p string, q int, v int", ("a b", 1, i), ("c", 2, i), (None, 3, i)).coalesce(1) \
            .write.mode("append").partitionBy("p", "q").parquet(path)
    before = rows(spark.read.parquet(path))
    assert len(compaction.compact_small_files(spark, path)) == 3
    assert rows(spark.read.parquet(path)) == before
    assert len(files_of(path)) == 3


def test_a_stopped_run_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for i in range(3):
        spark.range(10 * i, 10 * i + 10).coalesce(1).write.mode("append").parquet(path)
    finish, calls = compaction.finish_compaction, []

    def stop(session, where):
        calls.append(where)
        return finish(session, where) if len(calls) == 1 else 0

    monkeypatch.setattr(compaction, "finish_compaction", stop)
    compaction.compact_small_files(spark, path)  # ends after its journal is written
    assert rows(spark.read.parquet(path)) == rows(spark.range(30)) and len(files_of(path)) == 3
    monkeypatch.undo()
    assert compaction.finish_compaction(spark, path) == 1 and compaction.finish_compaction(spark, path) == 0
    assert rows(spark.read.parquet(path)) == rows(spark.range(30)) and len(files_of(path)) == 1
