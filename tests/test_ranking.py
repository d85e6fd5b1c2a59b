import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tierflow.operators import quality
from tierflow.operators.ranking import Ordering, first_per_key, global_ntile, stored


def check(df, tiles, orders, **limits):
    """Tiles must equal those of a window over the whole table."""
    scored = global_ntile(df, tiles, {f"t{i}": o for i, o in enumerate(orders)}, **limits)
    for i, order in enumerate(orders):
        by = (F.desc_nulls_last if order.descending else F.asc_nulls_first)(order.column)
        scored = scored.withColumn(f"e{i}", F.ntile(tiles).over(Window.orderBy(by, "key")))
    wrong = " OR ".join(f"t{i} <> e{i}" for i in range(len(orders)))
    assert scored.filter(wrong).count() == 0
    return scored


def test_equals_window_when_the_search_narrows(spark):
    df = stored(spark.range(20_000).select(
        F.concat(F.lit("U"), "id").alias("key"),
        F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double").alias("distinct_value"),
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 5).alias("few_values"),
        F.lit(7).alias("one_value"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 1000).alias("with_nulls")), "ntile-test")
    orders = [Ordering("distinct_value", "key"), Ordering("few_values", "key", True),
              Ordering("one_value", "key"), Ordering("with_nulls", "key"),
              Ordering("with_nulls", "key", True)]
    scored = check(df, 3, orders, gather=500, sample=1000)
    sizes = [r["count"] for r in scored.groupBy("t0").count().collect()]
    assert sorted(sizes) == [6666, 6667, 6667]


@pytest.mark.parametrize("rows", [1, 4, 6])
def test_few_rows(spark, rows):
    df = spark.range(rows).select(F.col("id").cast("string").alias("key"),
                                  (F.col("id") % 3).alias("v"))
    check(df, 5, [Ordering("v", "key")])


def test_empty_table(spark):
    df = spark.range(0).select(F.col("id").cast("string").alias("key"), F.col("id").alias("v"))
    assert global_ntile(df, 5, {"tile": Ordering("v", "key")}).count() == 0


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=1, max_size=60),
       tiles=st.integers(1, 4), descending=st.booleans())
def test_sizes_and_order(spark, values, tiles, descending):
    rows = [(f"k{i:03d}", v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "key string, v int")
    scored = check(df, tiles, [Ordering("v", "key", descending)], gather=7, sample=5)
    sizes = [r["count"] for r in scored.groupBy("t0").count().collect()]
    assert max(sizes) - min(sizes) <= 1


def test_repeated_keys_are_reported(spark):
    df = spark.range(1000).select(F.lit("same").alias("key"), F.lit(1).alias("v"))
    with pytest.raises(ValueError, match="not unique"):
        global_ntile(df, 5, {"tile": Ordering("v", "key")}, gather=10, sample=10)


def test_first_per_key(frame):
    df = frame("k string, v int", ("a", 3), ("a", 1), ("a", 2), ("b", 9))
    got = {(r.k, r.v) for r in first_per_key(df, ["k"], [F.asc("v")], 2).collect()}
    assert got == {("a", 1), ("a", 2), ("b", 9)}


def test_helper_columns_clash_with_no_column(frame):
    rows = frame("k string, _n int, _N2 int", ("a", 5, 1), ("a", 3, 2), ("b", 9, 3))
    assert sorted(map(tuple, quality.dedup(rows, ["k"], ["_n"]).collect())) == [("a", 3, 2), ("b", 9, 3)]
    first = first_per_key(rows, ["k"], [F.col("_n")], 1)
    assert first.columns == rows.columns and sorted(map(tuple, first.collect())) == [("a", 3, 2), ("b", 9, 3)]
