"""Exact ranking over a whole table without moving it into one task."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tierflow.functions.names import free_name
from tierflow.session import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: it is computed once,
    its later scans read only the columns they need, and it survives the loss
    of executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Ordering:
    """Order rows by a numeric column, then by a unique key.

    NULLs come first when ascending and last when descending.
    """

    column: str
    key: str
    descending: bool = False

    def _value(self) -> Column:
        return -F.col(self.column) if self.descending else F.col(self.column)

    def position(self) -> Column:
        """A struct that sorts the way the rows are ordered."""
        nulls = F.when(F.col(self.column).isNull(), int(self.descending)).otherwise(
            int(not self.descending))
        return F.struct(nulls.alias("nulls"), self._value().alias("value"),
                        F.col(self.key).alias("key"))

    def after(self, place: Row, df: DataFrame) -> Column:
        """Whether a row comes after the one at ``place``, in plain comparisons
        that Spark compiles (structs would be built and compared per row)."""
        value, key = self._value(), F.col(self.key)
        kinds = {name: df.schema[name].dataType for name in (self.column, self.key)}
        later_key = key.isNotNull() if place.key is None else F.coalesce(
            key > F.lit(place.key).cast(kinds[self.key]), F.lit(False))
        if place.value is None:
            return value.isNull() & later_key if self.descending else value.isNotNull() | later_key
        border = F.lit(place.value).cast(kinds[self.column])
        later = (value > border) | ((value == border) & later_key)
        return F.coalesce(later, F.lit(self.descending))


@dataclass
class _Target:
    """The search for the row at ``rank``: it lies in (low, high]."""

    order: Ordering
    rank: int
    size: int                     # rows in (low, high]
    below: int = 0                # rows up to and including low
    low: Row | None = None
    high: Row | None = None
    tried: list = field(default_factory=list)


def _inside(df: DataFrame, order: Ordering, low: Row | None, high: Row | None) -> Column:
    condition = F.lit(True)
    if low is not None:
        condition = condition & order.after(low, df)
    if high is not None:
        condition = condition & ~order.after(high, df)
    return condition


def _count(condition: Column) -> Column:
    return F.sum(condition.cast("int"))


def _gathered(df: DataFrame, parts: list[tuple[Ordering, Column]],
              picks: Callable[[int, Column, Column], list[Column]]) -> Row:
    """One row with what ``picks`` takes from the sorted positions, and their
    number, of each (order, condition) part.

    Rows of no part are filtered out first, so only the few others reach the
    collecting aggregate, and only the picked positions reach the driver.
    """
    kept = df.filter(reduce(lambda a, b: a | b, [condition for _, condition in parts]))
    lists = kept.agg(*[column for i, (order, condition) in enumerate(parts) for column in (
        F.sort_array(F.collect_list(F.when(condition, order.position()))).alias(f"p{i}"),
        _count(condition).alias(f"n{i}"))])
    return lists.select(*[column for i in range(len(parts))
                          for column in picks(i, F.col(f"p{i}"), F.col(f"n{i}"))]).first()


def _narrow(df: DataFrame, targets: list[_Target], sample: int, round_no: int) -> None:
    """Shrink the range of every target around its expected place.

    A key-hash sample of about ``sample`` rows gives two pivots near the rank;
    counting the rows between them tells in which part the rank really lies, so
    the sample only affects how fast the search ends, never its result.
    """
    scale = 1 << 30
    parts = []
    for t in targets:
        share = min(scale, math.ceil(scale * sample / t.size))
        chance = F.pmod(F.xxhash64(F.col(t.order.key), F.lit(round_no)), F.lit(scale)) < share
        parts.append((t.order, chance & _inside(df, t.order, t.low, t.high)))

    def around(i: int, rows: Column, drawn_rows: Column) -> list[Column]:
        share = (targets[i].rank - targets[i].below) / targets[i].size
        at = F.floor(drawn_rows * share)
        margin = F.ceil(3 * F.sqrt(drawn_rows * share * (1 - share))) + 1
        margin = F.least(margin, F.ceil(drawn_rows / 4))  # so that a pivot lies inside
        return [F.get(rows, (at - margin).cast("int")).alias(f"l{i}"),
                F.get(rows, (at + margin).cast("int")).alias(f"r{i}")]

    drawn = _gathered(df, parts, around)
    counts, pivots = [], []
    for i, t in enumerate(targets):
        left = t.low if drawn[f"l{i}"] is None else drawn[f"l{i}"]
        right = t.high if drawn[f"r{i}"] is None else drawn[f"r{i}"]
        pivots.append((left, right))
        before = _inside(df, t.order, t.low, left) if left is not t.low else F.lit(False)
        counts.append(_count(before).alias(f"b{i}"))
        counts.append(_count(_inside(df, t.order, left, right)).alias(f"m{i}"))
    found = df.agg(*counts).first()

    for i, t in enumerate(targets):
        left, right = pivots[i]
        before, middle, size = found[f"b{i}"], found[f"m{i}"], t.size
        if t.rank <= t.below + before:
            t.high, t.size = left, before
        elif t.rank <= t.below + before + middle:
            t.low, t.high, t.below, t.size = left, right, t.below + before, middle
        else:
            t.low, t.below = right, t.below + before + middle
            t.size = size - before - middle
        t.tried = t.tried + [size] if t.size == size else []
        if len(t.tried) > 5:
            raise ValueError(f"rows are not unique on ({t.order.column}, {t.order.key})")


def rows_at(df: DataFrame, wanted: list[tuple[Ordering, int]], total: int,
            gather: int = 20_000, sample: int = 20_000) -> list[Row]:
    """Positions of the rows at the given 1-based ranks, each in its own order.

    All ranks are searched together: every round is one scan with map-side
    aggregation for all of them, and no row is shuffled or sorted. The last
    step gathers the at most ``gather`` rows left around each rank.
    """
    targets = [_Target(order, rank, total) for order, rank in wanted]
    round_no = 0
    while open_ones := [t for t in targets if t.size > gather]:
        _narrow(df, open_ones, sample, round_no)
        round_no += 1
    parts = [(t.order, _inside(df, t.order, t.low, t.high)) for t in targets]
    return list(_gathered(df, parts, lambda i, rows, _: [
        rows[targets[i].rank - targets[i].below - 1].alias(f"p{i}")]))


def global_ntile(df: DataFrame, tiles: int, scores: dict[str, Ordering],
                 gather: int = 20_000, sample: int = 20_000) -> DataFrame:
    """Add columns equal to ``ntile(tiles)`` over a window on the whole table.

    Only the last row of each tile has to be known. Once those are found, the
    tile of a row is the number of such rows before it, which is a map-side
    expression. ``df`` is scanned several times, so pass a stored table.
    """
    total = df.count()
    if total == 0 or tiles == 1:
        return df.withColumns({name: F.lit(1) for name in scores})
    size, longer = divmod(total, tiles)
    ends = [i * size + min(i, longer) for i in range(1, tiles)]
    wanted = [(order, end) for order in scores.values() for end in ends]
    found = iter(rows_at(df, wanted, total, gather, sample))
    columns = {}
    for name, order in scores.items():
        tile = F.lit(1)
        for _ in ends:
            tile = tile + order.after(next(found), df).cast("int")
        columns[name] = tile
    return df.withColumns(columns)


def first_per_key(df: DataFrame, keys: list[str], order_by: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows per key. The limit is applied inside each task
    before the shuffle, so a hot key costs ``n`` rows per task."""
    window = Window.partitionBy(*keys).orderBy(*order_by)
    place = free_name(df, "_n")
    return df.withColumn(place, F.row_number().over(window)).filter(F.col(place) <= n).drop(place)
