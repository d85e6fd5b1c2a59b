"""Sinks that write each micro-batch to its own folder, so that a batch which is run again adds nothing."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tierflow.operators.quality import split_corrupt
from tierflow.session import path_exists
from tierflow.streaming.sink import AVAILABLE_NOW

BATCH = "batch_id"


def write_once(df: DataFrame, path: str, number: int, fmt: str = "parquet") -> bool:
    """Write the rows of one batch; returns False if this batch had been written before.

    A folder without its success mark is from a run that was stopped, and is replaced.
    """
    target = f"{path}/{BATCH}={number}"
    if path_exists(df.sparkSession, f"{target}/_SUCCESS"):
        return False
    df.write.format(fmt).mode("overwrite").save(target)
    return True


def read_batches(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """All batches of a table, with their number."""
    return spark.read.format(fmt).option("mergeSchema", True).load(path)


def start_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                  trigger: int | str = 30) -> StreamingQuery:
    """Run ``write`` for every batch. A batch is kept while it is written, so that several sinks read it once."""
    def run(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            write(batch, number)
        finally:
            batch.unpersist()

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    writer = writer.trigger(availableNow=True) if trigger == AVAILABLE_NOW \
        else writer.trigger(processingTime=f"{trigger} seconds")
    return writer.start()


def quarantine_stream(parsed: DataFrame, good_path: str, bad_path: str, checkpoint: str,
                      trigger: int | str = 30) -> StreamingQuery:
    """Parsed messages to two tables in one pass: well-formed ones, and malformed ones with their text."""
    def write(batch: DataFrame, number: int) -> None:
        good, bad = split_corrupt(batch)
        write_once(good, good_path, number)
        write_once(bad, bad_path, number)

    return start_batches(parsed, write, checkpoint, trigger)


def late_rows_stream(events: DataFrame, time: str, delay: str, base: str, checkpoint: str,
                     trigger: int | str = 30) -> StreamingQuery:
    """Rows in time to ``base``/on_time, rows behind the watermark to ``base``/late; none is lost.

    The watermark of a batch is the newest time of all batches before it less ``delay``,
    as for Spark's own stateful operators. Each batch leaves its newest time in
    ``base``/marks, so a batch that is run again sees the same watermark. Rows without a
    time are late: no window can take them.
    """
    spark = events.sparkSession

    def watermark(number: int) -> datetime | None:
        if not path_exists(spark, f"{base}/marks"):
            return None
        marks = read_batches(spark, f"{base}/marks").where(F.col(BATCH) < number)
        return marks.agg((F.max("newest") - F.expr(f"INTERVAL {delay}")).alias("t")).first().t

    def write(batch: DataFrame, number: int) -> None:
        limit = watermark(number)
        in_time = F.col(time).isNotNull() if limit is None else F.coalesce(F.col(time) >= F.lit(limit), F.lit(False))
        write_once(batch.where(in_time), f"{base}/on_time", number)
        write_once(batch.where(~in_time).withColumn("watermark", F.lit(limit).cast("timestamp")), f"{base}/late", number)
        write_once(batch.agg(F.max(time).alias("newest")), f"{base}/marks", number)

    return start_batches(events, write, checkpoint, trigger)


def upsert_stream(rows: DataFrame, keys: list[str], order: list[str], path: str, checkpoint: str,
                  trigger: int | str = 30) -> StreamingQuery:
    """Keep the newest row per key of a stream, as one folder of changes per batch.

    Within a batch the row that comes last in ``order`` stays; over batches that of the
    later batch. Read the table with :func:`read_current`.
    """
    others = [c for c in rows.columns if c not in keys]

    def write(batch: DataFrame, number: int) -> None:
        newest = batch.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("r"))
        write_once(newest.select(*keys, "r.*"), path, number)

    return start_batches(rows, write, checkpoint, trigger)


def read_current(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest row per key: changes combine map-side, so a key that changes often stays cheap."""
    changes = read_batches(spark, path)
    others = [c for c in changes.columns if c not in [*keys, BATCH]]
    return (changes.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(BATCH)).alias("r"))
            .select(*keys, "r.*"))
