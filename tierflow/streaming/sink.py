"""Starting streaming queries, reading their output and their counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tierflow.session import STREAM_SETTINGS, settings

AVAILABLE_NOW = "available_now"


def stream_sink(df: DataFrame, path: str, checkpoint: str, mode: str = "append",
                trigger: int | str = 30, fmt: str = "parquet",
                partitions: int | None = None) -> StreamingQuery:
    """Write a stream to a table; ``checkpoint`` belongs to this query alone.

    ``trigger`` is a number of seconds, or ``AVAILABLE_NOW`` to process what is
    there and stop. ``complete`` mode writes the whole result of each batch as
    a new version; read it with :func:`read_newest_version`. The number of
    state partitions is fixed when a checkpoint is first used: by default the
    session's shuffle partitions, in local mode not more than there are cores.
    """
    spark = df.sparkSession
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        if spark.sparkContext.master.startswith("local"):
            partitions = min(partitions, spark.sparkContext.defaultParallelism)
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger == AVAILABLE_NOW \
        else writer.trigger(processingTime=f"{trigger} seconds")
    with settings(spark, {**STREAM_SETTINGS, "spark.sql.shuffle.partitions": str(partitions)}):
        if mode == "complete":
            def write_version(batch: DataFrame, number: int) -> None:
                batch.write.format(fmt).mode("overwrite").save(f"{path}/version={number}")

            return writer.foreachBatch(write_version).start()
        return writer.format(fmt).option("mergeSchema", True).start(path)


def read_newest_version(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The last full result of a ``complete`` stream."""
    versions = spark.read.format(fmt).load(path)
    return versions.filter(F.col("version") == versions.agg(F.max("version")).scalar()) \
                   .drop("version")


def stream_metrics(query: StreamingQuery) -> dict[str, int]:
    """Input rows, rows dropped as too late, and rows now held in state.

    An aggregation counts late rows after combining them per task and group.
    """
    progress = query.recentProgress
    operators = [op for p in progress for op in p["stateOperators"]]
    last = progress[-1]["stateOperators"] if progress else []
    return {
        "input_rows": sum(p["numInputRows"] for p in progress),
        "dropped_late": sum(op["numRowsDroppedByWatermark"] for op in operators),
        "state_rows": sum(op["numRowsTotal"] for op in last),
    }
