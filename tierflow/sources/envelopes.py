"""Event envelopes (value, timestamp, partition, offset) from a broker or files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierflow.schemas import ENVELOPE


def kafka_options(servers: str, topic: str, max_offsets: int = 1000,
                  starting: str = "latest") -> dict[str, str]:
    """Reader options for one topic."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "maxOffsetsPerTrigger": str(max_offsets),
        "failOnDataLoss": "false",
    }


def kafka_stream(spark: SparkSession, servers: str, topic: str, max_offsets: int = 1000,
                 starting: str = "latest") -> DataFrame:
    """Envelopes of a topic; needs the broker connector on the class path."""
    options = kafka_options(servers, topic, max_offsets, starting)
    return spark.readStream.format("kafka").options(**options).load()


def envelope_stream(spark: SparkSession, folder: str, max_files: int | None = None,
                    fmt: str = "parquet") -> DataFrame:
    """Envelopes from files that arrive in a folder, ``max_files`` per batch."""
    reader = spark.readStream.schema(ENVELOPE).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)
