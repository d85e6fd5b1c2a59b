"""Saved responses of a statistics service."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file: indicator key and body.

    A response page is saved as ``<key>.json`` or ``<key>.<page>.json``.
    """
    return (spark.read.text(folder, wholetext=True)
            .select(F.split("_metadata.file_name", r"\.")[0].alias("key"),
                    F.col("value").alias("body")))


def payload_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """The same of files that arrive, each once; with the time and name of the file."""
    reader = spark.readStream.format("text").schema("value string").option("wholetext", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder).select(
        F.split("_metadata.file_name", r"\.")[0].alias("key"), F.col("value").alias("body"),
        F.col("_metadata.file_modification_time").alias("file_time"), F.col("_metadata.file_name").alias("file_name"))
