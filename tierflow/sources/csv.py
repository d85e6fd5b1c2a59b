"""CSV files into the raw layer."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.schemas import CORRUPT, RAW_COMMERCE
from tierflow.session import at_once
from tierflow.sinks.batch import save_table


def read_csv_bronze(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with header plus load time and source file.

    Without a schema the types are inferred, which reads the file once more.
    With one, a header that does not match it is an error.
    """
    reader = spark.read.option("header", True)
    reader = reader.schema(schema).option("enforceSchema", False) if schema \
        else reader.option("inferSchema", True)
    return (reader.csv(path)
            .withColumn("_ingested_at", F.current_timestamp())
            .withColumn("_source_file", F.col("_metadata.file_path")))


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType,
                     header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows that fit the schema, lines that do not, with ``_reason``) of CSV files.

    A line does not fit if it has too few or too many cells (``cells``) or a cell that is
    not of its column's type (``value``); its text is in ``_corrupt_record`` and the cells
    that could be read are kept. Cells that a query does not need are not parsed, so a
    condition on all of them makes every query judge a line alike.
    """
    with_text = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = (spark.read.schema(with_text).option("header", header).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).csv(path)
            .filter(F.length(F.concat_ws("", *[F.col(c).cast("string") for c in schema.names])) >= 0)
            .withColumn("_ingested_at", F.current_timestamp())
            .withColumn("_source_file", F.col("_metadata.file_path")))
    # As texts all cells fit, so what still does not is their number.
    texts = ", ".join(f"_{i} string" for i in range(len(schema))) + f", {CORRUPT} string"
    as_texts = F.from_csv(F.col(CORRUPT), F.lit(texts), {"columnNameOfCorruptRecord": CORRUPT})
    bad = rows.filter(F.col(CORRUPT).isNotNull()).withColumn(
        "_reason", F.when(as_texts[CORRUPT].isNull(), "value").otherwise("cells"))
    return rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), bad


def ingest_all(spark: SparkSession, raw_dir: str, bronze_dir: str,
               tables: dict[str, T.StructType | None] | None = None,
               fmt: str = "parquet") -> dict[str, int]:
    """Load ``<raw_dir>/<name>.csv`` (file or folder) for every table of the
    registry; returns the rows written per table, counted during the write.
    Several tables are loaded at a time."""
    def load(name: str, schema: T.StructType | None) -> int:
        return save_table(read_csv_bronze(spark, f"{raw_dir}/{name}.csv", schema),
                          f"{bronze_dir}/{name}", fmt)

    registry = tables or dict.fromkeys(RAW_COMMERCE)
    return at_once(spark, {name: partial(load, name, schema) for name, schema in registry.items()})
