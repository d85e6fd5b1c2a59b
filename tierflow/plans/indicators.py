"""The indicator product: saved payloads -> one stored long table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.operators.indicators import (INDICATORS, Registry, flatten_payload, load_summary,
                                           preview, select_indicators)
from tierflow.schemas import INDICATOR
from tierflow.sinks.batch import load_some_indicators, save_indicators
from tierflow.sources.payloads import read_payloads


def run_indicators(spark: SparkSession, payload_dir: str, path: str,
                   keys: list[str] | None = None, registry: Registry = INDICATORS,
                   loaded_at: datetime | None = None, existing: str | None = None,
                   dry_run: bool = False) -> DataFrame:
    """Load the payloads of ``keys`` (all by default).

    A full load replaces the table at ``path``. A partial one needs the
    ``existing`` table and writes that table's other indicators with the new
    rows to ``path``. A dry run writes nothing and returns sample rows;
    otherwise the result is the number of rows per indicator.
    """
    wanted = {k: v for k, v in registry.items() if keys is None or k in keys}
    payloads = read_payloads(spark, payload_dir).filter(F.col("key").isin(list(wanted)))
    rows = select_indicators(flatten_payload(payloads, loaded_at, wanted), wanted, wanted)
    if dry_run:
        return preview(rows)
    if existing is None:
        save_indicators(rows, path)
    else:
        codes = [code for code, _ in wanted.values()]
        load_some_indicators(spark.read.schema(INDICATOR).parquet(existing), rows, codes, path)
    loaded = spark.read.schema(INDICATOR).parquet(path)  # a load may bring no rows at all
    return load_summary(select_indicators(loaded, wanted, wanted), wanted)
