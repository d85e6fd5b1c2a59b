"""Column expressions on times."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_timestamps(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Turn text columns into timestamps; text that is no time becomes NULL."""
    return df.withColumns({name: F.try_to_timestamp(F.col(name)) for name in columns})


def to_utc_naive(df: DataFrame) -> DataFrame:
    """All timestamp columns as zone-less timestamps (session zone is UTC)."""
    stamps = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in stamps})
