"""Row quality: key checks, quarantine, de-duplication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.functions.names import free_name
from tierflow.schemas import CORRUPT


def require_key(df: DataFrame, *columns: str) -> DataFrame:
    """Rows whose key columns are all present."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows without the text column, malformed rows with it)."""
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, df.filter(F.col(CORRUPT).isNotNull())


def dedup(df: DataFrame, keys: list[str], first_by: list[str] | None = None) -> DataFrame:
    """One row per key; NULL keys are equal to each other.

    With ``first_by`` the row that comes first in those columns stays, which
    makes the choice repeatable. Repeats are removed inside each task before
    the shuffle, so a key that fills a third of the table reaches it as one row
    per task.
    """
    if not first_by:
        return df.dropDuplicates(keys)
    window = Window.partitionBy(*keys).orderBy(*first_by)
    n = free_name(df, "_n")
    return df.withColumn(n, F.row_number().over(window)).filter(F.col(n) == 1).drop(n)
