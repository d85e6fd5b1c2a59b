"""Column names for what an operator adds for a while."""

from pyspark.sql import DataFrame


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column is called so (case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
