"""Compare every registered query with its SQL: ``python -m checks.compare DIR [NAME...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pyarrow as pa
from pyspark.sql import SparkSession

from checks.cases import CASES
from checks.sql import ORACLE


def duck_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """A connection with one view per test table."""
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(table: pa.Table) -> tuple[list[tuple[str, str]], list[tuple]]:
    names = sorted(table.column_names)
    kinds = [(n, str(table.schema.field(n).type).replace("large_", "")) for n in names]
    columns = [table.column(n).to_pylist() for n in names]
    return kinds, sorted(zip(*columns), key=repr)


def differences(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str,
                name: str) -> list[str]:
    """What differs between the query and its SQL: types, row count, values."""
    mine, my_rows = _rows(CASES[name](spark, sf_dir).toArrow())
    theirs, their_rows = _rows(con.sql(ORACLE[name]).to_arrow_table())
    problems = []
    if mine != theirs:
        problems.append(f"types: {[(a, b) for a, b in zip(mine, theirs) if a != b] or (mine, theirs)}")
    if len(my_rows) != len(their_rows):
        problems.append(f"rows: {len(my_rows)} / {len(their_rows)}")
    elif my_rows != their_rows:
        bad = [(a, b) for a, b in zip(my_rows, their_rows) if a != b]
        problems.append(f"values: {len(bad)} of {len(my_rows)}, first {bad[0]}")
    return problems


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(CASES)
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", False)
             .config("spark.ui.showConsoleProgress", False)
             .config("spark.sql.shuffle.partitions", 8).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = duck_tables(sf_dir), 0
    for name in names:
        began = time.time()
        try:
            found = differences(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - began:.1f}s {' '.join(found)}",
              flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return int(failed > 0)


if __name__ == "__main__":
    sys.exit(main())
