"""Compaction of a table's small files in place: large files are not read or moved.

Small files are packed into bins of the wanted size and each bin is written as one
file to a hidden folder. A journal then names the new and the old files; only when it
is there are new files moved in and old ones removed. A run that is stopped before the
journal leaves the table as it was; one that is stopped after it is finished by the
next run or by :func:`finish_compaction`. A plain folder has no snapshots: a query that
lists the files while they are exchanged may see a bin twice, so run it between loads.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.session import file_system, plain_name

STAGING = "_compaction"
TARGET_BYTES = 256 << 20


def pack_files(sizes: dict[str, int], small: int, target: int) -> list[list[str]]:
    """Bins of the files below ``small`` bytes, first fit by falling size; files of one folder only.

    A bin has at most ``target`` bytes. Bins with a single file are left out, as
    there is nothing to gain from writing it again.
    """
    folders: dict[str, list[tuple[list[str], int]]] = {}
    for file, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        if size >= small:
            continue
        bins = folders.setdefault(file.rsplit("/", 1)[0], [])
        for i, (files, held) in enumerate(bins):
            if held + size <= target:
                bins[i] = ([*files, file], held + size)
                break
        else:
            bins.append(([file], size))
    return [files for bins in folders.values() for files, _ in bins if len(files) > 1]


def file_sizes(table: DataFrame) -> dict[str, int]:
    """Size of every file of a scanned table: one row a file, like the driver's own listing."""
    rows = table.select("_metadata.file_path", "_metadata.file_size").distinct()
    return {plain_name(r.file_path): r.file_size for r in rows.toLocalIterator()}


def compact_small_files(spark: SparkSession, path: str, small: int | None = None,
                        target: int = TARGET_BYTES, fmt: str = "parquet") -> list[list[str]]:
    """Join the files below ``small`` bytes (three quarters of ``target`` by default); returns the bins.

    Only the rows of small files are read and shuffled, one bin to a task. The rows of
    a partitioned table stay in their partition.
    """
    finish_compaction(spark, path)
    table = spark.read.format(fmt).load(path)
    bins = pack_files(file_sizes(table), small or target * 3 // 4, target)
    if not bins:
        return []
    run = uuid.uuid4().hex
    staging = f"{path.rstrip('/')}/{STAGING}/{run}"
    old = [f for files in bins for f in files]
    numbers = spark.createDataFrame([(f, i) for i, files in enumerate(bins) for f in files],
                                    "_file string, _bin int")
    # Partition columns are in the folder names: without a base path only what files hold is read.
    schema = T.StructType([f for f in table.schema.fields if f.name not in _partition_columns(path, old)])
    name = F.regexp_replace(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))),
                            "^([a-z0-9]+):///", "$1:/")
    rows = spark.read.format(fmt).schema(schema).load(old).select("*", name.alias("_file"))
    # By number, not by hash: bins whose hashes meet would be one task's.
    (rows.join(numbers, "_file").drop("_file").repartitionById(len(bins), "_bin")
         .write.format(fmt).partitionBy("_bin").save(staging))
    folders = [files[0].rsplit("/", 1)[0] for files in bins]
    system, _ = file_system(spark, path)
    moves = []
    for number, folder in enumerate(folders):
        for part in system.listStatus(_path(spark, f"{staging}/_bin={number}")):
            name = part.getPath().getName()
            moves.append([part.getPath().toString(), f"{folder}/compact-{run}-{number}-{name}"])
    journal = json.dumps({"moves": moves, "old": old})
    _write_text(spark, f"{path.rstrip('/')}/{STAGING}/{run}.json", journal)
    finish_compaction(spark, path)
    return bins


def finish_compaction(spark: SparkSession, path: str) -> int:
    """Carry out the journals that are there; returns their number. Every step may be repeated."""
    root = f"{path.rstrip('/')}/{STAGING}"
    system, folder = file_system(spark, root)
    if not system.exists(folder):
        return 0
    done = 0
    for entry in list(system.listStatus(folder)):
        name = entry.getPath().toString()
        if not name.endswith(".json"):
            continue
        steps = json.loads(spark.read.text(name, wholetext=True).first().value)
        for source, place in steps["moves"]:
            if system.exists(_path(spark, source)) and not system.rename(_path(spark, source), _path(spark, place)):
                raise OSError(f"could not move {source}")
        for old in steps["old"]:
            system.delete(_path(spark, old), False)
        system.delete(_path(spark, name.removesuffix(".json")), True)
        system.delete(entry.getPath(), False)
        done += 1
    return done


def _partition_columns(path: str, files: list[str]) -> set[str]:
    """Names of the ``name=value`` folders between the table and its files."""
    root = plain_name(path).rstrip("/")
    return {unquote(part.split("=", 1)[0]) for f in files
            for part in f.split(root, 1)[-1].split("/")[:-1] if "=" in part}


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _write_text(spark: SparkSession, name: str, text: str) -> None:
    """The whole text under its final name at once: written aside, then renamed."""
    system, place = file_system(spark, name)
    aside = _path(spark, f"{name}.tmp")
    stream = system.create(aside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    system.rename(aside, place)
