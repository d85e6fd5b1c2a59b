"""Session set-up, scoped settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import Any
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings every job of this package relies on. They are runtime settings, so
# they can also be applied to a session somebody else created.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Exact percentiles: keep hashing groups instead of sorting all rows once a
    # task has seen more than 128 of them.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
}

# State of stateful streaming operators lives in RocksDB so that it can spill
# to local disk and is saved to the checkpoint folder as change logs.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str = "tierflow", master: str | None = None,
                  settings: dict[str, str] | None = None) -> SparkSession:
    """Create (or fetch) a session. ``master`` stays unset under spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings this package relies on to an existing session."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Set runtime settings for one block and put the old ones back."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def at_once(spark: SparkSession, jobs: dict[str, Callable[[], Any]], threads: int = 4) -> dict[str, Any]:
    """Results of independent jobs, by name, run side by side.

    Cores that the last tasks of one job leave idle go to the next. The first error
    is raised; jobs that have not begun by then are left out.
    """
    bound = inheritable_thread_target(spark)
    with ThreadPoolExecutor(threads) as pool:
        running = {name: pool.submit(bound(job)) for name, job in jobs.items()}
        try:
            return {name: job.result() for name, job in running.items()}
        finally:
            pool.shutdown(cancel_futures=True)


def shared_root(spark: SparkSession) -> str:
    """The shared folder of the cluster, for intermediate tables.

    ``spark.checkpoint.dir`` names it. Only a local-mode session may fall back
    to a folder of this machine; a cluster without the setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        root = tempfile.mkdtemp(prefix="tierflow-")
        spark.sparkContext.setCheckpointDir(root)
        return root
    raise ValueError("set spark.checkpoint.dir to a folder all executors share")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark)}/tierflow/{label}-{uuid.uuid4().hex}"


def plain_name(uri: str) -> str:
    """A file's path from its URI, the form in which scans name files, as readers take it."""
    return unquote(uri).replace(":///", ":/", 1)


def file_system(spark: SparkSession, path: str):
    """The file system of ``path`` and the path as that system takes it."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def make_folder(spark: SparkSession, path: str) -> None:
    """Create an empty folder on whatever file system ``path`` names."""
    system, jvm_path = file_system(spark, path)
    system.mkdirs(jvm_path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``."""
    system, jvm_path = file_system(spark, path)
    return system.exists(jvm_path)
