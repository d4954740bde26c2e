"""Results that are read more than once are written once, to shared storage.

Nothing is cached in executor memory: a lost executor costs a re-read of files,
not a recomputation of the fact. Written Parquet keeps column pruning and filter
push-down for every later reader, which an RDD checkpoint would not.
"""

from __future__ import annotations

import atexit
import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Stand-in folders of local sessions with nothing configured, by application.
_local_folders: dict[str, str] = {}

# Folders of this process's applications, removed when it ends.
_owned: set[str] = set()


@atexit.register
def remove_owned() -> None:
    """Remove what this process's applications have written. Best effort: it may not reach the store any more."""
    jvm = SparkContext._jvm
    while jvm is not None and _owned:
        try:
            path = jvm.org.apache.hadoop.fs.Path(_owned.pop())
            path.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)
        except Exception:  # noqa: BLE001 - the process ends
            return


def shared_folder(spark: SparkSession) -> str:
    """This application's folder under the one the cluster names for checkpoints.

    It is removed when the process ends. A machine-local folder is used only in
    local mode with nothing configured.
    """
    context = spark.sparkContext
    application = context.applicationId
    root = spark.conf.get(CHECKPOINT_DIR, None) or _local_folders.get(application)
    if not root:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
        root = _local_folders[application] = tempfile.mkdtemp(prefix="bankmart-")
    folder = f"{root.rstrip('/')}/bankmart/{application}"
    _owned.add(folder)
    return folder


def written(df: DataFrame, label: str = "result") -> DataFrame:
    """Write a frame to its own folder in shared storage and read it back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _overwrite(df: DataFrame, path: str) -> None:
    """Replaces what a failed earlier attempt may have left."""
    df.write.mode("overwrite").parquet(path)


class TableStore:
    """Tables of one source, each written on first use within this application."""

    def __init__(self, spark: SparkSession, name: str):
        self._spark = spark
        self._folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self._written: set[str] = set()
        self._tables: dict[str, DataFrame] = {}
        self._lock = threading.RLock()

    def path(self, name: str, write: Callable[[str], object]) -> str:
        """The folder of a stored dataset, calling ``write`` with it on first use."""
        path = f"{self._folder}/{name}"
        with self._lock:
            if name not in self._written:
                write(path)
                self._written.add(name)
        return path

    def table(
        self,
        name: str,
        build: Callable[[], DataFrame],
        write: Callable[[DataFrame, str], object] = _overwrite,
    ) -> DataFrame:
        """The stored table, built and written as Parquet on first use."""
        with self._lock:
            if name not in self._tables:
                df = build()
                path = self.path(name, lambda path: write(df, path))
                self._tables[name] = self._spark.read.schema(df.schema).parquet(path).select(*df.columns)
            return self._tables[name]
