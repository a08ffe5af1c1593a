"""Small helpers shared by the operators: lineage cuts and size checks."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_CHECKPOINT_CONF = "spark.checkpoint.dir"
_LOCAL_FALLBACK_CONF = "spark.townsquare.localScratch"
#: Intermediate tables not yet deleted; the innermost scope owns what is written inside it.
_WRITTEN: dict[str, SparkSession] = {}
_SCOPES: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder: on a cluster the
    executors would not see each other's files.
    """
    folder = spark.conf.get(_CHECKPOINT_CONF, None) or spark.conf.get(_LOCAL_FALLBACK_CONF, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_CONF} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="townsquare-")
    spark.conf.set(_LOCAL_FALLBACK_CONF, folder)
    return folder


def write_intermediate(df: DataFrame) -> str:
    """Write ``df`` as a Parquet table in the shared folder and return its path."""
    path = f"{shared_folder(df.sparkSession)}/townsquare/{uuid.uuid4().hex}"
    own_path(df.sparkSession, path)
    df.write.parquet(path)
    return path


def own_path(spark: SparkSession, path: str) -> str:
    """Note a path for deletion with the innermost scope, or when the process ends."""
    _WRITTEN[path] = spark
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch_scope() -> Iterator[None]:
    """Delete on exit, also after a failure, every intermediate table written inside.

    For work whose results have been written or collected before the scope ends.
    """
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield
    finally:
        _SCOPES.remove(paths)
        for path in paths:
            if path in _WRITTEN:
                drop_intermediate(_WRITTEN[path], path)


@atexit.register
def _drop_all() -> None:
    for path, spark in list(_WRITTEN.items()):
        try:
            drop_intermediate(spark, path)
        except Exception:  # the session may be gone, and with it the way to the folder
            return


def read_intermediate(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def drop_intermediate(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table this library wrote itself."""
    _WRITTEN.pop(path, None)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def freeze(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a written table.

    The table lives on shared storage, so it survives lost executors, its rows (and any
    partition ids stored in them) can no longer change, and later plans see its real size.
    """
    return read_intermediate(df.sparkSession, write_intermediate(df), df.schema)


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; used before broadcasting a side."""
    return df.count() <= max_rows
