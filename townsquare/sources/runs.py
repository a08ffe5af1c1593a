"""Commit records of stored runs (A8, A10): a run exists once its record does.

The record is a small JSON file, ``<base>/commits/<run id>.json``, written last: first under a hidden name, then renamed, so
it is either whole or not there. Readers go by it alone, so a run that failed half way is never listed or read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession


class NotCommitted(FileNotFoundError):
    """The run, or the part of it that was asked for, has no commit record."""


def _store(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def _place(base: str, run_id: str) -> str:
    return f"{base.rstrip('/')}/commits/{run_id}.json"


def commit(spark: SparkSession, base: str, run_id: str, posts: bool, sections: Sequence[str], states: Sequence[str] = ()) -> None:
    """Declare a run whole, with the parts it has."""
    final = _place(base, run_id)
    store, hidden = _store(spark, f"{base.rstrip('/')}/commits/.{run_id}.{uuid.uuid4().hex}")
    out = store.create(hidden, True)
    try:
        out.write(bytearray(json.dumps({"run_id": run_id, "posts": posts, "sections": sorted(sections), "states": sorted(states)}).encode()))
    finally:
        out.close()
    if not store.rename(hidden, _store(spark, final)[1]):
        store.delete(hidden, False)
        raise FileExistsError(f"another run was committed as {run_id} meanwhile")


def withdraw(spark: SparkSession, base: str, run_id: str) -> None:
    """Take a run's record away, before its folders are written anew."""
    store, path = _store(spark, _place(base, run_id))
    store.delete(path, False)


def record(spark: SparkSession, base: str, run_id: str) -> dict | None:
    """What a committed run holds: ``run_id``, ``posts`` (whether there is a final dataset), ``sections``, ``states``."""
    store, path = _store(spark, _place(base, run_id))
    if not store.exists(path):
        return None
    stream = store.open(path)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def committed(spark: SparkSession, base: str) -> list[dict]:
    """The records of all committed runs, newest run id first; one level is listed."""
    store, folder = _store(spark, f"{base.rstrip('/')}/commits")
    if not store.exists(folder):
        return []
    names = (status.getPath().getName() for status in store.listStatus(folder))
    ids = sorted((name.removesuffix(".json") for name in names if name.endswith(".json") and not name.startswith(".")), reverse=True)
    found = (record(spark, base, run_id) for run_id in ids)
    return [entry for entry in found if entry is not None]
