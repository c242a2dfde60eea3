"""Commits of a table: numbered files, of which the newest says what readers see.

Writers first write data where no reader looks, then publish a commit that names it. A stop in
between leaves the earlier commit in force, and the repeated batch writes the same folders anew.
A table has one writer at a time: the streaming query whose batches it holds.
"""

from __future__ import annotations

import json
from collections.abc import Collection
from typing import Any

from pyspark.sql import SparkSession

COMMITS = "_commits"
DATA = "data"
NO_BATCH = -1
# Commit files that stay; readers only need the newest.
KEPT_COMMITS = 10


def _file_system(spark: SparkSession, path: str):
    """The file system of ``path``, whatever store it is in, and the path for it."""
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark._jsc.hadoopConfiguration()), own


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, in order; none when there is no such folder."""
    files, own = _file_system(spark, path)
    if not files.exists(own):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(own))


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    files, own = _file_system(spark, path)
    return files.getContentSummary(own).getLength()


def remove(spark: SparkSession, path: str) -> None:
    files, own = _file_system(spark, path)
    files.delete(own, True)


def _numbers(spark: SparkSession, location: str) -> list[int]:
    names = names_in(spark, f"{location}/{COMMITS}")
    return [int(name.removesuffix(".json")) for name in names if name.endswith(".json")]


def is_committed_table(spark: SparkSession, location: str) -> bool:
    return bool(_numbers(spark, location))


def current(spark: SparkSession, location: str) -> dict[str, Any]:
    """What the newest commit says; ``batch`` is -1 for a table without commits."""
    numbers = _numbers(spark, location)
    if not numbers:
        return {"commit": NO_BATCH, "batch": NO_BATCH}
    files, own = _file_system(spark, f"{location}/{COMMITS}/{numbers[-1]:012d}.json")
    stream = files.open(own)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def publish(spark: SparkSession, location: str, state: dict[str, Any]) -> dict[str, Any]:
    """Make ``state`` the newest commit, by the renaming of a whole file."""
    numbers = _numbers(spark, location)
    state = {**state, "commit": numbers[-1] + 1 if numbers else 0}
    folder = f"{location}/{COMMITS}"
    target = f"{folder}/{state['commit']:012d}.json"
    files, draft = _file_system(spark, f"{target}.draft")
    stream = files.create(draft, True)
    try:
        stream.write(bytearray(json.dumps(state, sort_keys=True).encode()))
    finally:
        stream.close()
    if not files.rename(draft, _file_system(spark, target)[1]):
        raise RuntimeError(f"{target} exists: the table has a second writer")
    for number in numbers[: 1 - KEPT_COMMITS]:
        remove(spark, f"{folder}/{number:012d}.json")
    return state


def is_new(state: dict[str, Any], batch_id: int, writer: str) -> bool:
    """Whether a batch is still to be committed.

    After a stop the last batch may come again, which is no news. An older one means that the
    query's checkpoint was lost or is another's, and that going on would lose rows.
    """
    if state["batch"] == NO_BATCH:
        return True
    if state.get("writer", writer) != writer:
        raise RuntimeError(f"the table belongs to {state['writer']}, not to {writer}")
    if batch_id < state["batch"]:
        raise RuntimeError(f"batch {batch_id} is older than the table's {state['batch']}")
    return batch_id > state["batch"]


def expire(spark: SparkSession, location: str, kept: Collection[str]) -> None:
    """Remove data folders other than ``kept``."""
    for name in names_in(spark, f"{location}/{DATA}"):
        if name not in kept:
            remove(spark, f"{location}/{DATA}/{name}")
