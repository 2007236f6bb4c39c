"""Publishes that can be finished after they died.

A change is first written whole beside its table, under ``_publish/<table>`` in the
folder above.  Then an intent is recorded there: the folders to move into place and
those to take away.  Only then is the table touched; every row was written once, as moving
renames.  The intent is removed last.  A writer that dies before the intent leaves the
old table, one that dies after it leaves an intent from which :func:`recover`, run
by the next writer, makes the new one.  Every step can run again.

One writer per table is assumed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import SparkSession

from areaflow.sources import files


def _beside(path: str) -> str:
    parent, name = path.rstrip("/").rsplit("/", 1)
    return f"{parent}/_publish/{name}"


def staging(path: str) -> str:
    """A folder for a change of the table, in its file system."""
    return f"{_beside(path)}/{uuid.uuid4().hex}"


def folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition folders of a table with ``depth`` partition columns, or its files when it has none."""
    if not files.exists(spark, path):
        return []
    return sorted(files.children(spark, path, "/".join(["*"] * max(1, depth))))


def publish(spark: SparkSession, path: str, staged: str, moved: Sequence[str], removed: Iterable[str]) -> None:
    """Put the folders ``moved`` of a staged change in place and take those ``removed`` away."""
    intent = {"staged": staged, "moved": list(moved), "removed": sorted(set(removed) - set(moved))}
    record = f"{staged}.json"
    files.write_text(spark, record, json.dumps(intent))
    _finish(spark, path, record, intent)


def _finish(spark: SparkSession, path: str, record: str, intent: dict) -> None:
    for name in intent["removed"]:
        files.remove(spark, f"{path}/{name}")
    files.make_folder(spark, path)
    for name in intent["moved"]:
        source = f"{intent['staged']}/{name}"
        # one that is gone was moved before the writer died
        if files.exists(spark, source):
            files.remove(spark, f"{path}/{name}")
            files.rename(spark, source, f"{path}/{name}")
    files.remove(spark, record)
    files.remove(spark, intent["staged"])


def recover(spark: SparkSession, path: str) -> int:
    """Finish what a dead writer intended; returns how many intents there were."""
    beside = _beside(path)
    if not files.exists(spark, beside):
        return 0
    records = files.matching(spark, f"{beside}/*.json")
    for record in records:
        _finish(spark, path, record, json.loads(files.read_text(spark, record)))
    # staged without an intent: its writer died before it touched the table
    for left in files.matching(spark, f"{beside}/*"):
        files.remove(spark, left)
    return len(records)
