"""What a stored table's weeks look like, told by listing alone, and notes of what was seen."""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import SparkSession

from tidemark.schema import PARTITION
from tidemark.sinks.files import Folder


def stored_weeks(spark: SparkSession, path: str) -> list[date]:
    """Weeks a table has a partition of, by the folders' names."""
    names = [n.split("=", 1)[1] for n in Folder(spark, path).names() if n.startswith(f"{PARTITION}=")]
    return sorted(date.fromisoformat(n) for n in names if n[:1].isdigit())


def signature(spark: SparkSession, path: str, week: date) -> list:
    """Names and sizes of a week's files: differs once the week has been written again."""
    return [[n, size] for n, size, _ in Folder(spark, path).listing(f"{PARTITION}={week}") if not n.startswith((".", "_"))]


def newest_note(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Number and content of the newest note in a folder; -1 and nothing if there is none."""
    folder = Folder(spark, path)
    names = [n for n in folder.names() if n.endswith(".json")]
    return (int(max(names).removesuffix(".json")), json.loads(folder.read(max(names)))) if names else (-1, {})


def write_note(spark: SparkSession, path: str, after: int, content: dict) -> None:
    """The note that follows number ``after``; refused if another run has written it meanwhile."""
    folder = Folder(spark, path)
    before = [n for n in folder.names() if n.endswith(".json")]
    if not folder.create(f"{after + 1:08d}.json", json.dumps(content)):
        raise RuntimeError(f"another run has written {path} meanwhile: repeat this one")
    for name in before:
        folder.drop(name)
