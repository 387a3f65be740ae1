"""What columns a stored table has, in numbered versions beside its data.

Parquet tells columns file by file; asking the files means opening each footer ever written. The
description is a short file that only an upsert which brings a column adds a version of.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidemark.sinks.files import Folder

COLUMNS = "_columns"


def described(spark: SparkSession, path: str) -> tuple[int, T.StructType] | None:
    """Newest version and its columns; None for a table without a description."""
    folder = Folder(spark, f"{path}/{COLUMNS}")
    versions = sorted(int(n.removesuffix(".json")) for n in folder.names() if n.endswith(".json"))
    if not versions:
        return None
    return versions[-1], T.StructType.fromJson(json.loads(folder.read(f"{versions[-1]}.json")))


def columns_of(spark: SparkSession, path: str) -> tuple[int, T.StructType] | None:
    """As ``described``; a table from before descriptions has its files read, once. None if there is no table."""
    found = described(spark, path)
    if found is not None:
        return found
    try:
        return -1, spark.read.option("mergeSchema", "true").parquet(path).schema
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing) or "UNABLE_TO_INFER_SCHEMA" in str(missing):
            return None
        raise


def joined(held: T.StructType, new: T.StructType) -> T.StructType:
    """Columns of both, the held ones first; a column keeps its type."""
    mine = {f.name: f.dataType for f in held.fields}
    for f in new.fields:
        if f.name in mine and mine[f.name] != f.dataType:
            raise ValueError(f"column {f.name} is {mine[f.name].simpleString()} in the table, {f.dataType.simpleString()} in the new rows")
    return T.StructType([T.StructField(f.name, f.dataType) for f in [*held.fields, *[f for f in new.fields if f.name not in mine]]])


def describe(spark: SparkSession, path: str, version: int, columns: T.StructType) -> None:
    """Add the version after ``version``; refused if another writer has added it meanwhile."""
    if not Folder(spark, f"{path}/{COLUMNS}").create(f"{version + 1}.json", columns.json()):
        raise RuntimeError(f"another upsert has changed the columns of {path} meanwhile: repeat this one")
