"""Arrow batches cut to a bounded size of text before Python touches them, and columns added to them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SLICE_BYTES = 4 << 20
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` over batches of about ``SLICE_BYTES``; a longer row is a batch of its own.

    Without a bound in bytes a batch is ten thousand rows however long, held by the executor and by the worker that
    reads it. A session that has no bound gets this one on first use.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_BYTES, None) is None:
        conf.set(BATCH_BYTES, str(SLICE_BYTES))
    return df.mapInArrow(run, schema)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in order, cut where ``column`` passes ``limit`` bytes; a longer text is a slice of its own."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def free(name: str, columns: list[str]) -> str:
    """``name``, or one made from it that no column has, whatever its case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def replaced_schema(df: DataFrame, fields: list[T.StructField]) -> T.StructType:
    """The columns of ``df`` and ``fields``, which take the place of columns of their names."""
    names = {f.name.lower() for f in fields}
    return T.StructType([*[f for f in df.schema.fields if f.name.lower() not in names], *fields])


def replaced(batch: pa.RecordBatch, columns: list[pa.Array], fields: list[T.StructField]) -> pa.RecordBatch:
    """As ``replaced_schema``, for a batch and the arrays of ``fields``."""
    names = {f.name.lower() for f in fields}
    kept = [(c, n) for c, n in zip(batch.columns, batch.schema.names) if n.lower() not in names]
    return pa.RecordBatch.from_arrays([*(c for c, _ in kept), *columns], [*(n for _, n in kept), *(f.name for f in fields)])


import pyarrow.compute  # noqa: E402,F401  (pa.compute is a lazy submodule)
