"""Texts handed to Python workers in Arrow batches of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

BATCH_ROWS = 1000
BATCH_BYTES = 32 << 20


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | None], schema: str) -> DataFrame:
    """``fn`` over every Arrow batch of ``df``; it returns columns by name, or None for no rows.

    Batches hold at most ``BATCH_ROWS`` rows and about ``BATCH_BYTES`` bytes, so that long
    texts do not pile up in a worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict | None]:
        for batch in batches:
            yield fn(batch)

    return map_stream(df, run, schema)


def map_stream(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict | None]], schema: str) -> DataFrame:
    """Like :func:`map_batches`, for a function over a task's whole stream of batches."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    arrow = to_arrow_schema(T._parse_datatype_string(schema) if isinstance(schema, str) else schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in fn(batches):
            if columns is not None:
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def column(batch: pa.RecordBatch, name: str) -> list:
    """A column's values as Python objects."""
    return batch.column(name).to_pylist()
