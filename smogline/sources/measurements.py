"""Measurement files and stored datasets."""

from __future__ import annotations

from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogline.functions.values import nan_to_null, quoted
from smogline.schema import LOCATION_ROW, LONG_RESPONSE, LONG_ROW

#: So many files are opened at once to see their headers.
HEADER_THREADS = 32


def _is_artefact(name: str) -> bool:
    """Unnamed index columns left in CSV files by earlier tools."""
    return not name.strip() or name.startswith("Unnamed:") or name == "_c0"


def _typed(name: str, schema: T.StructType | None):
    """The column as declared; undeclared metric columns are numbers unless they hold text."""
    if schema is not None and name in schema.names:
        kind = schema[name].dataType
    elif name.endswith((".value", ".raw")):
        kind = T.DoubleType()
    else:
        kind = T.StringType()
    column = quoted(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        column = nan_to_null(column.try_cast(kind))
    elif not isinstance(kind, T.StringType):
        column = column.try_cast(kind)
    return column.alias(name)


def read_measurements_wide(spark: SparkSession, paths, schema: T.StructType | None = None) -> DataFrame:
    """CSV rows of one sensor and period each, matched to ``schema`` by column name.

    Empty cells and NaN become null, index artefacts go, declared columns that a
    file lacks are null. All files under ``paths`` share one header.
    """
    text = spark.read.option("header", True).csv(paths)
    present = [c for c in text.columns if not _is_artefact(c)]
    missing = [f for f in (schema or T.StructType()).fields if f.name not in present]
    return text.select(*[_typed(c, schema) for c in present],
                       *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


def first_line(spark: SparkSession, path: str) -> str | None:
    """A file's first line, unpacked by its ending; None for what is not one file or whose first record has more lines."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop, spark.sparkContext._jsc.hadoopConfiguration()
    where = hadoop.fs.Path(path)
    files = where.getFileSystem(conf)
    if not files.exists(where) or files.getFileStatus(where).isDirectory():
        return None
    codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(where)
    stream = files.open(where)
    try:
        reader = spark.sparkContext._jvm.java.io.InputStreamReader(stream if codec is None else codec.createInputStream(stream), "UTF-8")
        line = spark.sparkContext._jvm.java.io.BufferedReader(reader).readLine() or ""
    finally:
        stream.close()
    return line if line.count('"') % 2 == 0 else None


def by_header(spark: SparkSession, paths) -> list[list[str]]:
    """The paths in groups of files with equal first lines.

    The driver reads these lines alone, many files at a time; no job is started. What is not one
    file is a group of its own.
    """
    paths, groups = list(paths), defaultdict(list)
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        for path, line in zip(paths, pool.map(lambda p: first_line(spark, p), paths)):
            groups[(path if line is None else None, line)].append(path)
    return list(groups.values())


def read_report_parts(spark: SparkSession, paths, schema: T.StructType | None = None) -> DataFrame:
    """A report split over files (plain or gzip) whose headers may differ.

    Parts are matched by column name, duplicates stay. Files with equal headers
    share one scan, so the plan and the number of jobs grow with the number of distinct headers.
    """
    parts = [read_measurements_wide(spark, group, schema) for group in by_header(spark, paths)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def read_measurements_long(spark: SparkSession, path, one_per_file: bool = True) -> tuple[DataFrame, DataFrame]:
    """Data rows and location rows of JSON responses; no ``locations`` means no rows there.

    A file is one response, or has one response per line.
    """
    response = spark.read.schema(LONG_RESPONSE).option("multiLine", one_per_file).json(path)
    data = response.select(F.inline("data"))
    data = data.select(*[
        nan_to_null(c).alias(c) if isinstance(LONG_ROW[c].dataType, T.DoubleType) else F.col(c)
        for c in LONG_ROW.names])
    return data, response.select(F.inline("locations")).select(*LOCATION_ROW.names)


def read_dataset_or_empty(spark: SparkSession, path: str, schema: T.StructType,
                          enforce: bool = False) -> DataFrame:
    """The stored dataset, or a typed empty one when there is none yet.

    Stored columns are taken as they are, extra ones included; ``enforce`` reads by
    ``schema`` instead, which also types the partition columns.
    """
    reader = spark.read.schema(schema) if enforce else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)
