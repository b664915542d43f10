"""Writers: datasets, summaries, JSON records, snapshots and offsets."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogline.functions.features import decimals_to_double
from smogline.sources import versions

log = logging.getLogger(__name__)

SUMMARY_FORMATS = ("csv", "parquet", "json")
STORE_FOLDERS = ("type", "bucket")


def write_dataset(df: DataFrame, path: str, codec: str = "zstd") -> None:
    """Compressed Parquet, one folder per period type, newest rows first in every file.

    Range partitioning on (type, date, sensor) spreads even one period with very many
    sensors over all tasks; min/max statistics then let readers skip old row groups. The
    order begins with the folder's column: the writer would sort again by that alone.
    """
    keys = [F.col("type").asc(), F.col("date").desc()]
    if "datasourceId" in df.columns:
        keys.append(F.col("datasourceId").asc())
    (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
       .write.mode("overwrite").option("compression", codec).partitionBy("type").parquet(path))


def write_summaries(df: DataFrame, base: str, fmt: str = "csv") -> bool:
    """One output per period type; an unknown format writes nothing and returns False."""
    if fmt.lower() not in SUMMARY_FORMATS:
        log.warning("skipping unknown summary format %s", fmt)
        return False
    writer = df.write.mode("overwrite").partitionBy("type").format(fmt.lower())
    if fmt.lower() == "csv":
        writer = writer.option("header", True)
    writer.save(base)
    return True


def write_json_records(df: DataFrame, path: str) -> None:
    """One JSON object per row, nulls spelled out, decimals as numbers."""
    decimals_to_double(df).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def csv_to_json(spark: SparkSession, source, target: str, schema=None) -> None:
    from smogline.sources.measurements import read_measurements_wide

    write_json_records(read_measurements_wide(spark, source, schema), target)


def snapshot_dataset(spark: SparkSession, sources: dict[str, str], root: str, stamp: str) -> str:
    """Copy the named datasets below ``root/snapshot_ts=<stamp>``; an existing copy is refused.

    Of a versioned table the current folders are copied, and the copy is such a table again.
    """
    target = f"{root}/snapshot_ts={stamp}"
    for name, path in sources.items():
        if versions.is_versioned(spark, path):
            if versions.is_versioned(spark, f"{target}/{name}"):
                raise FileExistsError(f"{target}/{name}")
            with versions.change(spark, f"{target}/{name}"):
                for table in sorted({p.table for p in versions.parts(spark, path, table=None)}):
                    found = versions.parts(spark, path, table=table)
                    columns = list(STORE_FOLDERS[:len(found[0].values)])
                    schema = versions.schema_of(spark, path, columns, table)
                    copied = versions.read(spark, path, schema, columns, table=table)
                    order = [F.col("date").desc()] if "date" in schema.names else []
                    versions.write(copied, f"{target}/{name}", columns, order, {p.values for p in found}, table)
            continue
        found = spark.read.parquet(path).schema
        folders = [c for c in STORE_FOLDERS if c in found.names]
        # Folder names are text; left to itself Spark would read some of them as numbers or dates.
        schema = T.StructType([
            T.StructField(f.name, T.StringType() if f.name in folders else f.dataType) for f in found.fields])
        writer = spark.read.schema(schema).parquet(path).write.mode("errorifexists").option("compression", "zstd")
        if folders:
            writer = writer.partitionBy(*folders)
        try:
            writer.parquet(f"{target}/{name}")
        except AnalysisException as error:
            if error.getCondition() == "PATH_ALREADY_EXISTS":
                raise FileExistsError(f"{target}/{name}") from error
            raise
    return target


def write_type_offsets(offsets: DataFrame, path: str) -> None:
    """The six-row offset index as one small JSON file."""
    offsets.coalesce(1).write.mode("overwrite").json(path)
