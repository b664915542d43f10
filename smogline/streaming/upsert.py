"""Stream hourly means into the measurement store."""

from __future__ import annotations

import json
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from smogline.operators.quality import drop_invalid_qc, keep_valid
from smogline.operators.rollup import label_hours
from smogline.plans.metric_run import merge_hours, source_cells, store_change, write_index
from smogline.schema import MetricSpec
from smogline.session import cut, scratch_scope
from smogline.sources import versions
from smogline.streaming.ingest import stream_hourly

log = logging.getLogger(__name__)


def hour_cells(hours: DataFrame) -> DataFrame:
    """Valid hours of single sources as cells."""
    return source_cells(label_hours(keep_valid(hours)), "metric", ("hour",))


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream when it made the checkpoint folder; a new folder has a new one."""
    return json.loads(versions.read_text(spark, f"{checkpoint}/metadata"))["id"]


def upsert_batch(batch: DataFrame, target: str, stream: str | None = None, number: int = 0) -> None:
    """Merge one micro-batch and renew the days to years it touches, as one change of the store.

    With a ``stream`` the change also records the batch's ``number``. A batch not above the recorded one is a
    replay and does nothing, even if others have changed its cells since; only the index file is made again,
    as the run before may have stopped before writing it.
    """
    spark = batch.sparkSession
    if stream is not None and versions.marks(spark, target).get(stream, -1) >= number:
        log.info("%s: batch %s of %s is already in", target, number, stream)
        write_index(spark, target)
        return
    with scratch_scope(spark), store_change(spark, target, None if stream is None else (stream, number)):
        merge_hours(spark, cut(hour_cells(batch)), target)


def stream_upsert(hours: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Start merging ``stream_hourly`` output into the store at ``target``, as far as data
    has landed. One query writes a store at a time; each batch counts once, however often it is run."""
    def merge(batch: DataFrame, number: int) -> None:
        upsert_batch(batch, target, stream_name(batch.sparkSession, checkpoint), number)

    return (hours.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .foreachBatch(merge).trigger(availableNow=True).start())


def stream_metric(rows: DataFrame, spec: MetricSpec, target: str, checkpoint: str,
                  lateness: str = "3 hours") -> StreamingQuery:
    """Stream one metric's readings into its store as a refreshing run would: rows of invalid
    quality are left out, hours are rolled up per source, longer periods follow."""
    valid = drop_invalid_qc(rows, spec)
    hours = stream_hourly(valid, spec.time_column, spec.col_name, lateness, spec.min_obs_per_hour)
    return stream_upsert(hours, target, checkpoint)
