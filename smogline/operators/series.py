"""Row-ordered work inside each sensor's series: frames, rolling spread, runs of nulls.

A sensor's rows are numbered and cut into segments of at most ``SEGMENT_ROWS``. A window
then runs per (sensor, segment); rows close to a border are repeated in the segment next
door, so frames that look a few rows around see what they would see in the whole series.
A sensor with a third of all readings is thus spread over many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from smogline.functions.values import present, quoted
from smogline.operators.joins import content_hash, long_side, null_safe_join
from smogline.schema import SENSOR

SEGMENT_ROWS = 500_000
BLOCK_SECONDS = 3600
BLOCKS_PER_GROUP = 1024
PLACING = ("_pos", "_seg", "_tie")


@dataclass(frozen=True)
class Series:
    """Rows with ``_pos`` (place in the sensor's series, from 0) and ``_seg`` (segment)."""

    df: DataFrame
    ts: str
    keys: tuple[str, ...]
    order: tuple[Column, ...]  # what a window over a segment sorts by
    segment_rows: int | None  # None: no sensor needed splitting, every segment is 0

    @property
    def split(self) -> bool:
        return self.segment_rows is not None

    def with_df(self, df: DataFrame) -> "Series":
        return replace(self, df=df)

    def rows(self) -> DataFrame:
        return self.df.drop(*PLACING)

    def framed(self, reach: int) -> tuple[DataFrame, WindowSpec]:
        """Rows plus the ``reach`` rows beyond each border (``_core`` is false for those),
        and the window to look around in."""
        window = Window.partitionBy(*self.keys, "_seg").orderBy(*self.order)
        if not self.split:
            return self.df.withColumn("_core", F.lit(True)), window
        size = self.segment_rows
        if reach > size:
            raise ValueError("segments must be longer than the frame")
        first = F.greatest(F.col("_pos") - reach, F.lit(0))
        homes = F.array_distinct(F.array(*[
            F.floor(p / size).cast("bigint") for p in (first, F.col("_pos"), F.col("_pos") + reach)]))
        framed = (self.df.withColumnRenamed("_seg", "_home").withColumn("_seg", F.explode(homes))
                  .withColumn("_core", F.col("_seg") == F.col("_home")).drop("_home"))
        return framed, window


def longest_series(df: DataFrame, keys=SENSOR) -> int:
    """The most rows any sensor has."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0


def place_rows(df: DataFrame, ts: str, keys=SENSOR, tie=(), segment_rows: int = SEGMENT_ROWS,
               block_seconds: int = BLOCK_SECONDS, longest: int | None = None) -> Series:
    """Number every sensor's rows by time, then by the ``tie`` columns, then by content.

    Rows without a time come last, in blocks given by a hash of their content, so that they
    can be spread as well; the order is the same whether a series is split or not.

    The last makes the order total: computed twice, also on another machine, it is the same.
    One small job counts rows per sensor, unless the caller knows an upper bound
    (``longest``). If none exceeds ``segment_rows`` a plain window does. Otherwise rows are numbered within time blocks and shifted by the number of rows
    in earlier blocks. The shifts come from block counts in two steps (blocks within a
    group, groups within a sensor), so no task sees more than a small share of them.
    """
    keys = tuple(keys)
    rows = df.withColumn("_tie", content_hash(df))
    lot = F.pmod(F.col("_tie"), F.lit(BLOCKS_PER_GROUP))
    order = (quoted(ts).asc_nulls_last(), F.when(quoted(ts).isNull(), lot), *tie, F.col("_tie"))
    if longest is None:
        longest = longest_series(df, keys)
    if longest <= segment_rows:
        # Later windows sort by the same columns, so the one sort made here serves them all.
        number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        placed = rows.withColumn("_pos", number.cast("bigint") - 1).withColumn("_seg", F.lit(0).cast("bigint"))
        return Series(placed, ts, keys, order, None)

    block = F.coalesce(F.floor(F.unix_micros(quoted(ts)) / (block_seconds * 1_000_000)), F.lit(2**61) + lot).cast("bigint")
    rows = rows.withColumn("_block", block)
    counts = (rows.groupBy(*keys, "_block").agg(F.count("*").alias("_n"))
              .withColumn("_group", F.floor(F.col("_block") / BLOCKS_PER_GROUP)))
    before = (Window.unboundedPreceding, -1)
    groups = counts.groupBy(*keys, "_group").agg(F.sum("_n").alias("_gn"))
    groups = groups.withColumn("_skip", F.coalesce(
        F.sum("_gn").over(Window.partitionBy(*keys).orderBy("_group").rowsBetween(*before)), F.lit(0)))
    counts = counts.withColumn("_within", F.coalesce(
        F.sum("_n").over(Window.partitionBy(*keys, "_group").orderBy("_block").rowsBetween(*before)), F.lit(0)))
    shifts = null_safe_join(counts, long_side(groups), [*keys, "_group"]).select(
        *keys, "_block", (F.col("_within") + F.col("_skip")).alias("_shift"))
    rows = rows.withColumn("_rn", F.row_number().over(
        Window.partitionBy(*keys, "_block").orderBy(*order)).cast("bigint"))
    placed = null_safe_join(rows, long_side(shifts), [*keys, "_block"]).select(
        *[quoted(c) for c in df.columns], (F.col("_shift") + F.col("_rn") - 1).alias("_pos"))
    placed = placed.withColumn("_seg", F.floor(F.col("_pos") / segment_rows).cast("bigint"))
    return Series(placed, ts, keys, (F.col("_pos").asc(),), segment_rows)


def rolling_sd(series: Series, col: str, before: int = 5, after: int = 5, name: str = "rolling_sd") -> Series:
    """Sample deviation over the rows around, nulls and NaN ignored; null with fewer than two values."""
    framed, window = series.framed(max(before, after))
    out = framed.withColumn(name, F.stddev_samp(present(col)).over(window.rowsBetween(-before, after)))
    return series.with_df(out.filter("_core").drop("_core"))


def drop_flatline(df: DataFrame, ts: str, col: str, before: int = 5, after: int = 5, keys=SENSOR, tie=(),
                  segment_rows: int = SEGMENT_ROWS, longest: int | None = None) -> DataFrame:
    """Drop rows whose surrounding values have no spread at all.

    Zero deviation is the same as two or more values with equal minimum and maximum,
    a test that rounding cannot disturb. NaN is no value.
    """
    series = place_rows(df, ts, keys, tie, segment_rows, longest=longest)
    framed, window = series.framed(max(before, after))
    around = window.rowsBetween(-before, after)
    value = present(col)
    flat = ((F.count(value).over(around) >= 2)
            & (F.min(value).over(around) == F.max(value).over(around)))
    out = framed.withColumn("_flat", F.coalesce(flat, F.lit(False)))
    return out.filter("_core and not _flat").drop("_core", "_flat", *PLACING)


def null_rows(series: Series, col: str, beside_null: bool = False) -> DataFrame:
    """Missing (null or NaN) rows with the values next to them and ``_piece``, which is equal for the
    nulls that follow one another in a segment. ``beside_null`` leaves out lone ones."""
    framed, window = series.framed(1)
    value = present(col)
    missing = F.col("_core") & value.isNull()
    rows = (framed.withColumn("_before", F.lag(value).over(window))
            .withColumn("_after", F.lead(value).over(window)))
    if beside_null:
        rows = (rows.withColumn("_long", F.coalesce(F.lag(value.isNull()).over(window), F.lit(False))
                                | F.coalesce(F.lead(value.isNull()).over(window), F.lit(False))))
        missing = missing & F.col("_long")
    rows = rows.filter(missing).withColumn("_piece", F.col("_pos") - F.row_number().over(window))
    return rows.drop("_core", "_long")


def null_pieces(series: Series, nulls: DataFrame) -> DataFrame:
    """Runs of nulls as far as they lie in one segment."""
    return nulls.groupBy(*series.keys, "_seg", "_piece").agg(
        F.min("_pos").alias("start"), F.max("_pos").alias("stop"),
        F.min(quoted(series.ts)).alias("start_time"), F.max(quoted(series.ts)).alias("stop_time"),
        F.min_by("_before", "_pos").alias("edge_before"), F.max_by("_after", "_pos").alias("edge_after"))


def stitch_pieces(series: Series, pieces: DataFrame) -> DataFrame:
    """Add ``run`` (first position of the whole run) to pieces cut by segment borders.

    Only pieces touching a border can continue next door, at most two per segment, so
    the ordered pass over a sensor sees two rows per ``segment_rows`` readings.
    """
    if not series.split:
        return pieces.withColumn("run", F.col("start"))
    size = F.lit(series.segment_rows)
    cut = (F.col("start") % size == 0) | (F.col("stop") % size == size - 1)
    window = Window.partitionBy(*series.keys).orderBy("start")
    touching = (pieces.filter(cut)
                .withColumn("_prev", F.lag("stop").over(window))
                .withColumn("run", F.last(
                    F.when(F.col("_prev").isNull() | (F.col("_prev") + 1 != F.col("start")), F.col("start")),
                    ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0)))
                .drop("_prev"))
    return pieces.filter(~cut).withColumn("run", F.col("start")).unionByName(touching)


def null_runs(series: Series, col: str) -> DataFrame:
    """Every maximal run of nulls: first and last position and time, length, values beside it."""
    pieces = stitch_pieces(series, null_pieces(series, null_rows(series, col)))
    return pieces.groupBy(*series.keys, "run").agg(
        F.max("stop").alias("stop"),
        (F.max("stop") - F.col("run") + 1).alias("length"),
        F.min("start_time").alias("start_time"), F.max("stop_time").alias("stop_time"),
        F.min_by("edge_before", "start").alias("edge_before"),
        F.max_by("edge_after", "start").alias("edge_after"),
    ).withColumnRenamed("run", "start")
