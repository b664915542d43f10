"""Filling missing readings from the series itself and from the nearest sensors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogline.functions.geo import sensor_key
from smogline.functions.values import present, quoted, rel_diff
from smogline.operators.joins import long_side, lookup_join, null_safe_join
from smogline.operators.quality import drop_missing, missing_rate
from smogline.operators.series import SEGMENT_ROWS, Series, null_pieces, null_rows, place_rows, stitch_pieces
from smogline.operators.spatial import distinct_sensors, nearest_neighbors, neighbor_lists
from smogline.schema import SENSOR
from smogline.session import cut

REACH = 5
THRESHOLD = 0.05


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def _gap_table(framed: DataFrame, window, value: Column, threshold: float) -> DataFrame:
    """Mark isolated gaps and tabulate whether each is filled.

    ``_fill`` is the mean of the two neighbours. The mean it is compared with also holds
    gaps filled earlier in the frame; gaps are at least two rows apart, so at most two of
    them can lie in the five rows before. ``_table`` has one bit for each of the four
    ways those two can have gone: bit ``a + 2*b`` for nearest filled (a) and second
    nearest filled (b).
    """
    around = window.rowsBetween(-REACH, REACH)
    df = (framed
          .withColumn("_prev", F.lag(value).over(window)).withColumn("_next", F.lead(value).over(window))
          .withColumn("_sum", F.coalesce(F.sum(value).over(around), F.lit(0.0)))
          .withColumn("_cnt", F.count(value).over(around)))
    gap = value.isNull() & F.col("_prev").isNotNull() & F.col("_next").isNotNull()
    df = df.withColumn("_fill", F.when(gap, (F.col("_prev") + F.col("_next")) / 2))
    df = df.withColumn("_earlier", F.array_compact(F.array(*[
        F.lag("_fill", k).over(window) for k in range(2, REACH + 1)])))
    df = df.withColumn("_later", F.coalesce(*[F.lead("_fill", k).over(window) for k in range(2, REACH + 1)]))
    near, far = F.try_element_at("_earlier", F.lit(1)), F.try_element_at("_earlier", F.lit(2))

    def accepted(a: int, b: int) -> Column:
        extra = [c for c, used in ((near, a), (far, b)) if used]
        total = reduce(lambda s, c: s + F.coalesce(c, F.lit(0.0)), extra, F.col("_sum"))
        count = reduce(lambda s, c: s + c.isNotNull().cast("int"), extra, F.col("_cnt"))
        mean = total / F.nullif(count, F.lit(0))
        distance = rel_diff(F.col("_fill"), mean)
        return F.coalesce(_finite(F.col("_fill")) & _finite(mean) & (distance <= threshold), F.lit(False))

    table = reduce(lambda s, c: s + c, [
        accepted(a, b).cast("int") * (1 << (a + 2 * b)) for b in (0, 1) for a in (0, 1)])
    linked = F.col("_fill").isNotNull() & ((F.size("_earlier") > 0) | F.col("_later").isNotNull())
    return (df.withColumn("_table", F.when(F.col("_fill").isNotNull(), table))
            .withColumn("_linked", linked)
            .drop("_prev", "_next", "_sum", "_cnt", "_earlier", "_later"))


def _maps(tables) -> "np.ndarray":
    """The state after a gap for each state before it, from the gaps' tables."""
    import numpy as np

    states = np.arange(4)
    filled = (tables[:, None] >> states) & 1
    return filled + 2 * (states & 1)


def _chain(maps) -> "np.ndarray":
    """Row i of the result: where each start leads after the maps 0 to i, by doubling steps."""
    import numpy as np

    out, step = maps.copy(), 1
    while step < len(out):
        out[step:] = np.take_along_axis(out[step:], out[:-step].copy(), axis=1)
        step *= 2
    return out


def _follow_tables(linked: DataFrame, keys) -> DataFrame:
    """Walk the linked gaps of each segment in order, for all four possible starts at once.

    Gives keys, ``_seg``, ``_pos`` and per gap: ``_outcome``, whose bit s tells if the gap is
    filled when the segment starts in state s; ``_after``, two bits each, the state reached
    from every start. Only the gap's place and table go to Python.
    """
    safe = {k: f"k{i}" for i, k in enumerate(keys)}  # grouped maps cannot take names with dots
    plain = linked.select(*[quoted(k).alias(v) for k, v in safe.items()], "_seg", "_pos", "_table")
    schema = T.StructType([*[f for f in plain.schema.fields if f.name != "_table"],
                           T.StructField("_outcome", T.IntegerType()), T.StructField("_after", T.IntegerType())])

    def walk(table):
        import numpy as np
        import pyarrow as pa

        table = table.sort_by("_pos")
        after = _chain(_maps(table.column("_table").to_numpy().astype(np.int64)))
        outcome = ((after & 1) << np.arange(4)).sum(axis=1)
        packed = (after << (2 * np.arange(4))).sum(axis=1)
        return (table.drop_columns(["_table"]).append_column("_outcome", pa.array(outcome.astype(np.int32)))
                .append_column("_after", pa.array(packed.astype(np.int32))))

    return plain.groupBy(*safe.values(), "_seg").applyInArrow(walk, schema).withColumnsRenamed({v: k for k, v in safe.items()})


def _segment_starts(walked: DataFrame, keys) -> DataFrame:
    """The state each segment starts in, from the maps of the segments before it.

    One row per segment of ``segment_rows`` readings enters, so a sensor's group is small
    however long its series is.
    """
    maps = walked.groupBy(*keys, "_seg").agg(F.max_by("_after", "_pos").alias("_map"))
    schema = T.StructType([*[f for f in maps.schema.fields if f.name != "_map"],
                           T.StructField("_start", T.IntegerType())])

    def carry(table):
        import pyarrow as pa

        table = table.sort_by("_seg")
        state, starts = 0, []
        for packed in table.column("_map").to_pylist():
            starts.append(state)
            state = (packed >> (2 * state)) & 3
        return table.drop_columns(["_map"]).append_column("_start", pa.array(starts, pa.int32()))

    return maps.groupBy(*keys).applyInArrow(carry, schema)


def fill_single_gaps(series: Series, col: str, threshold: float = THRESHOLD, mode: str = "exact") -> Series:
    """Fill a lone missing value by the mean of its neighbours when that mean is close to
    the mean of the rows around.

    In "exact" mode gaps filled earlier count in later means. Gaps that influence each
    other are walked in order, segment by segment; all others are decided in place.
    "window" mode looks at original values only and may decide differently.
    """
    if mode not in ("exact", "window"):
        raise ValueError(f"unknown mode {mode!r}")
    keys, columns = series.keys, series.df.columns
    if series.split and mode == "exact":  # read twice below; the places of a long series are costly
        series = series.with_df(cut(series.df))
    framed, window = series.framed(REACH + 1)
    value = present(col)
    gaps = _gap_table(framed, window, value, threshold).filter("_core").drop("_core")

    def done(df: DataFrame, filled: Column) -> DataFrame:
        return df.withColumn(col, F.when(filled, F.col("_fill")).otherwise(value)).select(
            *[quoted(c) for c in columns])

    at_start = F.coalesce(F.col("_table").bitwiseAND(1) == 1, F.lit(False))
    if mode == "window":
        return series.with_df(done(gaps, at_start))
    alone = done(gaps.filter("not _linked"), at_start)
    linked = gaps.filter("_linked")
    if series.split:  # few, but read three times
        linked = cut(linked)
    walked = _follow_tables(linked, keys)
    if series.split:
        walked = null_safe_join(walked, long_side(_segment_starts(walked, keys)), [*keys, "_seg"])
        filled = F.expr("(shiftright(_outcome, _start) & 1) = 1")
    else:
        filled = F.col("_outcome").bitwiseAND(1) == 1
    decided = walked.select(*keys, "_seg", "_pos", F.coalesce(filled, F.lit(False)).alias("_filled"))
    linked = null_safe_join(linked, long_side(decided), [*keys, "_seg", "_pos"])
    return series.with_df(alone.unionByName(done(linked, F.col("_filled"))))


def neighbor_means(rows: DataFrame, neighbors: DataFrame, values: DataFrame, ts: str, col: str,
                   row_id: list[str]) -> DataFrame:
    """Mean of the neighbours' values at the instant of each row, nulls ignored.

    ``rows`` needs ``key`` (the sensor), ``ts`` and ``row_id``. Values are summed per
    (sensor, instant) before the join, so it neither multiplies duplicates nor piles
    them on one task, and only at the instants that are asked for. Rows without any
    neighbour value are absent.
    """
    lists = neighbor_lists(neighbors).withColumnRenamed("key1", "key")
    # An outer join, as in an inner one the rows might be broadcast; a null ``_other`` matches nothing.
    wanted = (lookup_join(rows.select("key", quoted(ts).alias("_at"), *row_id), lists, ["key"], "left")
              .select(*row_id, "_at", F.explode_outer("neighbors").alias("_other")))
    sums = (values.filter(present(col).isNotNull())
            .select(F.col("key").alias("_other"), quoted(ts).alias("_at"), quoted(col))
            .join(long_side(wanted.select("_other", "_at").distinct()), ["_other", "_at"], "left_semi")
            .groupBy("_other", "_at")
            .agg(F.sum(quoted(col)).alias("_sum"), F.count("*").alias("_cnt")))
    return (wanted.join(long_side(sums), ["_other", "_at"]).groupBy(*row_id)
            .agg((F.sum("_sum") / F.sum("_cnt")).alias("nb_mean")))


def fill_gap_chunks(series: Series, neighbors: DataFrame, col: str, threshold: float = THRESHOLD) -> Series:
    """Fill runs of two or more missing values with the neighbours' means.

    A run is filled when the value before it (or, missing that, after it) is close to the
    mean of the neighbour means; rows without a neighbour value stay missing.
    """
    keys, columns, ts = list(series.keys), series.df.columns, series.ts
    series = series.with_df(series.df.withColumn(col, present(col)))
    value = quoted(col)
    framed, window = series.framed(1)
    beside_null = (F.coalesce(F.lag(value.isNull()).over(window), F.lit(False))
                   | F.coalesce(F.lead(value.isNull()).over(window), F.lit(False)))
    kept = (framed.withColumn("_gap", value.isNull() & beside_null)
            .filter("_core and not _gap").select(*[quoted(c) for c in columns]))
    # The gap rows are few and are read more than once below, so they are written once.
    gaps = cut(null_rows(series, col, beside_null=True).withColumn("key", sensor_key(keys))
               .withColumn("_gap_id", F.monotonically_increasing_id()))
    means = neighbor_means(gaps, neighbors, series.df.withColumn("key", sensor_key(keys)), ts, col, ["_gap_id"])
    filled = gaps.join(long_side(means), "_gap_id", "left")
    close = _finite(F.col("_edge")) & _finite(F.col("_level")) & (rel_diff("_edge", "_level") <= threshold)
    if not series.split:  # a run lies in one segment, whose rows are bounded
        run = Window.partitionBy(*keys, "_seg", "_piece")
        filled = (filled.withColumn("_level", F.avg("nb_mean").over(run))
                  .withColumn("_edge", F.coalesce(F.min_by("_before", "_pos").over(run), F.max_by("_after", "_pos").over(run)))
                  .withColumn("_ok", close))
    else:
        pieces = cut(stitch_pieces(series, null_pieces(series, gaps)))
        edges = pieces.groupBy(*keys, "run").agg(
            F.coalesce(F.min_by("edge_before", "start"), F.max_by("edge_after", "start")).alias("_edge"))
        filled = cut(null_safe_join(filled, long_side(pieces.select(*keys, "_seg", "_piece", "run")), [*keys, "_seg", "_piece"], "left"))
        levels = filled.groupBy(*keys, "run").agg(F.avg("nb_mean").alias("_level"))
        good = null_safe_join(levels, long_side(edges), [*keys, "run"]).filter(close)
        good = null_safe_join(pieces, long_side(good.select(*keys, "run")), [*keys, "run"], "left_semi").select(
            *keys, "_seg", "_piece", F.lit(True).alias("_ok"))
        filled = null_safe_join(filled, long_side(good), [*keys, "_seg", "_piece"], "left")
    filled = filled.withColumn(col, F.when(F.col("_ok"), F.col("nb_mean"))).select(
        *[quoted(c) for c in columns])
    return series.with_df(kept.unionByName(filled))


def qa_qc_impute(df: DataFrame, ts: str, col: str, k: int = 3, threshold: float = THRESHOLD,
                 keys=SENSOR, tie=(), lat: str = "locationLatitude", lon: str = "locationLongitude",
                 segment_rows: int = SEGMENT_ROWS, longest: int | None = None) -> DataFrame:
    """Treat missing readings (null or NaN) according to their overall share and say so in ``impute_flag``.

    Below 5 % they are dropped, from 20 % they are left, in between lone gaps and then
    longer runs are filled. ``longest`` is an upper bound of any sensor's rows, if known.
    """
    df = df.withColumn(col, present(col))
    if longest is None:  # one pass for the share and the longest series
        shape = (df.groupBy(*keys).agg(F.count("*").alias("n"), F.count(quoted(col)).alias("known"))
                 .agg(F.max("n").alias("longest"), F.sum("n").alias("n"), F.sum("known").alias("known")).first())
        longest = shape["longest"] or 0
        rate = (shape["n"] - shape["known"]) / shape["n"] if shape["n"] else None
    else:
        rate = missing_rate(df, col).first()["missing_rate"]
    if rate is None or rate >= 0.20:
        return df.withColumn("impute_flag", F.lit("no_impute_ge20"))
    if rate < 0.05:
        return drop_missing(df, col)
    neighbors = nearest_neighbors(distinct_sensors(df, keys, lat, lon), k)
    series = fill_single_gaps(place_rows(df, ts, keys, tie, segment_rows, longest=longest), col, threshold)
    # Read by the kept rows, the gaps and the neighbours' values: written once.
    series = series.with_df(cut(series.df))
    return fill_gap_chunks(series, neighbors, col, threshold).rows().withColumn(
        "impute_flag", F.lit("impute_5to20"))
