"""Mixing sources to target weights by systematic sampling, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from smogline.session import cut

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK_ROWS = 100_000


def word_count(text: Column) -> Column:
    """Words between spaces and ASCII control whitespace; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_key(source: Column) -> Column:
    """A key that is never null and keeps null apart from the empty string."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit(""))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source``, ``key``, ``source_size``, ``weight`` and ``target`` per source of ``sizes``.

    Sources in code point order, null last, take the weights in turn. Targets share the
    sum of all sizes by weight; none exceeds ``most`` times its source's size, what is cut
    off goes to the others by weight. Sources ordered by size per weight reach their limit
    one after the other, so one running sum finds the share at which the rest stops. The
    windows hold one row per source.
    """
    per = sizes.groupBy("source", "key").agg(F.sum("size").alias("source_size"))
    turn = F.pmod(F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights)))
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), turn.cast("int") + 1))
    limit = F.col("source_size") * most
    order = W.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    rest_size = F.sum("source_size").over(W.partitionBy()) - F.coalesce(F.sum(limit).over(before), F.lit(0))
    rest_weight = F.sum("weight").over(W.partitionBy()) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    per = per.select("*", F.row_number().over(order).alias("at"), (rest_size / rest_weight).alias("share"))
    free = F.when(limit / F.col("weight") >= F.col("share"), F.struct("at", "share"))
    final = F.min(free).over(W.partitionBy())["share"]
    target = F.least(limit.cast("double"), F.col("weight") * final)
    return per.select("source", "key", "source_size", "weight", target.alias("target"))


def copies(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 42,
           block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``sizes`` (with id, source, key, size) with ``source_size``, ``target`` and ``copies``.

    Every document of a source is expected target / source_size times. In the order
    (size, MD5 of the id, id) these expectations are summed up from an offset in [0, 1)
    that the source's name and ``seed`` fix, and a document is emitted once per integer its
    sum crosses: at least floor, at most ceil of the expectation. Neighbours in this order
    have about the same size, so the words taken come near the target as well.

    The position is exact at any size: rows are counted in blocks of (source, size, first
    digits of the MD5), a running sum over blocks gives each block's start. Only groups of
    more than ``block_rows`` rows of one size take digits, so no window holds a hot source.
    """
    digest = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")))
    n = F.col("n")
    crowded = (sizes.groupBy("key", "size").agg(F.count("*").alias("n")).filter(n > block_rows)
               .select("key", "size", F.ceil(F.log(16.0, n / block_rows)).cast("int").alias("digits")))
    rows = (sizes.withColumn("digest", digest).join(crowded, ["key", "size"], "left")
            .withColumn("block", F.substring(F.col("digest"), F.lit(1), F.coalesce("digits", F.lit(0)))).drop("digits")
            .repartition("key", "size", "block"))  # else the join's dealing by (key, size) would serve the window as well
    starts = rows.groupBy("key", "size", "block").agg(F.count("*").alias("n"))
    running = W.partitionBy("key").orderBy("size", "block").rowsBetween(W.unboundedPreceding, -1)
    starts = starts.select("key", "size", "block", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("start"))
    offset = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), "key")), 1, 8), 16, 10).cast("double") / 2.0**32
    rates = targets(sizes, weights, most).select(
        "key", "source_size", "target", offset.alias("offset"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"))
    place = F.row_number().over(W.partitionBy("key", "size", "block").orderBy("digest", F.col("id").asc_nulls_last()))
    placed = rows.withColumn("place", place).join(starts.join(rates, "key"), ["key", "size", "block"])
    last = F.col("start") + F.col("place")
    crossed = F.floor(F.col("offset") + last * F.col("rate")) - F.floor(F.col("offset") + (last - 1) * F.col("rate"))
    return placed.withColumn("copies", crossed.cast("long")).drop("digest", "block", "place", "start", "offset", "rate")


def sizes_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Id, source, size and a hash of the text of every document, cut: texts are read once."""
    return cut(docs.select(F.col(doc_id).alias("id"), F.col(source).alias("source"), source_key(F.col(source)).alias("key"),
                           word_count(F.col(text)).alias("size"), F.xxhash64(text).alias("hash")))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 42) -> DataFrame:
    """The documents of the mix: rows of ``docs`` (doc_id, text, source, ...), each as often as taken.

    Documents without words, and a null text, have size 0: they cost nothing and are
    emitted like others of their source. Repeated rows are told apart by a running number,
    so each is taken on its own. An empty table gives an empty mix; all columns are kept.
    """
    # ids get a key that is never null: a null-safe join would not keep the dealing that the window needs as well,
    # and the texts would be dealt twice
    same = ["_mix_id", "_mix_key", "_mix_size", "_mix_hash"]
    planned = copies(sizes_of(docs), weights, most, seed).filter("copies > 0").withColumn("id", source_key(F.col("id")))
    taken = planned.select(*[F.col(c.removeprefix("_mix_")).alias(c) for c in same], "copies")
    # the copies of identical rows are listed, largest first, and dealt to the rows in turn
    dealt = taken.groupBy(*same).agg(F.sort_array(F.collect_list("copies"), asc=False).alias("_mix_dealt"))
    mine = [source_key(F.col("doc_id")), source_key(F.col("source")), word_count(F.col("text")), F.xxhash64("text")]
    joined = docs.withColumns(dict(zip(same, mine))).join(dealt, same)
    turn = F.row_number().over(W.partitionBy(*same).orderBy("_mix_hash"))
    n = F.try_element_at(F.col("_mix_dealt"), F.col("_turn"))
    return (joined.withColumn("_turn", turn).withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.coalesce(n, F.lit(0)).cast("int"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
