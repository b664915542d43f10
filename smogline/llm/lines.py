"""Reversible line deduplication: sharded cuckoo filters backed by exact reference counts."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from smogline.llm.batches import BATCH_BYTES, BATCH_ROWS, column, map_batches
from smogline.llm.cuckoo import SLOTS, Cuckoo

WHITE = " \t\n\x0b\x0c\r"
MIN_CHARS = 20
MIN_DOCS = 3
SHARD_KEYS = 50_000
FILTER_BYTES = 64 << 20


def line_key(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """16 bytes that stand for a line: stripped of ASCII whitespace, A-Z lower-cased. None for short lines."""
    line = line.strip(WHITE)
    if len(line) < min_chars:
        return None
    return hashlib.blake2b(line.encode("utf-8").lower(), digest_size=16).digest()


def line_keys(text: str | None, min_chars: int = MIN_CHARS) -> list[bytes | None]:
    """The key of every line; null and empty are one empty line."""
    return [line_key(line, min_chars) for line in (text or "").split("\n")]


def _matrix(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), dtype=np.uint8).reshape(-1, 16)


class LineIndex:
    """Which documents hold which lines, in tables below ``path``.

    * ``refs``: a row (key, doc_id, delta) per line key a document holds: +1 on insertion,
      -1 on deletion. Nothing is ever rewritten, so every step can be undone.
    * ``counts``: the live references per key: number of documents, largest doc_id.
    * ``filters``: a cuckoo filter per shard of the keys that at least ``min_docs`` documents
      hold. Lines it does not contain need no look at the exact counts; those it contains
      are looked up, so its false positives never change a result.

    Every change writes a new version of counts and filters and then a row to ``log``, which
    makes it count; a change that was interrupted is overwritten by the next.
    """

    def __init__(self, spark: SparkSession, path: str, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS):
        self.spark, self.path, self.min_chars, self.min_docs = spark, path, min_chars, min_docs
        self.versions: list[int] = []
        self.shards = 0

    @classmethod
    def open(cls, spark: SparkSession, path: str, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> LineIndex:
        """An index written before, as of its last complete change."""
        index = cls(spark, path, min_chars, min_docs)
        log = spark.read.parquet(f"{path}/log").orderBy("version").collect()  # one row per change
        index.versions, index.shards = [r["version"] for r in log], log[-1]["shards"]
        return index

    def _table(self, name: str, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}/{version}")

    def refs(self) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/refs/{v}" for v in self.versions])

    def counts(self) -> DataFrame:
        return self._table("counts", self.versions[-1])

    def filters(self) -> DataFrame:
        return self._table("filters", self.versions[-1])

    def insert(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> None:
        """Add documents; one that is inserted again counts once. Rows without an id are no documents."""
        least = self.min_chars

        def pairs(batch: pa.RecordBatch) -> dict | None:
            keys, ids = [], []
            for i, t in zip(column(batch, "doc_id"), column(batch, "text")):
                own = {k for k in line_keys(t, least) if k}
                keys += own
                ids += [i] * len(own)
            return {"key": keys, "doc_id": ids} if keys else None

        rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).filter("doc_id IS NOT NULL")
        self._change(map_batches(rows, pairs, "key binary, doc_id long").withColumn("delta", F.lit(1)))

    def delete(self, ids: DataFrame, doc_id: str = "doc_id") -> None:
        """Take documents out, given by their ids; ids that are not in the index change nothing."""
        gone = ids.select(F.col(doc_id).cast("long").alias("doc_id")).distinct()
        live = self._live(self.refs()).join(gone, "doc_id", "left_semi")
        self._change(live.select("key", "doc_id", (-F.col("n")).cast("int").alias("delta")))

    @staticmethod
    def _live(refs: DataFrame) -> DataFrame:
        """Key and document of the references that hold; grouped by both, so no key is gathered in a task."""
        return refs.groupBy("key", "doc_id").agg(F.sum("delta").alias("n")).filter("n > 0")

    def _change(self, refs: DataFrame) -> None:
        version = self.versions[-1] + 1 if self.versions else 0
        here = f"{self.path}/refs/{version}"
        refs.write.mode("overwrite").option("compression", "zstd").parquet(here)
        changed = self.spark.read.parquet(here)
        touched, live = changed, changed
        if self.versions:  # what is known of the touched keys; the others keep their counts
            keys = changed.select("key").distinct()
            live = self.refs().join(keys, "key", "left_semi").union(changed)
            touched = keys
        counts = self._live(live).groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("top"))
        if self.versions:
            counts = counts.union(self.counts().join(touched, "key", "left_anti"))
        counts.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/counts/{version}")
        self._filter(version)
        (self.spark.range(1).select(F.lit(version).alias("version"), F.lit(self.shards).alias("shards")).coalesce(1)
         .write.mode("append").parquet(f"{self.path}/log"))
        self.versions.append(version)

    def _shard(self):
        return F.pmod(F.xxhash64("key"), F.lit(self.shards)).cast("int")

    def _repeated(self, version: int) -> DataFrame:
        return self._table("counts", version).filter(F.col("n_docs") >= self.min_docs).select("key")

    def _filter(self, version: int) -> None:
        now = self._repeated(version)
        if not self.versions:
            self.shards = max(1, -(-now.count() // SHARD_KEYS))
        old = self._repeated(self.versions[-1]) if self.versions else now.limit(0)
        before = self.filters() if self.versions else self.spark.createDataFrame([], "shard int, data binary")
        ups = now.join(old, "key", "left_anti").withColumn("up", F.lit(True))
        downs = old.join(now, "key", "left_anti").withColumn("up", F.lit(False))

        def table(shard: int, data: bytes | None) -> pa.Table:
            return pa.table({"shard": pa.array([shard], pa.int32()), "data": pa.array([data], pa.binary())})

        def update(changes: pa.Table, known: pa.Table) -> pa.Table:
            shard = (changes if changes.num_rows else known).column("shard")[0].as_py()
            up, down = [], []
            for key, rises in zip(changes.column("key").to_pylist(), changes.column("up").to_pylist()):
                (up if rises else down).append(key)
            if not known.num_rows:
                return table(shard, Cuckoo.built(_matrix(up)).dump())
            filter_ = Cuckoo.load(known.column("data")[0].as_py())
            if down:
                filter_.remove(_matrix(down))
            fits = not up or filter_.add(_matrix(up))
            return table(shard, filter_.dump() if fits else None)

        def rebuild(keys: pa.Table) -> pa.Table:
            return table(keys.column("shard")[0].as_py(), Cuckoo.built(_matrix(keys.column("key").to_pylist())).dump())

        changes = ups.union(downs).withColumn("shard", self._shard())
        here, there = f"{self.path}/updates/{version}", f"{self.path}/filters/{version}"
        (changes.groupBy("shard").cogroup(before.groupBy("shard")).applyInArrow(update, "shard int, data binary")
         .write.mode("overwrite").parquet(here))
        updated = self.spark.read.parquet(here)
        full = updated.filter("data IS NULL").select("shard")
        again = (now.withColumn("shard", self._shard()).join(full, "shard", "left_semi").groupBy("shard")
                 .applyInArrow(rebuild, "shard int, data binary"))
        updated.filter("data IS NOT NULL").union(again).write.mode("overwrite").parquet(there)

    def dedup(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", filter_bytes: int = FILTER_BYTES) -> DataFrame:
        """``docs`` without the lines that other documents keep, with ``n_lines`` and ``n_dropped``.

        A line goes if at least ``min_docs`` documents hold its key and another document has
        a larger id. Lines that stay are joined by line ends; a document may end up empty. A null
        text counts as one empty line and stays null, and so does a document without an id,
        whose lines are neither counted nor dropped. ``text``, ``n_lines`` and ``n_dropped`` are replaced where ``docs`` has
        them; other columns stay. An empty table gives no rows.

        Filters of up to ``filter_bytes`` together go to every task; larger ones stay in their
        table, and all lines are looked up in the exact counts, with the same result.
        """
        least = self.min_chars
        held = self.filters().agg(F.sum(F.octet_length("data")).alias("bytes")).first()["bytes"] or 0
        filters, shards = None, self.shards
        if held <= filter_bytes:
            shared = self.spark.sparkContext.broadcast({r["shard"]: bytes(r["data"]) for r in self.filters().collect()})
            filters = shared

        def candidates(batch: pa.RecordBatch) -> dict | None:
            keys, ids = [], []
            for i, t in zip(column(batch, "doc_id"), column(batch, "text")):
                own = {k for k in line_keys(t, least) if k}
                keys += own
                ids += [i] * len(own)
            if keys and filters is not None:
                at = np.flatnonzero(_asked(filters.value, keys, shards))
                keys, ids = [keys[i] for i in at], [ids[i] for i in at]
            return {"key": keys, "doc_id": ids} if keys else None

        rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).filter("doc_id IS NOT NULL")
        found = map_batches(rows, candidates, "key binary, doc_id long")
        repeated = self.counts().filter(F.col("n_docs") >= self.min_docs).select("key", "top")
        drops = (found.join(repeated, "key").filter("doc_id <> top").groupBy(F.col("doc_id").alias("_line_doc"))
                 .agg(F.collect_set("key").alias("_line_keys")))

        @arrow_udf("text string, n_lines long, n_dropped long")
        def without(texts: pa.Array, drop: pa.Array) -> pa.Array:
            out, total, gone = [], [], []
            for t, own in zip(texts.to_pylist(), drop.to_pylist()):
                lines = (t or "").split("\n")
                kept = lines
                if own is not None:
                    own = set(own)
                    kept = [line for line in lines if line_key(line, least) not in own]
                out.append(t if own is None else "\n".join(kept))
                total.append(len(lines))
                gone.append(len(lines) - len(kept))
            return pa.StructArray.from_arrays([pa.array(out, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                                              ["text", "n_lines", "n_dropped"])

        spark = self.spark
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        joined = docs.join(drops, docs[doc_id].cast("long") == drops["_line_doc"], "left")
        done = joined.withColumn("_line_out", without(docs[text], drops["_line_keys"]))
        new = {text: "_line_out.text", "n_lines": "_line_out.n_lines", "n_dropped": "_line_out.n_dropped"}
        kept = [F.col(new[c]).alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns]
        return done.select(*kept, *[F.col(new[c]).alias(c) for c in ("n_lines", "n_dropped") if c not in docs.columns])


def _shard_of(key: bytes, shards: int) -> int:
    """The shard that ``pmod(xxhash64(key), shards)`` gives a key."""
    return ((xxhash.xxh64_intdigest(key, 42) + (1 << 63)) % (1 << 64) - (1 << 63)) % shards


def _asked(filters: dict[int, bytes], keys: list[bytes], shards: int) -> np.ndarray:
    """Which keys their shard's filter contains; a shard without a filter has none."""
    shard, matrix = np.array([_shard_of(k, shards) for k in keys]), _matrix(keys)
    stays = np.zeros(len(keys), dtype=bool)
    for own in np.unique(shard):
        if int(own) in filters:
            here = shard == own
            stays[here] = Cuckoo(np.frombuffer(filters[int(own)], dtype=np.uint16).reshape(-1, SLOTS)).contains(matrix[here])
    return stays
