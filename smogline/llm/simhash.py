"""SimHash near-deduplication with pigeonhole blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.llm.batches import column, map_batches, map_stream
from smogline.llm.graph import components
from smogline.session import cut

SHINGLE = 3
DISTANCE = 3
SEED = 42
CROWDED = 4096
CHUNK = 500_000


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text, A-Z lower-cased: a bit is 1 if set in over half the shingles' XXH64.

    Words end at spaces and ASCII control whitespace. Fewer words than ``shingle`` are one
    shingle, no words (and null) give zero. Shingles that repeat count as often.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined, width = b" ".join(words), min(shingle, len(words))
    ends = [end + i for i, end in enumerate(accumulate(map(len, words)))]
    starts = [0, *[end + 1 for end in ends]]
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    spans = list(zip(starts, ends[width - 1:]))
    for i in range(0, len(spans), 1 << 15):
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans[i:i + (1 << 15)]], dtype="<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(total * 2 > len(spans), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fingerprint (the 64 bits as a long) of every row."""

    def run(batch: pa.RecordBatch) -> dict:
        found = np.array([fingerprint(t, shingle) for t in column(batch, "text")], dtype=np.uint64)
        return {"doc_id": column(batch, "doc_id"), "fp": found.view(np.int64)}

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return map_batches(rows, run, "doc_id long, fp long")


def _split(rows: DataFrame, bits: int, blocks: int) -> DataFrame:
    """Every row once per block of its remaining ``bits``, the block's value added to its key."""
    width = bits // blocks
    pieces = []
    for i in range(blocks):
        wide = width if i < blocks - 1 else bits - width * (blocks - 1)  # the last takes what is left over
        low, high = i * width, i * width + wide
        value = F.shiftrightunsigned("rest", low).bitwiseAND(F.lit((1 << wide) - 1))
        below = F.col("rest").bitwiseAND(F.lit((1 << low) - 1))
        above = F.shiftleft(F.shiftrightunsigned("rest", high), low) if high < 64 else F.lit(0).cast("long")
        pieces.append(F.struct(F.xxhash64("key", F.lit(i), value).alias("key"), above.bitwiseOR(below).alias("rest")))
    return rows.withColumn("_p", F.explode(F.array(*pieces))).select("fp", "_p.key", "_p.rest")


def _forest(keys: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what is linked within each run of equal keys, fewer than there are rows."""
    n = len(keys)
    root = np.arange(n)
    start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    last = np.repeat(np.r_[start[1:], n], np.diff(np.r_[start, n])) - 1
    active, lag = np.flatnonzero(last > root), 1
    while len(active):
        for part in np.array_split(active, max(1, len(active) >> 20)):
            near = part[np.bitwise_count(prints[part] ^ prints[part + lag]) <= distance]
            other = near + lag
            while len(near):
                a, b = root[near], root[other]
                apart = a != b
                near, other, a, b = near[apart], other[apart], a[apart], b[apart]
                if len(near):
                    np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
                    while (root[root] != root).any():
                        root = root[root]
        lag += 1
        active = active[last[active] >= active + lag]
    moved = np.flatnonzero(root != np.arange(n))
    return prints[moved], prints[root[moved]]


def links(prints: DataFrame, distance: int = DISTANCE, crowded: int = CROWDED) -> DataFrame:
    """Edges ``u``, ``v`` between different fingerprints (column ``fp``) that connect all pairs within ``distance`` bits.

    Of ``distance + 1`` blocks two close fingerprints share one, so they meet under that
    block's value. A block value of more than ``crowded`` fingerprints is split again by
    blocks of the remaining bits, up to three times. Each meeting place compares its own
    fingerprints and hands on a spanning forest instead of pairs.
    """
    blocks, bits = distance + 1, 64
    rows = prints.select("fp", F.lit(0).cast("long").alias("key"), F.col("fp").alias("rest"))
    calm = []
    for level in range(3):
        rows = cut(_split(rows, bits, blocks))
        bits -= bits // blocks
        full = cut(rows.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > crowded).select("key"))
        if level == 2 or full.isEmpty():
            calm.append(rows.select("fp", "key"))
            break
        calm.append(rows.join(full, "key", "left_anti").select("fp", "key"))
        rows = rows.join(full, "key", "left_semi")
    found = calm[0]
    for more in calm[1:]:
        found = found.union(more)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[dict | None]:
        keys, prints, held = [], [], 0

        def flush(all_: bool) -> dict | None:
            nonlocal keys, prints, held
            k, p = np.concatenate(keys), np.concatenate(prints)
            end = len(k) if all_ else int(np.searchsorted(k, k[-1]))
            keys, prints, held = [k[end:]], [p[end:]], len(k) - end
            u, v = _forest(k[:end], p[:end], distance)
            return {"u": u.view(np.int64), "v": v.view(np.int64)} if len(u) else None

        for batch in batches:
            keys.append(batch.column("key").to_numpy())
            prints.append(batch.column("fp").to_numpy().view(np.uint64))
            held += batch.num_rows
            if held >= CHUNK:
                yield flush(False)
        if keys:
            yield flush(True)

    return map_stream(found.repartition("key").sortWithinPartitions("key"), compare, "u long, v long")


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
           distance: int = DISTANCE) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable by links) for every row of ``docs``.

    Equal fingerprints are one node from the start. Null and empty texts have fingerprint
    zero and are linked like others; a group whose ids are all null has a null id; rows
    that repeat an id count as one document with several texts only if they link. An empty
    table gives no rows; other columns are ignored.
    """
    prints = cut(fingerprints(docs, doc_id, text, shingle))
    nodes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    linked = components(links(nodes, distance))
    named = nodes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    return prints.join(named.join(smallest, "component").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, find: Callable[..., DataFrame] = groups, **options) -> DataFrame:
    """One row of ``docs`` per group of ``find``, the one with the smallest doc_id, all columns as they are.

    Rows whose doc_id is null stay: they cannot be named as copies. Of rows that repeat the
    kept id one stays.
    """
    kept = find(docs, **options).filter("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("_n"))
    kept = cut(kept)
    ids = kept.withColumnRenamed("doc_id", "_kept")
    stays = docs.join(ids.filter("_n = 1"), F.col("doc_id") == F.col("_kept"), "left_semi")
    if not kept.filter("_n > 1").isEmpty():
        repeated = docs.join(ids.filter("_n > 1"), F.col("doc_id") == F.col("_kept"), "left_semi")
        stays = stays.union(repeated.dropDuplicates(["doc_id"]))
    return stays.union(docs.filter("doc_id IS NULL"))
