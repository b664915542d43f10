"""Texts as codes of their words, with a dictionary of different words per run of rows.

What an operator learns of a word reaches the texts by a join on the dictionaries, in which a
word stands once per run however often it occurs, and is put back by position. So no row per
occurrence is ever shuffled, and a word that every text holds is no hot key.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.llm.batches import column, map_stream
from smogline.session import cut

RUN_BYTES = 32 << 20
SLICE = 1 << 16
CODED = "run long, space string, word binary, code int, n long, ids array<long>, sizes array<int>, codes binary"


def pack(codes: np.ndarray) -> bytes:
    """Whole numbers from 0 to below 2**31, byte by byte of all numbers, compressed; small numbers take little."""
    planes = np.ascontiguousarray(codes, dtype="<i4").view(np.uint8).reshape(-1, 4).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(packed: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, dtype="<i4")
    planes = np.frombuffer(pa.decompress(packed, decompressed_size=4 * n, codec="zstd", asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<i4").ravel()


def _run_numbers() -> Iterator[int]:
    """Numbers that no other task gives; they hold once the task's rows are written."""
    task = TaskContext.get()
    return count((task.partitionId() if task else 0) << 32)


def coded(rows: DataFrame, split: Callable[[bytes], list[bytes]], run_bytes: int = RUN_BYTES) -> tuple[DataFrame, DataFrame]:
    """The dictionaries and the coded texts of ``rows`` (id long, space string, text binary).

    A run is at most ``run_bytes`` of text, or one text that is longer. The first frame holds run,
    space, word, code and n (how often the run has the word; equal words of two spaces are two
    words), the second one row per run: the ids, the numbers of words and the packed codes of
    its texts. Null texts count as empty.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        numbers, held = _run_numbers(), 0
        words: dict[str | None, defaultdict[bytes, int]] = {}
        ids, parts, next_code = [], [], count()

        def emit() -> Iterator[dict]:
            sizes = [len(p) for p in parts]
            run, codes = next(numbers), np.concatenate(parts)
            parts.clear()
            times = np.bincount(codes)
            rank = np.empty(len(times), dtype=np.int32)  # frequent words have small codes
            rank[np.argsort(-times, kind="stable")] = np.arange(len(times))
            packed = pack(rank[codes])
            del codes
            for space, own in words.items():
                names, known = list(own), np.fromiter(own.values(), dtype=np.int32, count=len(own))
                own.clear()
                order = np.argsort(rank[known])  # codes in order take little room
                for start in range(0, len(order), SLICE):
                    some = order[start:start + SLICE]
                    yield {"run": [run] * len(some), "space": [space] * len(some), "word": [names[i] for i in some], "code": rank[known[some]],
                           "n": times[known[some]], **dict.fromkeys(("ids", "sizes", "codes"), [None] * len(some))}
                del names
            yield {"run": [run], "ids": [ids], "sizes": [sizes], "codes": [packed],
                   **dict.fromkeys(("space", "word", "code", "n"), [None])}

        for batch in batches:
            for i, space, text in zip(column(batch, "id"), column(batch, "space"), column(batch, "text")):
                if ids and held + len(text or b"") > run_bytes:
                    yield from emit()
                    words, ids, parts, next_code, held = {}, [], [], count(), 0
                if space not in words:
                    words[space] = defaultdict(next_code.__next__)
                found = split(text or b"")
                parts.append(np.fromiter(map(words[space].__getitem__, found), dtype=np.int32, count=len(found)))
                ids.append(i)
                held += len(text or b"")
        if ids:
            yield from emit()

    table = cut(map_stream(rows.select("id", "space", "text"), code, CODED))
    return (table.filter("word IS NOT NULL").select(F.col("run").alias("run"), "space", "word", "code", "n"),
            table.filter("word IS NULL").select("run", "ids", "sizes", "codes"))


def texts_of(table: pa.Table) -> tuple[list, np.ndarray, np.ndarray]:
    """Ids, sizes and codes of a run's row."""
    sizes = np.array(table.column("sizes")[0].as_py(), dtype=np.int64)
    return table.column("ids")[0].as_py(), sizes, unpack(table.column("codes")[0].as_py(), int(np.maximum(sizes, 0).sum()))
