"""SentencePiece encoding with sampled segmentations, and lossless decoding.

Segmentations are drawn by forward filtering and backward sampling over the lattice of all
ways to cut a text into pieces. Random numbers depend on the row's key and the place in the
text alone, so a row is cut alike in every run, task and batch.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from smogline.llm.batches import BATCH_BYTES, BATCH_ROWS

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
ALPHA = 1.0
SEED = 42
#: A character without a piece stands in a sampled sequence as this plus its code point.
LOOSE = 1 << 24
PART_CHARS = 1 << 20
WIDE_PARTS = 4
DENSE = 6
SEGMENT = re.compile(r" *[^ \n]+|\n| +")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def cut_segments(text: str) -> list[str]:
    """The parts of a text that pieces never reach over: line ends, and words with the spaces before them."""
    if "  " in text or "\0" in text:
        return SEGMENT.findall(text)
    return [s for s in text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0") if s]


@dataclass
class Pieces:
    """A vocabulary: pieces with their log weights, the 256 byte pieces, every id's bytes."""

    ids: dict[str, int]
    weights: np.ndarray
    byte_ids: list[int]
    raw: list[bytes]


def load(path: str = MODEL) -> Pieces:
    """Read a SentencePiece model with byte fallback; it must keep spaces at the start of pieces.

    The scores of a BPE model are merge ranks, not probabilities. A piece of rank r gets the
    weight 1 / (r + 2), after Zipf's law, normalised over the vocabulary.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, byte_ids, raw, ranks = {}, [0] * 256, [], []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        ranks.append(-model.get_score(i))
        if model.is_byte(i):
            value = int(piece[3:-1], 16)
            byte_ids[value] = i
            raw.append(bytes([value]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            raw.append(b"")
        else:
            text = piece.replace(SPACE, " ")
            if " " in text.lstrip(" ") or "\n" in text:
                raise ValueError(f"piece {i} has a space after another character")
            ids[text] = i
            raw.append(text.encode("utf-8"))
    weights = -np.log(np.maximum(np.array(ranks), 0) + 2.0)
    known = np.array(list(ids.values()))
    return Pieces(ids, weights - np.log(np.exp(weights[known]).sum()), byte_ids, raw)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def draws(keys: np.ndarray, step: int) -> np.ndarray:
    """A number in [0, 1) on a grid of 2**-28 for each key at a step."""
    return (_mix(keys + np.uint64((step + 1) * int(_BASE) & (1 << 64) - 1)) >> np.uint64(36)).astype(np.float64) / (1 << 28)


def segment_keys(row_keys: np.ndarray, counts: np.ndarray, seed: int = SEED) -> np.ndarray:
    """A random state for every segment, from its row's key, the seed and its number in the row."""
    starts = np.cumsum(counts) - counts
    number = (np.arange(counts.sum()) - np.repeat(starts, counts)).astype(np.uint64)
    rows = _mix(row_keys ^ _mix(np.full(1, seed, dtype=np.uint64) + _BASE))
    return _mix(np.repeat(rows, counts) + number * np.uint64(0xD1B54A32D192ED03))


class Lattice:
    """The lattices of a batch's different segments, and samples from them."""

    def __init__(self, pieces: Pieces, alpha: float = ALPHA):
        self.pieces, self.alpha = pieces, alpha
        self.longest = max(map(len, pieces.ids))
        texts = list(pieces.ids)
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4").astype(np.uint64) + np.uint64(1)
        ends = np.cumsum([len(t) for t in texts])
        hashes = np.zeros(len(texts), dtype=np.uint64)
        for n in range(self.longest):
            at = ends - 1 - n
            inside = at >= np.r_[0, ends[:-1]]
            hashes[inside] += codes[at[inside]] * self._power(n)
        order = np.argsort(hashes)
        self.hashes, self.hash_ids = hashes[order], np.array(list(pieces.ids.values()))[order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two pieces share a hash")
        # where hashes with the same first 20 bits begin; one more slot than there are hashes ends every search
        self.bucket = np.searchsorted(self.hashes, np.arange(1 << 20, dtype=np.uint64) << np.uint64(44)).astype(np.int32)
        sizes = np.diff(np.r_[self.bucket, len(self.hashes)])
        self.crowd, self.maybe = int(sizes.max()), sizes > 0
        self.hashes, self.hash_ids = np.r_[self.hashes, np.zeros(self.crowd, np.uint64)], np.r_[self.hash_ids, np.zeros(self.crowd, np.int64)]

    def _known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are a piece's, and whose."""
        at, hit = self.bucket[hashes >> np.uint64(44)], np.zeros(len(hashes), dtype=bool)
        where = at
        for k in range(self.crowd):
            same = self.hashes[at + k] == hashes
            where, hit = np.where(same, at + k, where), hit | same
        return hit, self.hash_ids[where]

    @staticmethod
    def _power(n: int) -> np.uint64:
        return np.uint64(pow(int(_BASE), n + 1, 1 << 64))

    def build(self, segments: list[str]) -> None:
        """Filter forward: for every position the weight of its prefix, and each incoming piece's share of it."""
        self.first = self.length = self.piece = self.bound = self.place = None  # the last part's arrays go before new ones come
        codes = np.frombuffer("".join(segments).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        index = np.int32 if len(codes) * self.longest < 1 << 31 else np.int64  # a worker's memory is mostly lists of edges
        lengths = np.fromiter(map(len, segments), dtype=np.int64, count=len(segments))
        self.ends = np.cumsum(lengths) - 1  # node v is the position after character v
        place = (np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(index)
        mixed, hashes = (codes + 1).astype(np.uint64), np.zeros(len(codes), dtype=np.uint64)
        found: list[tuple[np.ndarray, np.ndarray]] = []  # by length, the nodes where a piece ends, and the pieces
        for n in range(min(self.longest, len(codes))):
            if n < DENSE:  # whole arrays at once; what reaches over a segment's start is left out below
                hashes[n:] += mixed[:len(mixed) - n] * self._power(n)
                at = np.flatnonzero(self.maybe[hashes >> np.uint64(44)] & (place >= n)) if n else np.arange(len(codes))
            else:
                long = np.flatnonzero(place >= n) if n == DENSE else long[place[long] >= n]
                if not len(long):
                    break
                hashes[long] += mixed[long - n] * self._power(n)
                at = long[self.maybe[hashes[long] >> np.uint64(44)]]
            known, piece = self._known(hashes[at])
            if n == 0:  # every character can stand alone
                found.append((at.astype(index), np.where(known, piece, LOOSE + codes).astype(index)))
            else:
                found.append((at[known].astype(index), piece[known].astype(index)))
        del codes, mixed, hashes, at, known, piece
        # Listed by position in the segment, then node, then length: all segments move on together.
        many = np.zeros(len(place), dtype=index)
        for at, _ in found:
            many[at] += 1
        by_place = np.argsort(place.astype(np.uint16) if place.max() < 1 << 16 else place, kind="stable")
        begins = np.empty(len(place), dtype=index)
        begins[by_place] = np.cumsum(many[by_place]) - many[by_place]
        self.first, slot = begins, begins.copy()
        node, length, piece = (np.empty(int(many.sum()), dtype=index) for _ in range(3))
        for n, (at, own) in enumerate(found):
            into = slot[at]
            node[into], length[into], piece[into] = at, n + 1, own
            slot[at] += 1
        del found, at, own, into, many, by_place, slot
        loose = piece >= LOOSE
        weight = self.alpha * np.where(loose, self.pieces.weights.min() * 2, self.pieces.weights[np.where(loose, 0, piece)])
        fresh = np.r_[True, node[1:] != node[:-1]]
        first, owner = np.flatnonzero(fresh), np.cumsum(fresh, dtype=index) - 1
        at_place = place[node]
        inner = length <= at_place  # pieces that do not begin at the segment's start
        origin = np.where(inner, node - length, 0)
        del loose, fresh
        forward, share = np.zeros(len(place)), np.empty(len(node))
        steps = np.flatnonzero(np.r_[True, at_place[1:] != at_place[:-1]])
        for begin, end in zip(steps, np.r_[steps[1:], len(node)]):
            own = slice(begin, end)
            total = np.where(inner[own], forward[origin[own]], 0.0) + weight[own]
            groups = first[owner[begin]:owner[end - 1] + 1] - begin
            counts = np.diff(np.r_[groups, end - begin])
            top = np.maximum.reduceat(total, groups)
            part = np.exp(total - np.repeat(top, counts))
            sums = np.add.reduceat(part, groups)
            forward[node[begin:end][groups]] = top + np.log(sums)
            share[own] = part / np.repeat(sums, counts)
        del node, weight, owner, at_place, inner, origin, forward, total, part, sums
        self.length, self.piece = length, piece
        rank = (np.arange(len(share)) - np.repeat(first, np.diff(np.r_[first, len(share)]))).astype(index)
        bound, summed = share.copy(), share
        later, n = np.flatnonzero(rank), 1
        while len(later):  # running sums node by node, the same in every batch
            at = later[rank[later] == n]
            bound[at] = bound[at - 1] + summed[at]
            later, n = later[rank[later] > n], n + 1
        final = np.r_[first[1:], len(share)] - 1
        bound[final] = 1.0
        self.bound = bound
        self.place = place

    def sample(self, kinds: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece numbers of every segment occurrence in order, and how many each has."""
        node, active, step = self.ends[kinds].copy(), np.arange(len(kinds)), 0
        drawn, owners = [], []
        while len(active):
            here = node[active]
            drawn_at, edge = draws(keys[active], step), self.first[here]
            late = np.flatnonzero(self.bound[edge] <= drawn_at)
            while len(late):
                edge[late] += 1
                late = late[self.bound[edge[late]] <= drawn_at[late]]
            drawn.append(self.piece[edge])
            owners.append(active)
            goes_on = self.length[edge] <= self.place[here]
            node[active] = here - self.length[edge]
            active, step = active[goes_on], step + 1
        if not drawn:
            return np.zeros(0, dtype=np.int64), np.zeros(len(kinds), dtype=np.int64)
        counts = np.bincount(np.concatenate(owners), minlength=len(kinds))
        ends = np.cumsum(counts)
        out = np.empty(ends[-1], dtype=np.int64)
        for step, (pieces, own) in enumerate(zip(drawn, owners)):
            out[ends[own] - 1 - step] = pieces
        return out, counts

    def encode(self, texts: list[str | None], row_keys: np.ndarray, seed: int = SEED) -> pa.ListArray:
        """Ids of every text; null stays null, the empty text has no pieces."""
        segments, counts = [], []
        for text in texts:
            own = cut_segments(" " + text) if text else []
            segments += own
            counts.append(len(own))
        counts = np.array(counts, dtype=np.int64)
        keys = segment_keys(row_keys, counts, seed)
        values, sizes = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        ends = np.cumsum(np.fromiter(map(len, segments), dtype=np.int64, count=len(segments)))
        start = 0
        while start < len(segments):  # segments do not depend on each other: a part of them at a time
            for width in (WIDE_PARTS * PART_CHARS, PART_CHARS):  # the wide part, unless its different segments are long
                end = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + width)))
                known: defaultdict[str, int] = defaultdict(count().__next__)
                kinds = np.fromiter(map(known.__getitem__, segments[start:end]), dtype=np.int64, count=end - start)
                if sum(map(len, known)) <= PART_CHARS:
                    break
            self.build(list(known))
            drawn, numbers = self.sample(kinds, keys[start:end])
            values.append(drawn)
            sizes.append(numbers)
            start = end
        values, sizes = np.concatenate(values), np.concatenate(sizes)
        bounds = np.r_[0, np.cumsum(sizes)][np.r_[0, np.cumsum(counts)]]
        loose = np.flatnonzero(values >= LOOSE)
        if len(loose):  # spelled out in byte pieces
            spelled = [chr(v - LOOSE).encode("utf-8") for v in values[loose]]
            width = np.ones(len(values), dtype=np.int64)
            width[loose] = [len(s) for s in spelled]
            at = np.r_[0, np.cumsum(width)]
            values, bounds = np.repeat(values, width), at[bounds]
            for start, s in zip(at[loose], spelled):
                values[start:start + len(s)] = [self.pieces.byte_ids[b] for b in s]
        none = pa.array([t is None for t in texts], pa.bool_())
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.astype(np.int32)), mask=none)


def decode_lists(pieces: Pieces, ids: pa.ListArray) -> list[str | None]:
    """The texts of segmentations, whatever they are; null gives null."""
    bounds, spelled = ids.offsets.to_numpy(), np.array(pieces.raw, dtype=object)[ids.values.to_numpy()].tolist()
    return [b"".join(spelled[a:b]).decode("utf-8")[1:] if valid else None
            for a, b, valid in zip(bounds[:-1].tolist(), bounds[1:].tolist(), ids.is_valid().to_pylist())]


_WORKER: dict = {}


def _lattice(shared: Broadcast, alpha: float) -> Lattice:
    """One lattice builder per worker and vocabulary."""
    key = (shared.id if hasattr(shared, "id") else id(shared), alpha)
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Lattice(shared.value, alpha)
    return _WORKER[key]


class Codec:
    """Encoding and decoding columns; the vocabulary, of fixed size, goes to every task once."""

    def __init__(self, spark: SparkSession, model: str = MODEL, alpha: float = ALPHA, seed: int = SEED):
        self.shared, self.alpha, self.seed = spark.sparkContext.broadcast(load(model)), alpha, seed
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def encode(self, key: Column, text: Column) -> Column:
        """Piece ids of ``text`` by a segmentation that ``key`` (any type, null too) and the seed fix."""
        shared, alpha, seed = self.shared, self.alpha, self.seed

        @arrow_udf("array<int>")
        def run(keys: pa.Array, texts: pa.Array) -> pa.Array:
            states = keys.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            return _lattice(shared, alpha).encode(texts.to_pylist(), states, seed)

        return run(F.xxhash64(key), text)

    def decode(self, ids: Column) -> Column:
        shared = self.shared

        @arrow_udf("string")
        def run(ids: pa.Array) -> pa.Array:
            return pa.array(decode_lists(shared.value, ids), pa.string())

        return run(ids)

    def round_trip(self, key: Column, text: Column) -> Column:
        """A struct of ``ids`` as from :meth:`encode` and ``decoded``, which is read from these very ids."""
        shared, alpha, seed = self.shared, self.alpha, self.seed

        @arrow_udf("struct<ids: array<int>, decoded: string>")
        def run(keys: pa.Array, texts: pa.Array) -> pa.Array:
            states = keys.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            lattice = _lattice(shared, alpha)
            ids = lattice.encode(texts.to_pylist(), states, seed)
            return pa.StructArray.from_arrays([ids, pa.array(decode_lists(lattice.pieces, ids), pa.string())], ["ids", "decoded"])

        return run(F.xxhash64(key), text)


def encode(docs: DataFrame, codec: Codec, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, which replaces a column of that name.

    Equal keys with equal texts are cut alike, so repeated rows stay repeated rows. A null
    text has null ids, an empty one none; an empty table stays empty.
    """
    return docs.withColumn("ids", codec.encode(docs[key], docs[text]))


def decode(docs: DataFrame, codec: Codec, ids: str = "ids") -> DataFrame:
    """``docs`` with ``decoded``, equal to the text that was encoded, character by character."""
    return docs.withColumn("decoded", codec.decode(docs[ids]))


def round_trip(docs: DataFrame, codec: Codec, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` and ``decoded``, as :func:`encode` and then :func:`decode` give them.

    Those two in one plan encode every text twice, as Spark puts the first call into the second
    and keeps it for the ids as well; here a text is encoded once.
    """
    done = codec.round_trip(docs[key], docs[text])
    return docs.withColumn("_done", done).withColumns({"ids": F.col("_done.ids"), "decoded": F.col("_done.decoded")}).drop("_done")
