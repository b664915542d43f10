"""Exact deduplication with Patricia tries over full byte strings."""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.llm.batches import column, map_batches, map_stream
from smogline.session import cut

TRIE_BYTES = 64 << 20
NODE_BYTES = 300


def normalised(text: bytes | None) -> bytes:
    """A-Z lower-cased, nothing else; null is empty."""
    return (text or b"").lower()


class _Node:
    __slots__ = ("label", "children", "owner", "count")

    def __init__(self, label: bytes):
        self.label, self.children, self.owner, self.count = label, {}, None, 0


class _Part:
    """Strings written to a file, and the prefix that all of them share."""

    def __init__(self, base: bytes):
        self.base, self.file = base, tempfile.TemporaryFile()

    def write(self, item: tuple[bytes, int | None, int]) -> None:
        self.base = self.base[:_common(self.base, item[0])]
        pickle.dump(item, self.file)

    def read(self) -> Iterator[tuple[bytes, int | None, int]]:
        self.file.seek(0)
        try:
            while True:
                yield pickle.load(self.file)
        except EOFError:
            self.file.close()


def _common(a: bytes, b: bytes) -> int:
    """How many bytes two strings share at their start."""
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Patricia:
    """A compressed radix trie; the node where a string ends holds its owner and its count.

    Beyond ``limit`` bytes the largest subtree below the root is written to a nameless local
    file, and strings that belong to it follow; :meth:`items` works such subtrees off one at
    a time in tries of their own. Those begin at the whole prefix that their strings share, so each
    splits its strings or ends one, however long the prefix. The file lives as long as the task that made it.
    """

    def __init__(self, limit: int = TRIE_BYTES, base: bytes = b""):
        self.limit, self.base, self.root, self.held, self.spilled = limit, base, _Node(b""), 0, {}

    def add(self, key: bytes, owner: int | None, count: int = 1) -> None:
        """Insert a string that starts with ``base``; the smaller owner stays, None counts as larger than any."""
        at, node = len(self.base), self.root
        if at < len(key) and key[at] in self.spilled:
            self.spilled[key[at]].write((key, owner, count))
            return
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = _Node(key[at:])
                self.held += len(child.label) + NODE_BYTES
                at = len(key)
            elif key.startswith(child.label, at):
                at += len(child.label)
            else:
                same = len(os.path.commonprefix([child.label[:4096], key[at:at + 4096]]))
                while same and same % 4096 == 0 and child.label[same:same + 4096] and key[at + same:at + same + 4096]:
                    more = len(os.path.commonprefix([child.label[same:same + 4096], key[at + same:at + same + 4096]]))
                    same += more
                    if more < 4096:
                        break
                upper = _Node(child.label[:same])
                child.label = child.label[same:]
                upper.children[child.label[0]] = child
                node.children[key[at]] = child = upper
                self.held += NODE_BYTES
                at += same
            node = child
        node.owner = owner if node.count == 0 or node.owner is None else node.owner if owner is None else min(node.owner, owner)
        node.count += count
        if self.held > self.limit:
            self._spill()

    def _walk(self, node: _Node, above: bytes) -> Iterator[tuple[bytes, int | None, int]]:
        stack = [(node, above)]
        while stack:
            node, above = stack.pop()
            key = above + node.label
            if node.count:
                yield key, node.owner, node.count
            stack.extend((child, key) for child in node.children.values())

    def _size(self, node: _Node) -> int:
        total, stack = 0, [node]
        while stack:
            node = stack.pop()
            total += len(node.label) + NODE_BYTES
            stack.extend(node.children.values())
        return total

    def _spill(self) -> None:
        if not self.root.children:
            return
        sizes = {first: self._size(child) for first, child in self.root.children.items()}
        first = max(sizes, key=sizes.get)
        child = self.root.children.pop(first)
        part = self.spilled[first] = _Part(self.base + child.label)
        for item in self._walk(child, self.base):
            part.write(item)
        self.held -= sizes[first]

    def items(self) -> Iterator[tuple[bytes, int | None, int]]:
        """Every different string once with its owner and count; empties the trie."""
        trie, left = self, []
        while True:
            yield from trie._walk(trie.root, trie.base)
            left += trie.spilled.values()
            trie.root, trie.spilled = _Node(b""), {}
            if not left:
                return
            part = left.pop()
            trie = Patricia(self.limit, part.base)
            for item in part.read():
                trie.add(*item)


def text_keys(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, length in bytes, content hash and SHA-256 of every normalised text."""

    def keys(batch: pa.RecordBatch) -> dict:
        texts = [normalised(t) for t in column(batch, "text")]
        return {"doc_id": column(batch, "doc_id"), "bytes": [len(t) for t in texts],
                "hash": [_hash(t) for t in texts], "sha256": [hashlib.sha256(t).digest() for t in texts]}

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return map_batches(rows, keys, "doc_id long, bytes long, hash long, sha256 binary")


def _hash(text: bytes) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def owners(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: str = "smallest",
           trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per different text: bytes, hash, sha256, keep_id and group_size.

    Each input task puts its texts into a trie and hands on every different one once, with
    its owner and count, so a text that a third of all rows share reaches the next tasks
    once per task. Those tasks, dealt by length and content hash, merge the texts in tries
    over the full byte strings: equality never rests on a hash.
    """
    sign = {"smallest": 1, "largest": -1}[keep]

    def signed(value: int | None) -> int | None:
        return None if value is None else sign * value

    def collected(items: Iterator[tuple[bytes, int | None, int]]) -> Iterator[dict]:
        out, size = [], 0
        for item in items:
            out.append(item)
            size += len(item[0])
            if size > 8 << 20 or len(out) == 1000:
                yield out
                out, size = [], 0
        if out:
            yield out

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        def emit(trie):
            for part in collected(trie.items()):
                yield {"text": [k for k, _, _ in part], "bytes": [len(k) for k, _, _ in part],
                       "hash": [_hash(k) for k, _, _ in part], "owner": [o for _, o, _ in part], "n": [n for _, _, n in part]}
        trie = Patricia(1 << 62)
        for batch in batches:
            for i, t in zip(column(batch, "doc_id"), column(batch, "text")):
                trie.add(normalised(t), signed(i))
            if trie.held > trie_bytes:
                yield from emit(trie)
                trie = Patricia(1 << 62)
        yield from emit(trie)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        trie = Patricia(trie_bytes)
        for batch in batches:
            for t, o, n in zip(column(batch, "text"), column(batch, "owner"), column(batch, "n")):
                trie.add(t, o, n)
        for part in collected(trie.items()):
            yield {"bytes": [len(k) for k, _, _ in part], "hash": [_hash(k) for k, _, _ in part],
                   "sha256": [hashlib.sha256(k).digest() for k, _, _ in part],
                   "keep_id": [signed(o) for _, o, _ in part], "group_size": [n for _, _, n in part]}

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    texts = map_stream(rows, local, "text binary, bytes long, hash long, owner long, n long")
    return map_stream(texts.repartition("bytes", "hash"), merge,
                      "bytes long, hash long, sha256 binary, keep_id long, group_size long")


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: str = "smallest") -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for every row of ``docs``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The row
    with the smallest (or largest) doc_id of a group stays; a null id stays only in a group
    without others. Rows that repeat the kept id are equal in id and text and all marked
    as kept; group_size counts rows. Other columns are ignored, an empty table gives none.
    """
    kept = owners(docs, doc_id, text, keep)
    keys = cut(text_keys(docs, doc_id, text))
    return keys.join(cut(kept), ["bytes", "hash", "sha256"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha256")).alias("text_sha256"))
