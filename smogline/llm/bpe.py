"""BPE encoding and decoding by a table of distinct words."""

from __future__ import annotations

import os
import re
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from operator import itemgetter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from smogline.llm.batches import column, map_stream
from smogline.llm.words import RUN_BYTES, coded, pack, texts_of, unpack

MODEL = "/opt/tokenizers/word_bpe_49k.json"
#: A mark after a Latin letter begins a word of its own; no composed character begins with one of these marks.
MARK = re.compile(rb"(?<=[A-Za-z])[.,;:!?]")
#: A bucket holds about so many words of runs; so many bytes of a run's words are put into buckets at once.
BUCKET_WORDS = 1 << 16
LEAST_BUCKETS = 8
HELD_BYTES = 64 << 20
#: Ids are put back for texts of about so many words at once.
SOME_WORDS = 1 << 18
_WORKER: dict = {}


def load(text: str):
    """A tokenizer from the text of its file, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(text)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _tokenizer(shared: Broadcast):
    """One tokenizer and its splitter per worker and vocabulary."""
    key = shared.id if hasattr(shared, "id") else id(shared)
    if key not in _WORKER:
        _WORKER.clear()
        tokenizer = load(shared.value)
        _WORKER[key] = tokenizer, splitter(tokenizer)
    return _WORKER[key]


def _give_back() -> None:
    """Arrow keeps freed memory for itself; a worker waits beside others that need it."""
    pa.default_memory_pool().release_unused()


def splitter(tokenizer) -> Callable[[bytes], list[bytes]]:
    """How a text is cut into words whose ids, one word after the other, are the text's.

    White space always ends a word. Where the vocabulary has lower case only, A-Z are lower-cased
    before, and marks after letters are cut off, so that fewer words are different. Texts
    that spell out a special token are left as they are, as those are found before normalising, and
    so are texts with combining marks (U+0300 to U+037F), as some compose with small letters only.
    """
    def ids(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    if ids("a b\tc") != ids("a") + ids("b") + ids("c"):
        raise ValueError("white space is part of this vocabulary's words")
    special = [t.content.encode("utf-8") for t in tokenizer.get_added_tokens_decoder().values()]
    if any(t.split() != [t] for t in special):
        raise ValueError("a special token has white space")
    asis = [*special, b"\xcc", b"\xcd"]  # the first bytes of U+0300 to U+037F
    plain = ids("Ab,c!? D") == ids("ab") + ids(",c!?") + ids("d")

    def split(text: bytes) -> list[bytes]:
        if plain and not any(t in text for t in asis):
            text = MARK.sub(rb" \g<0>", text.lower())
        return text.split()

    return split


class Codec:
    """A vocabulary, how texts are cut into its words (see :func:`splitter`), and its pieces as a table.

    The file's text, of fixed size, goes to every task once; the vocabulary bounds the table of pieces.
    """

    def __init__(self, spark: SparkSession, model: str = MODEL):
        with open(model, encoding="utf-8") as file:
            text = file.read()
        tokenizer = load(text)
        splitter(tokenizer)
        if tokenizer.decoder is not None:
            raise ValueError("the pieces of this vocabulary are not joined by spaces")
        self.shared = spark.sparkContext.broadcast(text)
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        self.width = "H" if max(vocabulary.values()) < 1 << 16 else "I"
        self.pieces = spark.sparkContext.broadcast((pa.array(vocabulary.values(), pa.int32()), pa.array(vocabulary.keys(), pa.string())))


def _buckets(words: DataFrame, buckets: int) -> DataFrame:
    """``words`` (run, word, code) as a row per run and bucket: its words in order of code, one a line, and
    the steps from code to code.

    A word's bucket follows from its bytes, so equal words of all runs have the same one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        found: dict[int, list[tuple[bytes, int]]] = defaultdict(list)
        last, held = None, 0

        def emit() -> Iterator[dict]:
            for bucket, own in found.items():
                own.sort(key=itemgetter(1))  # steps from code to code are small
                lines = b"\n".join(w for w, _ in own)
                yield {"bucket": [bucket], "run": [last], "n": [len(own)], "size": [len(lines)],
                       "words": [pa.compress(lines, codec="zstd", asbytes=True)], "steps": [pack(np.diff([c for _, c in own], prepend=0))]}
            found.clear()

        for batch in batches:
            for number, word, code in zip(column(batch, "run"), column(batch, "word"), column(batch, "code")):
                if number != last or held > HELD_BYTES:
                    yield from emit()
                    last, held = number, 0
                found[crc32(word) % buckets].append((word, code))
                held += len(word)
        yield from emit()

    return map_stream(words.select("run", "word", "code"), run, "bucket int, run long, n int, size long, words binary, steps binary")


def encode_words(words: DataFrame, codec: Codec) -> DataFrame:
    """The ids of ``words`` (run, word, code): rows of a run with the steps between n codes, how many ids each has, and all ids, packed.

    Equal words of all runs come together in one of the buckets, whose number grows with the
    words, so each different word is encoded once and a bucket's table of words is small.
    """
    shared, width = codec.shared, codec.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        tokenizer, last, known = _tokenizer(shared)[0], None, {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != last:
                    last, known = row["bucket"], {}
                    _give_back()
                own = pa.decompress(row["words"], decompressed_size=row["size"], codec="zstd", asbytes=True).split(b"\n")
                new = [w for w in own if w not in known]
                encoded = tokenizer.encode_batch([w.decode("utf-8", "replace") for w in new], add_special_tokens=False)
                known.update((w, array(width, e.ids)) for w, e in zip(new, encoded))
                sizes = np.fromiter((len(known[w]) for w in own), dtype=np.int32, count=len(own))
                ids = np.frombuffer(b"".join(known[w].tobytes() for w in own), dtype=width)
                yield {"run": [row["run"]], "n": [row["n"]], "steps": [row["steps"]], "sizes": [pack(sizes)], "n_ids": [len(ids)],
                       "ids": [pack(ids)]}

    buckets = max(LEAST_BUCKETS, words.count() // BUCKET_WORDS)
    together = _buckets(words, buckets).repartition("bucket").sortWithinPartitions("bucket")
    return map_stream(together, run, "run long, n int, steps binary, sizes binary, n_ids long, ids binary")


def encode(docs: DataFrame, codec: Codec, doc_id: str = "doc_id", text: str = "text", run_bytes: int = RUN_BYTES) -> DataFrame:
    """doc_id and ids of every row of ``docs``, as the tokenizer gives them without special tokens added.

    Special tokens that a text spells out are encoded as such. Words end at ASCII white space,
    each different one is encoded once, and the ids are put back by position. A null text counts as
    empty, empty texts and those of white space have no ids, rows that repeat are encoded each, an
    empty table stays empty, and other columns are ignored. A very long text is a run of its own;
    a text without white space is one word, which the table of words then holds whole.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.lit(None).cast("string").alias("space"),
                       F.col(text).cast("binary").alias("text"))
    shared = codec.shared
    words, texts = coded(rows, lambda text: _tokenizer(shared)[1](text), run_bytes)
    known = encode_words(words, codec)

    def put_back(texts: pa.Table, words: pa.Table) -> pa.Table:
        ids, sizes, codes = texts_of(texts)
        parts = words.to_pylist()
        del texts, words
        place = np.empty(sum(p["n"] for p in parts), dtype=np.int32)
        lengths, values, done = [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int32)], 0
        for p in parts:
            place[np.cumsum(unpack(p.pop("steps"), p["n"]))] = np.arange(done, done + p["n"], dtype=np.int32)
            lengths.append(unpack(p.pop("sizes"), p["n"]))
            values.append(unpack(p.pop("ids"), p["n_ids"]))
            done += p["n"]
        starts = np.r_[0, np.cumsum(np.concatenate(lengths))].astype(np.int32)
        known = pa.ListArray.from_arrays(pa.array(starts), pa.array(np.concatenate(values)))
        del parts, lengths, values, starts
        ends, found, start = np.cumsum(sizes), [], 0
        while start < len(ids):  # some texts at a time: all but the ids themselves stays small
            first = int(ends[start] - sizes[start])
            end = max(start + 1, int(np.searchsorted(ends, first + SOME_WORDS, side="right")))
            taken = known.take(pa.array(place[codes[first:ends[end - 1]]]))
            stops = np.r_[0, np.cumsum(pc.list_value_length(taken).to_numpy())][np.r_[0, ends[start:end] - first]]
            found.append(pa.ListArray.from_arrays(pa.array(stops, pa.int32()), taken.flatten()))
            del taken, stops
            start = end
        del place, codes, known
        _give_back()
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "ids": pa.chunked_array(found, pa.list_(pa.int32()))})

    return texts.groupBy("run").cogroup(known.groupBy("run")).applyInArrow(put_back, "doc_id long, ids array<int>")


def decode(docs: DataFrame, codec: Codec, ids: str = "ids") -> DataFrame:
    """``docs`` with ``decoded``: the pieces that a join on their ids finds, joined by spaces.

    The table of pieces is bounded by the vocabulary, so every task holds it and joins its batches
    of ids with it; nothing is shuffled. Special tokens are pieces as others are. Ids that the vocabulary
    lacks, and null ones, stand for nothing. No ids give the empty text, null stays null, an empty
    table stays empty, other columns stay as they are.
    """
    shared = codec.pieces

    @arrow_udf("string")
    def run(ids: pa.Array) -> pa.Array:
        tokens, pieces = shared.value
        flat = pc.index_in(ids.flatten(), value_set=tokens)  # the row of the piece with this id, if there is one
        there = np.r_[0, np.cumsum(pc.is_valid(flat).to_numpy(zero_copy_only=False))]
        ends = np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy())]
        found = pieces.take(flat.drop_null())
        _give_back()
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(there[ends], pa.int32()), found, mask=pc.is_null(ids)), " ")

    return docs.withColumn("decoded", run(docs[ids].cast("array<int>")))
