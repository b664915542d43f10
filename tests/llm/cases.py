"""Awkward documents shared by the tests."""

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use themselves
    *[T.StructField(c, T.StringType()) for c in ("key", "size", "n", "shard", "fp", "hash", "copies", "n_lines", "kept", "score")]])

LONG = "long words of one very long text " * 20_000


def rows(texts, ids=None, lang="en", source="s"):
    ids = range(len(texts)) if ids is None else ids
    return [(i, t, lang, source, None if t is None else len(t), *["x"] * 10) for i, t in zip(ids, texts)]


def docs(spark, texts, ids=None, **more):
    return spark.createDataFrame(rows(texts, ids, **more), SCHEMA)


AWKWARD = ["", None, " ", "\n\n", "Équal TEXT", "Équal text", "Équal text", "a", LONG, "tab\tand\x0bfeed\x0c  wide", "é \U0001F600 漢字",
           "▁ ▁▁", "x" * 5000]
