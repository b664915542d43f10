"""A corpus pipeline of five stages, each one operator of ``smogline.llm``.

Every stage takes the documents that the one before has kept (doc_id, text, lang, source,
n_chars) and gives their rows back; the last one returns token ids. Nulls, empty texts,
repeated rows and empty tables are handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.llm import langid, lines, mixing, pieces, simhash
from smogline.session import cut, scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised: texts without letters or far from every centroid go."""
    return langid.accept(docs, langid.fit(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that at least three of them share, except in the largest doc_id."""
    index = lines.LineIndex(spark, scratch_path(spark, "lines"))
    index.insert(docs)
    done = index.dedup(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of close fingerprints, the one with the smallest doc_id."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids by a sampled segmentation."""
    encoded = pieces.encode(docs, pieces.Codec(spark))
    return encoded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_pieces"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("mix_sources", mix_sources),
    ("sentencepiece", sentencepiece),
]

#: SQL can express neither the centroids, the fingerprints nor the sampled pieces.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut(docs)
    return docs
