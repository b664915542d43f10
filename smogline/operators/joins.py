"""Joins to tables with few rows per key, and joins in which null keys match."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def content_hash(df: DataFrame) -> Column:
    """A hash of the whole row; maps, which have no fixed order, are left out."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)])


def lookup_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join rows of any distribution to a side with few rows per key.

    Each side is used once. No side gets a hint: Spark broadcasts the right one when its
    measured size is small. Otherwise both are dealt by key, and adaptive execution splits
    a partition that a hot key makes large into as many tasks as its measured bytes need,
    each of which reads that key's few rows of the other side. Rows without a key match
    nothing.
    """
    return left.join(right, on, how)


def long_side(df: DataFrame) -> DataFrame:
    """A side of a join whose rows grow with the readings, as those of the other side do.

    Neither side is then broadcast. Spark takes a table read from files to be as large as the
    files, which for compressed readings can be a hundredth of what their rows take on the driver,
    and adaptive execution does not take such a broadcast back where that costs a shuffle.
    """
    return df.hint("merge")


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a null key matches a null key; the result has the keys of ``left``."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in on})
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in on])
    return left.join(renamed, match, how).drop(*[f"_r_{k}" for k in on])
