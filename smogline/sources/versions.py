"""Tables that readers see whole: a change writes new folders, then one file that says which folders count.

``path/_versions/<number>`` lists the current folder of every partition with its number of
rows and of different dates. The file appears at once under its name, so a reader has the
table before or after a change, never a mix, and a change that stops half way has changed nothing.

One list may name several tables: the one at ``path`` and named ones below it, which then change
together. It also holds a mark per stream, the number of its last batch, so that what a batch
changes and the fact that it has been taken in become known at once.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogline.session import remove

LISTS = "_versions"
NOTHING = "__HIVE_DEFAULT_PARTITION__"
#: Readers that began before a change still find their files until the change after it.
KEPT = 2


@dataclass(frozen=True)
class Part:
    """A partition's current folder; ``values`` are those of the partition columns."""

    values: tuple[str | None, ...]
    version: str
    rows: int
    dates: int
    table: str = ""

    @property
    def place(self) -> tuple:
        return self.table, self.values


@dataclass
class Change:
    """What a change has written so far; nobody else sees it before it is published."""

    path: str
    number: int
    parts: dict[tuple, Part]
    marks: dict[str, int]
    columns: dict[str, list[str]] = field(default_factory=dict)
    touched: set[tuple] = field(default_factory=set)


_OPEN = threading.local()


def _open_change(path: str) -> Change | None:
    return next((c for c in _OPEN.__dict__.get("changes", []) if c.path == path), None)


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    where, files = _at(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(n) for n in _names(spark, f"{path}/{LISTS}") if n.isdigit()]


def is_versioned(spark: SparkSession, path: str) -> bool:
    return bool(_numbers(spark, path))


def _lines(spark: SparkSession, path: str, number: int | None = None) -> list[dict]:
    numbers = _numbers(spark, path)
    if not numbers:
        return []
    return [json.loads(line) for line in read_text(spark, f"{path}/{LISTS}/{numbers[-1] if number is None else number:012d}").splitlines()]


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    where, files = _at(spark, path)
    stream = files.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def parts(spark: SparkSession, path: str, number: int | None = None, table: str | None = "") -> list[Part]:
    """The current partitions of a table (None: of all), or those of an earlier list; their number is
    bounded by the calendar. Inside a change its own writes count as current."""
    change = _open_change(path) if number is None else None
    if change is not None:
        found = list(change.parts.values())
    else:
        found = [Part(**{**p, "values": tuple(p["values"])}) for p in _lines(spark, path, number) if "values" in p]
    return [p for p in found if table is None or p.table == table]


def marks(spark: SparkSession, path: str) -> dict[str, int]:
    """The number of the last batch taken in, per stream."""
    return {p["mark"]: p["batch"] for p in _lines(spark, path) if "mark" in p}


def _folder(path: str, columns: list[str], values: tuple, version: str | None = None, table: str = "") -> str:
    root = f"{path}/_{table}" if table else path
    where = [root, *[f"{c}={NOTHING if v is None else v}" for c, v in zip(columns, values)]]
    return "/".join([*where, f"version={version}"] if version else where)


def read(spark: SparkSession, path: str, schema: T.StructType, columns: list[str], chosen=None, table: str = "") -> DataFrame:
    """The table as it is now, or only the partitions ``chosen``; empty when there is none."""
    found = [p for p in parts(spark, path, table=table) if chosen is None or p.values in chosen]
    if not found:
        return spark.createDataFrame([], schema)
    whole = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
    return (spark.read.schema(whole).option("basePath", _folder(path, [], (), table=table))
            .parquet(*[_folder(path, columns, p.values, p.version, table) for p in found]).select(*schema.names))


def schema_of(spark: SparkSession, path: str, columns: list[str], table: str = "") -> T.StructType:
    """Names and types of the stored columns; those of the folders are text."""
    found = parts(spark, path, table=table)
    stored = spark.read.parquet(_folder(path, columns, found[0].values, found[0].version, table)).schema.fields if found else []
    return T.StructType([*stored, *[T.StructField(c, T.StringType()) for c in columns]])


@contextmanager
def change(spark: SparkSession, path: str, mark: tuple[str, int] | None = None) -> Iterator[Change]:
    """Everything written to the tables of ``path`` inside becomes current at once, when the block ends well.

    Reads inside see what was written before them. ``mark`` (stream, batch) is recorded with it. An inner
    change is part of the outer one. A block that fails changes nothing. One writer at a time: a second one
    fails on the name of its list.
    """
    outer = _open_change(path)
    if outer is not None:
        yield outer
        return
    now = Change(path, max(_numbers(spark, path), default=0) + 1, {p.place: p for p in parts(spark, path, table=None)}, marks(spark, path))
    opened = _OPEN.__dict__.setdefault("changes", [])
    opened.append(now)
    try:
        yield now
    finally:
        opened.remove(now)
    if mark is not None:
        now.marks[mark[0]] = mark[1]
    if now.touched or mark is not None:
        publish(spark, now)


def write(df: DataFrame, path: str, columns: list[str], order: list, touched: set[tuple], table: str = "") -> None:
    """Replace the partitions ``touched`` by the rows of ``df``, which has no others.

    Each file is in the given order. Readers see it with the change around it, or at once if there is none.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    # Rebalancing splits a crowded partition and joins small ones by their measured size. The sort
    # begins with the partition columns, else the writer would sort again by those alone. The
    # version depends on a column only so that it stays among them.
    named = F.concat(F.lit(version), F.substring(F.coalesce(F.col(df.columns[0]).cast("string"), F.lit("")), 1, 0))
    dealt = df.hint("rebalance", *columns) if columns else df.hint("rebalance")
    with change(spark, path) as now:
        (dealt.withColumn("version", named).sortWithinPartitions(*columns, "version", *order)
         .write.mode("append").option("compression", "zstd").partitionBy(*columns, "version").parquet(_folder(path, [], (), table=table)))
        fresh = _counted(spark, path, df.schema, columns, version, touched, table)
        for values in touched:
            now.parts.pop((table, values), None)
        now.parts.update({p.place: p for p in fresh})
        now.touched |= {(table, values) for values in touched}
        now.columns[table] = columns


def _counted(spark: SparkSession, path: str, schema: T.StructType, columns: list[str], version: str, touched: set[tuple],
             table: str) -> list[Part]:
    """The written partitions with their numbers of rows and dates."""
    written = [v for v in touched if _names(spark, _folder(path, columns, v, version, table))]
    if not written:
        return []
    whole = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
    rows = (spark.read.schema(whole).option("basePath", _folder(path, [], (), table=table))
            .parquet(*[_folder(path, columns, v, version, table) for v in written]))
    dates = F.count_distinct("date") if "date" in schema.names else F.lit(0).cast("long")
    sizes = [F.count("*").alias("rows"), dates.alias("dates")]
    counted = (rows.groupBy(*columns).agg(*sizes) if columns else rows.agg(*sizes)).collect()  # one row per partition
    return [Part(tuple(r[c] for c in columns), version, r["rows"], r["dates"], table) for r in counted]


def publish(spark: SparkSession, now: Change) -> None:
    """Make what a change wrote the current state, by a new list."""
    path = now.path
    lines = [asdict(p) for p in now.parts.values()] + [{"mark": m, "batch": n} for m, n in now.marks.items()]
    where, files = _at(spark, f"{path}/{LISTS}/{now.number:012d}")
    if files.exists(where):
        raise FileExistsError(f"{where}: another writer is at work")
    draft, _ = _at(spark, f"{path}/{LISTS}/_{uuid.uuid4().hex}")
    out = files.create(draft, True)
    out.write(bytearray("\n".join(map(json.dumps, lines)).encode("utf-8")))
    out.close()
    if not files.rename(draft, where):
        raise FileExistsError(f"{where}: another writer is at work")
    _clean(spark, now)


def _clean(spark: SparkSession, now: Change) -> None:
    """Drop folders of the touched partitions that neither of the last lists names, and older lists."""
    path = now.path
    last = [n for n in _numbers(spark, path) if n > now.number - KEPT]
    named = {(p.place, p.version) for n in last for p in parts(spark, path, n, None)}
    for table, values in now.touched:
        folder = _folder(path, now.columns[table], values, table=table)
        for name in _names(spark, folder):
            if name.startswith("version=") and ((table, values), name.removeprefix("version=")) not in named:
                remove(spark, f"{folder}/{name}")
    for n in _numbers(spark, path):
        if n <= now.number - KEPT:
            remove(spark, f"{path}/{LISTS}/{n:012d}")
