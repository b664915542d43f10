"""Run registered queries beside their SQL: ``python -m checks.compare [folder] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path


def _plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return value + 0.0
    return value


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns in name order, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(spark, folder: str, fn, sql: str) -> str | None:
    """None when equal, else what differs."""
    import duckdb

    df = fn(spark, folder)
    spark_columns, spark_rows = df.columns, [tuple(r) for r in df.collect()]
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    result = con.execute(sql)
    duck_columns, duck_types = [c[0] for c in result.description], [str(c[1]) for c in result.description]
    duck_rows = result.fetchall()
    con.close()
    if sorted(spark_columns) != sorted(duck_columns):
        return f"columns {sorted(spark_columns)} vs {sorted(duck_columns)}"
    kinds = dict(zip(duck_columns, duck_types))
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd = [(c, k, kinds[c]) for c, k in df.dtypes if names.get(k, kinds[c]) != kinds[c] and kinds[c] not in ("NUMBER", "STRING", "Any")]
    a, b = canonical(spark_columns, spark_rows), canonical(duck_columns, duck_rows)
    if a != b:
        only_a, only_b = [r for r in a if r not in set(b)][:3], [r for r in b if r not in set(a)][:3]
        return f"{len(a)} vs {len(b)} rows; only Spark {only_a}; only SQL {only_b}"
    if odd:
        return f"types {odd}"
    return None if a else "both empty"


def main() -> int:
    import checks.catalog2  # noqa: F401 - adds its queries
    import checks.catalog3  # noqa: F401 - adds its queries
    from checks.catalog import QUERIES, SQL
    from smogline.session import get_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = get_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                       "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names:
        started = time.time()
        try:
            problem = compare(spark, folder, QUERIES[name], SQL[name]) if name in SQL else (
                f"rows only: {QUERIES[name](spark, folder).count()}")
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None and not problem.startswith("rows only")
        print(f"{'ok  ' if problem is None else 'BAD '} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{failed} differ of {len(names)}")
    return failed


if __name__ == "__main__":
    sys.exit(main())
