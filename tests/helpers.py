"""Small frames for the golden cases."""

from datetime import datetime, timedelta

ZERO = datetime(2026, 1, 1)
SERIES = "datasourceId string, sourceId string, time timestamp, v double"


def at(text):
    return datetime.fromisoformat(text)


def series(spark, values, sensor="D1", minutes=10):
    """One row per value, evenly spaced."""
    rows = [(sensor, "S1", ZERO + timedelta(minutes=minutes * i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, SERIES)


def values(df, col="v"):
    return [r[col] for r in df.orderBy("datasourceId", "sourceId", "time").select(col).collect()]


def rows(df, *cols):
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
