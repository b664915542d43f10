import pytest

import __spark_entry__ as entry

NAMES = sorted(entry.queries())
OWN = sorted(set(entry.oracle_sql()) - set(entry._llm()[1]))


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(NAMES)


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["datasourceId", "sourceId", "date", "type", "air", "n_valid", "is_valid"]
    first = df.first()
    assert first["type"] == "hour" and first["date"].startswith("2024-01-30")


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, name):
    """On the smallest tables, to be quick; ``python -m checks.compare <folder>`` takes any."""
    from checks.compare import compare

    problem = compare(spark, "/root/testdata/sf0.001", entry.queries()[name], entry.oracle_sql()[name])
    assert problem in (None, "both empty")
