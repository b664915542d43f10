import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import compare
from smogline.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


def test_one_query_per_operator_and_pipeline():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash_dedup", "mix_sources", "sentencepiece"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert compare(spark, FOLDER, QUERIES[name], SQL[name]) is None
