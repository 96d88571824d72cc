"""Every registered query against its DuckDB oracle (or a rows-only run) on sf0.001."""

import pytest

import __spark_entry__ as E
from conftest import SMALL
from harness import compare
from opinio import catalog

# the optional training-data queries have their own tests
QUERIES = {n: f for n, f in E.queries().items() if n in catalog.QUERIES}
ORACLE = {n: q for n, q in E.oracle_sql().items() if n in catalog.QUERIES}


def test_every_query_has_a_name_match():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 80


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck_small, name):
    problems, ns, nd = compare(spark, duck_small, name, QUERIES[name], ORACLE[name], SMALL)
    assert not problems, "\n".join(problems)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_query_runs(spark, name):
    df = QUERIES[name](spark, SMALL)
    assert df.count() >= 0
    assert len(df.columns) > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 100
    assert df.columns == ["rank", "word", "count", "frequency", "percent", "total_words"]
