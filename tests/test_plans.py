"""Physical-plan checks: the plans we want at scale, not only the right rows."""

import pytest

from conftest import SMALL
from opinio.catalog import QUERIES


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()



@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_plans(spark, name):
    p = plan_of(QUERIES[name](spark, SMALL))
    for op in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "CartesianProduct"):
        assert op not in p, f"{name}: {op}"


def test_column_pruning_reaches_scan(spark):
    p = plan_of(QUERIES["corpus_ids"](spark, SMALL))
    assert "ReadSchema: struct<doc_id:bigint>" in p


def test_filter_pushdown_reaches_scan(spark):
    p = plan_of(QUERIES["cascade_delete"](spark, SMALL))
    assert "EqualTo(toxic,1)" in p and "ReadSchema: struct<doc_id:bigint,toxic:int>" in p


def test_word_count_uses_partial_aggregation(spark):
    p = plan_of(QUERIES["word_count"](spark, SMALL))
    assert "partial_count" in p and "HashAggregate" in p


def test_lexicon_join_is_broadcast(spark):
    p = plan_of(QUERIES["lexicon_score"](spark, SMALL))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_fuzzy_join_is_equi_join(spark):
    p = plan_of(QUERIES["match_fuzzy"](spark, SMALL))
    assert "SortMergeJoin" in p or "BroadcastHashJoin" in p or "ShuffledHashJoin" in p


def test_per_phrase_cap_limits_map_side(spark):
    p = plan_of(QUERIES["per_phrase_cap"](spark, SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_report_numbering_has_no_global_window(spark):
    p = plan_of(QUERIES["ranked_report_lines"](spark, SMALL))
    # windows run per (label, bucket) and, over the counts, per label: never over the whole table
    assert "SinglePartition" not in p.replace("functions=[partial_count(1)])", "") or "Window" not in p.split("SinglePartition")[0][-200:]
    assert all("_bucket" in w or "label" in w for w in p.split("Window [")[1:])
