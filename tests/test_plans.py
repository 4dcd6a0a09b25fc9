"""Plan shape of every registered query: no cartesian or nested-loop joins,
filters reach the parquet scan, projections prune columns."""
import re

import pytest

import __spark_entry__ as entry
from docweave.plans import catalog

from conftest import SF0001

BAD = ["CartesianProduct", "BroadcastNestedLoopJoin"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(entry.queries()[name](spark, SF0001))
    for bad in BAD:
        assert bad not in plan, name


def test_filter_pushdown_and_pruning(spark):
    plan = _plan(entry.queries()["content_filter"](spark, SF0001))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(lang,de\)", plan)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(n_chars,1000\)", plan)
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string,n_chars:bigint>" in plan
    plan = _plan(entry.queries()["token_count"](spark, SF0001))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_html_chain_is_planned_once_and_guarded(spark):
    """The chain is the argument of one Python step, under the test for markup."""
    from docweave.functions.text import normalize_text

    df = spark.createDataFrame([("a",)], "t string").select(normalize_text("t").alias("n"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("script|style|noscript") == 1
    step = plan[plan.rindex("ArrowEvalPython", 0, plan.index("script|style|noscript")):]
    assert re.match(r"ArrowEvalPython \[_unescape_batch\(CASE WHEN \(Contains\(.*?, <\) AND Contains\(.*?, >\)\) THEN regexp_replace\(", step, re.S)
