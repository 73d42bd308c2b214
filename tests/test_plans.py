"""Physical-plan properties that matter at scale."""

import re

import pytest

from conftest import SF_SMALL
from loomstar.operators.joins import broadcast_if_small, broadcast_threshold
from loomstar.plans.queries import QUERIES

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF", "AggregateInPandas")


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_any_query(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in PYTHON_NODES)


def test_country_filter_reaches_the_scan(spark):
    plan = executed(QUERIES["sales_by_type_one_country"](spark, SF_SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(n_name,NATION_9\)", plan)


def test_fact_scan_reads_only_needed_columns(spark):
    plan = executed(QUERIES["sales_by_month_top6"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    fact = [s for s in schemas if "l_orderkey" in s]
    assert fact and all(set(p.split(":")[0] for p in s.split(",")) ==
                        {"l_orderkey", "l_partkey", "l_quantity"} for s in fact)


def test_share_query_scans_the_fact_once(spark):
    plan = executed(QUERIES["sales_share_by_type"](spark, SF_SMALL)).split("Initial Plan")[0]
    fact = [x for x in re.findall(r"ReadSchema: struct<([^>]*)>", plan) if "l_suppkey" in x]
    assert len(fact) == 1


def test_telescoped_gap_has_no_window(spark):
    plan = executed(QUERIES["avg_gap_by_year_top5"](spark, SF_SMALL))
    assert "Window" not in plan


def test_broadcast_only_below_the_bound(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    saved = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")   # only the explicit check decides
    try:
        fact = spark.range(1000).withColumnRenamed("id", "k")
        dim = spark.range(50).withColumnRenamed("id", "k")
        small = fact.join(broadcast_if_small(dim, max_bytes=10_000), "k")
        large = fact.join(broadcast_if_small(dim, max_bytes=100), "k")
        never = fact.join(broadcast_if_small(dim), "k")
        assert small.count() == large.count() == never.count() == 50
        assert "BroadcastHashJoin" in executed(small)
        assert "BroadcastHashJoin" not in executed(large) and "BroadcastHashJoin" not in executed(never)
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert broadcast_threshold(fact) == 32 * 1024 * 1024


@pytest.mark.parametrize("name", ["sales_by_year_month_top10", "sales_by_type_one_country", "fk_violations",
                                  "next_event_gap", "etl_key_report"])
def test_size_check_sends_no_rows_to_one_task(spark, name):
    """No limit feeds a single partition but the query's own top 10."""
    plan = executed(QUERIES[name](spark, SF_SMALL)).split("Initial Plan")[0]
    assert all(int(n) <= 10 for n in re.findall(r"Limit(?:Exec)? \(?(?:limit=)?(\d+)", plan))
