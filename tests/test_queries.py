"""Every registered query against its SQL, on the smallest test tables."""

import pytest
from check import compare, connect

from __spark_entry__ import entry
from __spark_entry__ import oracle_sql as all_sql
from __spark_entry__ import queries as all_queries
from marquee.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)


def test_the_driver_sees_all_of_them():
    assert set(QUERIES) <= set(all_queries()) and set(ORACLES) <= set(all_sql())
    assert set(all_sql()) <= set(all_queries())


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", list(queries()))
def test_query_agrees_with_sql(spark, name):
    problem = compare(spark, connect(SF), name, queries()[name], oracle_sql().get(name), SF)
    assert problem is None, problem


def test_entry_has_rows(spark):
    assert entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", ["scan_project", "knn_exact", "semantic_search", "recommend_for_groups", "upsert_ratings", "group_history"])
def test_plans_have_no_cross_product(spark, name):
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_reads_only_what_it_needs(spark):
    plan = queries()["scan_project"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(p_size), GreaterThan(p_size,10)]" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_size:int>" in plan


@pytest.mark.parametrize("name", ["semantic_search", "semantic_search_unfiltered"])
def test_search_does_not_shuffle_the_catalogue(spark, name):
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(movie_id" not in plan


def test_enriching_scans_the_vectors_once(spark):
    df = queries()["browse_semantic"](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan and "SortMergeJoin" not in plan
