"""Physical-plan properties that matter at scale."""

import pytest

from fundscope.plans import catalog

from .conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "FlatMapGroupsInArrow", "MapInArrow")


def _plan(spark, name):
    df = catalog.queries()[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_cartesian_and_no_python(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    for node in PYTHON_NODES:
        assert node not in plan, (name, node)


def test_top_n_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(spark, "top_gifts")


def test_household_single_scan_rank_limit(spark):
    df = catalog.queries()["household_label"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("orders.parquet") == 1      # contacts read once, no self join
    assert "WindowGroupLimit" in plan


def test_filters_reach_the_scan(spark):
    df = catalog.queries()["top_gifts"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    orders_scans = [line for line in plan.splitlines() if "orders.parquet" in line]
    assert any("PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in s
               for s in orders_scans), orders_scans


def test_branch_pruning_by_source(spark):
    # the visit roll-up reads the visits branch only: no opportunity amounts are scanned
    plan = _plan(spark, "visits_rollup")
    assert "o_totalprice" not in plan


def test_column_pruning(spark):
    plan = _plan(spark, "qa_distinct_values")
    scan = [line for line in plan.splitlines() if "lineitem.parquet" in line][0]
    assert "l_extendedprice" not in scan and "l_shipdate" not in scan


UNHINTED = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}


@pytest.mark.parametrize("name,table,most", [
    ("contactors_unpivot", "events", 1), ("contact_links_unpivot", "events", 1), ("visits_qualified", "events", 1),
    ("visits_rollup", "events", 1), ("qa_visit_contacts", "events", 1), ("activity_contacts_audit", "events", 1),
    ("proposals", "orders", 1), ("scorecard_all_officers", "events", 1), ("scorecard", "events", 1)])
def test_large_inputs_are_read_once(spark, name, table, most):
    """Also where nothing is small enough to be broadcast; other tables derived from
    orders have scans of their own and are told apart by what they read."""
    for k, v in UNHINTED.items():
        spark.conf.set(k, v)
    try:
        plan = _plan(spark, name)
    finally:
        for k in UNHINTED:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    mark = {"events": "events.parquet", "orders": "o_totalprice"}[table]
    scans = [x for x in plan.splitlines() if "FileScan parquet" in x and mark in x]
    assert len(scans) <= most, scans


def test_nothing_is_joined_above_the_visit_counts(spark):
    plan = _plan(spark, "visits_qualified").splitlines()
    expansion = next(i for i, x in enumerate(plan) if "explode(sequence" in x)
    assert not any("Join" in x for x in plan[:expansion])


def test_building_a_query_runs_no_job(spark):
    sc = spark.sparkContext
    c = catalog.context(spark, SF_SMALL)
    assert c.crm and c.params   # reads the Parquet schemas, the only thing that may run
    sc.setJobGroup("building", "no jobs here")
    try:
        for build in catalog.QUERIES.values():
            build(c)
        jobs = sc.statusTracker().getJobIdsForGroup("building")
    finally:
        sc.setJobGroup("after", "")
    assert list(jobs) == []


def test_dollars_are_deduplicated_on_what_decides(spark):
    keys = [x.split("hashpartitioning(")[1].split(", ") for x in _plan(spark, "dollars_dedup").splitlines() if "hashpartitioning(" in x]
    # eleven columns, the number of partitions, the exchange's reason and plan id
    assert max(len(k) for k in keys) <= 11 + 3
    assert not [k for k in keys if any("hh_name" in c for c in k) and any("gift_name" in c for c in k)]
