"""Shapes of the physical plans, on tables read from Parquet with broadcasting switched off."""

import re
from dataclasses import replace
from datetime import timedelta

import pytest

from loadtrail.operators.carriers import carrier_table
from loadtrail.operators.correlation import hot_loads
from loadtrail.operators.hotkeys import LEFT, RIGHT, copy_per_split, deal
from loadtrail.plans.classify import classify
from loadtrail.plans.correlate import correlate
from loadtrail.plans.notifier import notifier_classified, notifier_report
from loadtrail.plans.rtp import load_summary
from loadtrail.sources.tables import read_audit_log, read_milestones
from checks.registry import queries
from tests import brute
from tests.helpers import NOTIFIER, READY, at, log_frame, log_row, milestone_frame

SMALL = "/root/testdata/sf0.001"


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    log, milestones = brute.random_inputs(5, rows=200, loads=["1", "2", "3"])
    log_frame(spark, log).write.parquet(str(folder / "log"))
    milestone_frame(spark, milestones).write.parquet(str(folder / "milestones"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield read_audit_log(spark, str(folder / "log")), read_milestones(spark, str(folder / "milestones"))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_python_and_no_cartesian_product(spark, name):
    plan = plan_of(queries()[name](spark, SMALL))
    for bad in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_filters_and_columns_reach_the_scan(tables):
    log, _ = tables
    plan = correlate(log, NOTIFIER)._jdf.queryExecution().explainString(
        log._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    scans = re.findall(r"PushedFilters: (.*)\nReadSchema: (.*)", plan)
    assert len(scans) >= 4
    assert all("created_at" in filters or "request_id" in filters for filters, _ in scans)
    assert any("GreaterThanOrEqual(created_at,2024-01-10T00:00)" in filters for filters, _ in scans)
    assert any("EqualTo(workflow_identifier,notifier)" in filters for filters, _ in scans)
    # finding the active requests reads two columns
    assert any(set(re.findall(r"(\w+):", schema)) == {"request_id", "created_at"} for _, schema in scans)


def test_windows_are_partitioned_and_reports_have_none(tables):
    log, milestones = tables
    assert "Window" not in plan_of(notifier_classified(log, milestones, NOTIFIER))
    summary = plan_of(load_summary(log, milestones, READY))
    assert summary.count("+- Window [") <= 1 and "SinglePartition" not in summary


def test_grouping_combines_before_the_shuffle(tables):
    log, milestones = tables
    plan = plan_of(notifier_classified(log, milestones, NOTIFIER))
    assert "partial_min(" in plan
    assert "hashpartitioning(workflow_exec_id" in plan


def test_follow_up_join_is_cut_along_time(tables):
    log, milestones = tables
    joins = [line for line in plan_of(notifier_classified(log, milestones, NOTIFIER)).splitlines() if "SortMergeJoin" in line]
    assert any("m_slot" in line for line in joins)


def test_classified_rows_are_shared_not_recomputed(tables, spark):
    log, milestones = tables
    frame = notifier_classified(log, milestones, NOTIFIER)
    frame.collect()
    assert plan_of(frame).count("ReusedExchange") >= 2


def test_nothing_is_broadcast_by_hint_and_no_shuffle_is_pinned(tables, spark):
    log, milestones = tables
    carriers = carrier_table(spark.createDataFrame([], "body string, arrival_order bigint"))
    plan = plan_of(notifier_report(log, milestones, carriers, NOTIFIER))
    for bad in ("BroadcastHashJoin", "TakeOrderedAndProject", "REPARTITION_BY"):
        assert bad not in plan


def test_hot_load_is_laid_out_as_a_grid(spark):
    log, _ = brute.random_inputs(6, rows=300, loads=["hot", "cold"], hot_share=0.8)
    logs = log_frame(spark, log)
    hot = hot_loads(logs, replace(NOTIFIER, pairs_per_split=20))
    grid = {r.load_id: (r.left_splits, r.right_splits) for r in hot.collect()}
    across, down = grid["hot"]
    assert across > 1 and down > 1 and across * down > 4
    rows = spark.createDataFrame([("hot", n) for n in range(1000)] + [("cold", 1), (None, 1), (None, 2)], "load_id string, n int")
    dealt = deal(rows, "load_id", hot, LEFT, RIGHT).where("load_id = 'hot'")
    assert dealt.count() == 1000 * down
    assert dealt.select(LEFT, RIGHT).distinct().count() == across * down
    assert dealt.select("n", LEFT).distinct().count() == 1000
    assert deal(rows, "load_id", hot, RIGHT).count() == rows.count()
    copies = copy_per_split(rows.where("n = 1"), "load_id", hot, RIGHT).groupBy("load_id").count().collect()
    assert {r.load_id: r["count"] for r in copies} == {"hot": down, "cold": grid.get("cold", (1, 1))[1], None: 1}


def test_history_makes_a_load_hot(spark):
    day_before = at("00:00:00") - timedelta(days=1)
    rows = [log_row("1", f"t{n % 7}", "notifier", "ANY", day_before + timedelta(seconds=n)) for n in range(200)]
    rows += [log_row("1", f"r{n}", "shipment_update", "DETAILS_EXTRACTED", day_before + timedelta(seconds=n)) for n in range(40)]
    # every request has one row of another kind inside the range
    rows += [log_row("x", r, "other", "ANY", at("10:00:00")) for r in {row["request_id"] for row in rows}]
    found = hot_loads(log_frame(spark, rows), replace(NOTIFIER, pairs_per_split=200, rows_per_split=200)).collect()
    assert [(r.load_id, r.left_splits > 1, r.right_splits > 1) for r in found] == [("1", True, True)]
    assert found[0].left_splits * found[0].right_splits >= 40


def test_classify_accepts_no_rows(tables, spark):
    log, milestones = tables
    from loadtrail.operators.correlation import trigger_rows
    from loadtrail.operators.followups import milestone_flags

    nobody = replace(NOTIFIER, shipper_id="nobody")
    empty = classify(trigger_rows(log, nobody), milestone_flags(milestones, nobody), ["load_id"])
    assert empty.count() == 0


def test_shared_folder_is_the_one_the_session_names(spark):
    from checks.registry import shared_folder

    assert shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_folder(spark) != shared_folder(spark)
