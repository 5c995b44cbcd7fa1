"""Ready-to-pickup rows that are kept, first or noted, without grouping the pairs of triggers and responses."""

from dataclasses import replace

import pytest

from checks.registry import queries
from loadtrail.constants import ALERT_LABEL
from loadtrail.functions.status import response_note
from loadtrail.plans.rtp import rtp_first_rows, rtp_kept_rows, rtp_notes, rtp_rows
from tests import brute
from tests.helpers import READY, assert_same, log_frame, milestone_frame

# "r" + "1-7" and "r-1" + "7" are one execution id of two loads; " 7 " and "7" are one load number
LOADS = ["7", "8", "007", "1-7", "x9", None, " 7 ", "12345678901234567890123"]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def inputs(spark, seed):
    log, milestones = brute.random_inputs(seed, rows=260, loads=LOADS, hot_share=0.35)
    return log, milestones, log_frame(spark, log), milestone_frame(spark, milestones)


def expected_rows(log, milestones):
    rows = brute.correlate(log, READY)
    for row in rows:
        if row["trigger_message"]:
            row["trigger_message"] = row["trigger_message"].split(ALERT_LABEL)[1].strip()
    return brute.classify(rows, brute.flags(milestones, READY))


@pytest.mark.parametrize("pairs_per_split", [1, 4_000_000])
@pytest.mark.parametrize("seed", [1, 2, 5])
def test_rows_that_are_kept_and_first(spark, seed, pairs_per_split):
    log, milestones, logs, marks = inputs(spark, seed)
    params = replace(READY, pairs_per_split=pairs_per_split, rows_per_split=max(7, pairs_per_split))
    kept = brute.without_skipped(expected_rows(log, milestones))
    assert_same(rtp_kept_rows(logs, marks, params), kept)
    firsts = [row for row in brute.first_of_loads(kept) if abs(row["load_number"]) < 2**63]
    assert_same(rtp_first_rows(logs, marks, params), firsts)


@pytest.mark.parametrize("seed", [1, 2, 5, 7])
def test_notes_are_distinct_without_a_shuffle_of_pairs(spark, seed):
    _, _, logs, marks = inputs(spark, seed)
    columns = ("followup_sent_at", "response_timestamp", "actions")
    plain = rtp_rows(logs, marks, READY).selectExpr("workflow_exec_id", *columns, f"{response_note(*columns)} AS note")
    expected = [row.asDict() for row in plain.distinct().collect()]
    assert_same(rtp_notes(logs, marks, READY), expected)


@pytest.mark.parametrize("query", ["keep_first_by_status", "first_row_per_load", "response_note"])
def test_pairs_are_not_grouped(spark, query):
    """Only `first_row_per_load` groups rows with responses, and there a load has two rows left before it meets them."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(queries()[query](spark, "/root/testdata/sf0.001"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line for line in plan.splitlines() if "Join" in line and "response_load" in line]
    assert joins
    below_grouped = [part for part in plan.split("response_load")[1:] if "keys=[load_id" in part]
    if query == "first_row_per_load":
        assert below_grouped
    else:
        above = plan[: plan.index(joins[0])]
        assert "Aggregate" not in above and "Exchange" not in above
