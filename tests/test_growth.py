"""Joins of a very hot load: the copies of a row are bounded, every pair is made."""

from loadtrail.operators.correlation import attach_responses
from loadtrail.operators.hotkeys import CELLS_PER_KEY, LEFT, RIGHT, within_cells
from tests.helpers import at

GRID = f"load_id string, {LEFT} long, {RIGHT} long, latest_response timestamp_ntz"


def test_a_grid_has_a_bounded_number_of_cells(spark):
    wide = [("1", 10**6, 10**5), ("2", 3, 4), ("3", 10**9, 1), ("4", 1, 10**9), ("5", CELLS_PER_KEY, 1)]
    hot = spark.createDataFrame([(*row, at("12:00:00")) for row in wide], GRID)
    found = {r.load_id: (r[LEFT], r[RIGHT]) for r in within_cells(hot).collect()}
    assert found["2"] == (3, 4) and found["5"] == (CELLS_PER_KEY, 1)
    assert all(left * right <= 1.2 * CELLS_PER_KEY for left, right in found.values())
    assert found["1"][0] > found["1"][1] > 10


def test_pairs_of_a_very_hot_load_all_meet(spark):
    """Each row used to be copied to every split of the other side: here 3,000,000,000 times."""
    rows = spark.createDataFrame(
        [("hot", n, at(f"10:00:{n:02}")) for n in range(40)], "load_id string, n int, trigger_timestamp timestamp_ntz"
    )
    responses = spark.createDataFrame(
        [("hot", "SUCCESS", "m", at(f"10:00:{n:02}"), "a") for n in range(0, 40, 3)],
        "load_id string, status string, response_message string, response_timestamp timestamp_ntz, actions string",
    )
    hot = spark.createDataFrame([("hot", 3 * 10**9, 3 * 10**9, at("10:00:39"))], GRID)
    found = attach_responses(rows, responses, hot).collect()
    pairs = sorted((r.n, r.response_timestamp.second) for r in found if r.response_timestamp)
    assert pairs == [(n, second) for n in range(40) for second in range(0, 40, 3) if n < second]
    assert [(r.n, r.status) for r in found if r.response_timestamp is None] == [(39, "AWAITING_RESPONSE")]
