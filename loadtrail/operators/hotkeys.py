"""Splitting hot join keys.

A load may own a large share of the log. A join whose cost grows with the pairs of a load must not
leave that load to one task, so its pairs are laid out as a grid: the rows of either side are dealt over
the splits of their side and copied once per split of the other. Every pair still meets in exactly one
cell: the result does not depend on which keys count as hot. All numbers follow from counts of the
rows that enter the join; none is capped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadtrail.functions.sql import names

LEFT, RIGHT = "left_splits", "right_splits"
#: Cells of one key in a join: enough to keep a cluster even, whatever the number of pairs.
CELLS_PER_KEY = 2048


def hot_keys(weights: DataFrame, key: str, left: str, right: str, pairs: int, rows: int) -> DataFrame:
    """`(key, left_splits, right_splits)` and what else `weights` holds, for keys that are too much for one task.

    `weights` has one row per key with the number of rows on the left and on the right. A cell gets at most
    `pairs` pairs, and a split at most `rows` rows. The table is not hinted: it has one row per key with many
    rows, so adaptive execution broadcasts it or splits the other side, by what it measures.
    """
    cells = f"greatest(1D, CAST({left} AS DOUBLE) * {right} / {pairs})"
    # near-square cells: the copies of both sides together are fewest
    across = f"least({left}, greatest(ceil({left} / {rows}D), ceil(sqrt({cells} * {left} / greatest({right}, 1)))))"
    down = f"least({right}, greatest(ceil({right} / {rows}D), ceil({cells} / greatest({LEFT}, 1))))"
    return (
        weights.where(f"{key} IS NOT NULL")
        .selectExpr("*", f"CAST(greatest(1, {across}) AS BIGINT) AS {LEFT}")
        .selectExpr("*", f"CAST(greatest(1, {down}) AS BIGINT) AS {RIGHT}")
        .where(f"{LEFT} > 1 OR {RIGHT} > 1")
        .drop(left, right)
    )


def within_cells(hot: DataFrame, cells: int = CELLS_PER_KEY) -> DataFrame:
    """The grids of `hot` with about `cells` cells for a key at most, in the same proportions.

    The grid of `hot_keys` grows with the pairs, and so do the copies of every row: with the square of the input, in all.
    A task gets many cells anyway, so a grid beyond some cells per task evens out nothing. With a bound on the cells a
    row has a bounded number of copies. Cells hold more pairs then, which are streamed: no pair is dropped.
    """
    coarser = f"greatest(1D, sqrt(CAST({LEFT} AS DOUBLE) * {RIGHT} / {cells}))"
    others = [column for column in hot.columns if column not in (LEFT, RIGHT)]
    return hot.selectExpr(
        *names(others), *[f"CAST(least(ceil({side} / {coarser}), {cells}) AS BIGINT) AS {side}" for side in (LEFT, RIGHT)]
    )


def deal(
    rows: DataFrame, key: str, hot: DataFrame, own: str, other: str | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """Add a place in the grid: `own` by a hash of the row, `other` once per split of the other side.

    Places are 0 for ordinary keys. Rows without a key match nothing: their place is the hash itself, which
    keeps them from piling up in one task. Without `other` nothing is copied. `carry` adds columns of `hot`.
    """
    columns = names(rows.columns)
    others = [other] if other else []
    lookup = hot.selectExpr(f"{key} AS hot_key", own, *others, *carry)
    found = rows.join(lookup, rows[key] == lookup["hot_key"], "left")
    place = f"xxhash64({', '.join(columns)})"
    return found.selectExpr(
        *columns,
        *carry,
        f"CASE WHEN {key} IS NULL THEN {place} ELSE pmod({place}, coalesce({own}, 1L)) END AS {own}",
        *[f"explode(sequence(0L, coalesce({side}, 1L) - 1)) AS {side}" for side in others],
    )


def copy_per_split(rows: DataFrame, key: str, hot: DataFrame, other: str) -> DataFrame:
    """One copy of each row per split of the other side, for few rows per key."""
    lookup = hot.selectExpr(f"{key} AS hot_key", other)
    found = rows.join(lookup, rows[key] == lookup["hot_key"], "left")
    return found.selectExpr(*names(rows.columns), f"explode(sequence(0L, coalesce({other}, 1L) - 1)) AS {other}")


def deal_to_single_rows(
    rows: DataFrame, single: DataFrame, key: str, hot: DataFrame | None, splits: str, empty_splits: int
) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join whose right side has few rows per key, with `splits` as a further key on both.

    The rows are dealt over the splits of their key, the others are copied to each. The null key is known to be
    heavy without counting: it has `empty_splits`, and its rows do not come together to be looked up either, since
    a salt that no hot key has stands beside them.
    """
    columns, others = names(rows.columns), names(single.columns)
    place = f"xxhash64({', '.join(columns)})"
    salted = rows.selectExpr(*columns, f"IF({key} IS NULL, pmod({place}, {empty_splits}L), -1L) AS salt")
    if hot is None:
        found, copied, own = salted, single, "1L"
    else:
        lookup = hot.selectExpr(f"{key} AS hot_key", f"{splits} AS hot_splits", "-1L AS hot_salt")
        found = salted.join(lookup, F.expr(f"{key} = hot_key AND salt = hot_salt"), "left")
        copied, own = single.join(lookup.drop("hot_salt"), single[key] == lookup["hot_key"], "left"), "coalesce(hot_splits, 1L)"
    return (
        found.selectExpr(*columns, f"IF({key} IS NULL, salt, pmod({place}, {own})) AS {splits}"),
        copied.selectExpr(*others, f"explode(sequence(0L, IF({key} IS NULL, {empty_splits}L, {own}) - 1)) AS {splits}"),
    )


def fold_copies(rows: DataFrame) -> DataFrame:
    """Identical rows as few rows with a count, for a join that must keep every copy.

    Copies meet before the shuffle, and no split could tell them apart later. A group of n rows becomes
    about sqrt(n) rows, told apart by `share`, each standing for its part of the `copies`.
    """
    columns = names(rows.columns)
    shares = "CAST(ceil(sqrt(count)) AS BIGINT)"
    return (
        rows.groupBy(*columns)
        .count()
        .selectExpr(*columns, "count", f"{shares} AS shares", f"explode(sequence(1L, {shares})) AS share")
        .selectExpr(*columns, "share", "count div shares + if(share <= count % shares, 1L, 0L) AS copies")
    )


def unfold_copies(rows: DataFrame) -> DataFrame:
    columns = [column for column in rows.columns if column not in ("share", "copies")]
    return rows.selectExpr(*names(columns), "explode(sequence(1L, copies)) AS copy").drop("copy")
