"""Hard negatives: rows of another label that score almost as high as a positive, found by blocks with zone maps.

Vectors become integers and are ordered along a Hilbert curve over their dimensions of largest variance. Some hundreds of
rows in that order make a block: one row of a landed Parquet table with the packed vectors and, per dimension, the
smallest and largest component. From these, interval arithmetic bounds the scores that an anchor can reach in a block: a
positive component of the anchor times the interval's upper end, a negative one times the lower end, summed, is the most.
A search asks, per anchor, for the best rows in windows of scores, of the anchor's label or of others. An anchor is sent
to the parts of the table whose own zone maps reach one of its windows, and reads there only the blocks whose bounds do,
the most promising first, until what it has found beats the bounds of the rest.

Every search has two steps: the anchor's own part gives a score that the last row found reaches at least, and the other
parts are asked from that score on. Positives are one window without ends; each of them is then a window, 50 to 95
hundredths of its score. Anchors are a stated set of queries, so the search is theirs against all rows, in blocks; no
pairs of rows are made.

Defined cases: rows without identifier or label, without a vector, or with a component that is null or not finite take no
part. Shorter vectors end in zeros. A repeated identifier is a row of its own, as a candidate and as an anchor; an anchor
is not its own positive, but its copy may be. Components of a size that makes scores of 2^52 are an error. A positive
score below zero has no window. An anchor without positives, or a positive without negatives, gives no row; nor does an
empty table. Only the named columns are read. The driver holds zone maps of at most ``ZONES`` groups of parts and the
statistics of each dimension.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadtrail.llm.staging import column_batch, landed, on_workers, row_batch, shuffle_width

BLOCK_ROWS = 512
PART_ROWS = 65_536
#: Groups of parts whose zone maps the driver sends to the tasks; with many dimensions fewer.
ZONES = 4_096
HILBERT_DIMENSIONS, HILBERT_BITS = 8, 8
#: Anchors that a task compares with a block at once.
ANCHOR_ROWS = 256
LOWEST, HIGHEST = -(1 << 62), 1 << 62
STATISTICS = "d int, n double, s double, q double, low double, high double"
VECTORS = "id long, label int, vec binary"
KEYED = "hilbert binary, id long, label int, vec binary"
BLOCKS = "part int, kind int, number long, label int, vec binary, ids binary, rids binary, labels binary, low binary, high binary"
FOUND = "rid long, anchor_id long, slot int, score long, id long, found_rid long"


@dataclass(frozen=True)
class Space:
    """What the statistics tell: dimensions, those of the curve with their range, and an exact number type."""

    size: int
    curve: tuple[int, ...]
    low: tuple[int, ...]
    high: tuple[int, ...]
    kind: str

    def matrix(self, packed: Sequence[bytes]) -> np.ndarray:
        """Rows of packed vectors, zeros where they end early."""
        width = 4 * self.size
        whole = b"".join(p if len(p) == width else p + bytes(width - len(p)) for p in packed)
        return np.frombuffer(whole, np.int32).reshape(len(packed), self.size)


def integer_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole numbers ``floor(256 x)`` of the rows that take part, packed, with the label as the rows count it."""
    for batch in batches:
        rows = []
        for own_id, vector, label in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if own_id is None or label is None or vector is None or None in vector:
                continue
            exact = np.floor(256.0 * np.asarray(vector, np.float64))
            if not np.isfinite(exact).all():
                continue
            if np.abs(exact).max(initial=0) >= 1 << 31:
                raise ValueError(f"row {own_id}: scores beyond 2^52")
            rows.append((own_id, int(math.fmod(label + 1, 10)) if own_id % 7 == 0 else label, exact.astype(np.int32).tobytes()))
        yield row_batch(rows, VECTORS)


def statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per dimension and task: count, sum, sum of squares, least and largest component."""
    n = total = squares = low = high = np.zeros(0)
    for batch in batches:
        for packed in batch.column(0).to_pylist():
            v = np.frombuffer(packed, np.int32).astype(np.float64)
            if len(v) > len(n):
                more = np.zeros(len(v) - len(n))
                n, total, squares, low, high = (np.concatenate([x, more]) for x in (n, total, squares, low, high))
            k = len(v)
            n[:k] += 1
            total[:k] += v
            squares[:k] += v * v
            low[:k], high[:k] = np.minimum(low[:k], v), np.maximum(high[:k], v)
    if len(n):
        yield column_batch([np.arange(len(n)), n, total, squares, low, high], STATISTICS)


def space_of(vectors: DataFrame) -> Space:
    """Least and largest components count zero, which ends shorter vectors."""
    names = "n s q".split()
    found = (
        vectors.select("vec")
        .mapInArrow(statistics, STATISTICS)
        .groupBy("d")
        .agg(*[F.sum(x).alias(x) for x in names], F.min("low").alias("low"), F.max("high").alias("high"))
        .orderBy("d")
        .collect()
    )
    spread = [r["q"] / r["n"] - (r["s"] / r["n"]) ** 2 for r in found]
    curve = sorted(sorted(range(len(found)), key=lambda d: (-spread[d], d))[:HILBERT_DIMENSIONS])
    most = max((max(-r["low"], r["high"]) for r in found), default=0) ** 2 * max(len(found), 1)
    if most >= 1 << 52:
        raise ValueError("scores beyond 2^52")
    kind = "float32" if most < 1 << 23 else "float64"
    low, high = (tuple(int(found[d][end]) for d in curve) for end in ("low", "high"))
    return Space(len(found), tuple(curve), low, high, kind)


def hilbert_keys(points: np.ndarray, bits: int) -> list[bytes]:
    """Places along the Hilbert curve, as bytes that sort like them, of rows of ``bits``-bit coordinates.

    The steps undo, from the highest bit down, the rotations and reflections of the curve's cells, for all rows at once;
    a Gray code over the dimensions then gives the bits of the place.
    """
    x = points.astype(np.uint32).copy()
    n = x.shape[1]
    if not n:
        return [b""] * len(x)
    for bit in range(bits - 1, 0, -1):
        below = np.uint32((1 << bit) - 1)
        for d in range(n):
            set_ = (x[:, d] >> np.uint32(bit)) & np.uint32(1) == 1
            swapped = (x[:, 0] ^ x[:, d]) & below
            x[:, 0] = np.where(set_, x[:, 0] ^ below, x[:, 0] ^ swapped)
            if d:
                x[:, d] = np.where(set_, x[:, d], x[:, d] ^ swapped)
    for d in range(1, n):
        x[:, d] ^= x[:, d - 1]
    turn = np.zeros(len(x), np.uint32)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[:, n - 1] >> np.uint32(bit)) & np.uint32(1) == 1, np.uint32((1 << bit) - 1), np.uint32(0))
    x ^= turn[:, None]
    shifts = np.arange(bits - 1, -1, -1, dtype=np.uint32)
    planes = ((x[:, None, :] >> shifts[None, :, None]) & np.uint32(1)).astype(np.uint8).reshape(len(x), bits * n)
    packed = np.packbits(planes, axis=1)
    return [row.tobytes() for row in packed]


def zone(matrix: np.ndarray) -> tuple[bytes, bytes]:
    return matrix.min(axis=0).tobytes(), matrix.max(axis=0).tobytes()


def blocked(vectors: DataFrame, space: Space, parts: int, block_rows: int) -> DataFrame:
    """The landed table of blocks: packed rows in the curve's order, ranges of which are the parts."""
    step = [max((high - low + 1) / (1 << HILBERT_BITS), 1.0) for low, high in zip(space.low, space.high)]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = space.matrix(batch.column(2).to_pylist())[:, list(space.curve)] - np.array(space.low)
                keys = hilbert_keys((at / np.array(step)).astype(np.int64), HILBERT_BITS)
                yield column_batch([pa.array(keys, pa.binary()), *batch.columns], KEYED)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        number, held = part << 40, []
        for batch in batches:
            held += zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)))
            while len(held) >= block_rows:
                yield block(part, number, held[:block_rows])
                number, held = number + block_rows, held[block_rows:]
        if held:
            yield block(part, number, held)

    def block(part: int, number: int, rows: list[tuple]) -> pa.RecordBatch:
        rows = sorted(rows, key=lambda r: r[0])  # of equal scores the first is the smaller identifier
        ids, labels, vectors = zip(*rows)
        matrix = space.matrix(vectors)
        rids = np.arange(number, number + len(rows))
        columns = [np.array(ids, np.int64), rids, np.array(labels, np.int32)]
        return row_batch([(part, 0, number, None, matrix.tobytes(), *(c.tobytes() for c in columns), *zone(matrix))], BLOCKS)

    ordered = vectors.mapInArrow(keyed, KEYED).repartitionByRange(parts, "hilbert", "id").sortWithinPartitions("hilbert", "id")
    return landed(ordered.mapInArrow(packed, BLOCKS), "vector-blocks")


def anchors_of(blocks: DataFrame, space: Space, every: int) -> DataFrame:
    """One landed row per anchor: its part, row number, identifier, label and vector."""

    ddl = "home int, rid long, id long, label int, vec binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for part, vec, *packed in zip(*(batch.column(k).to_pylist() for k in range(5))):
                ids, rids = (np.frombuffer(p, np.int64) for p in packed[:2])
                labels, width = np.frombuffer(packed[2], np.int32), 4 * space.size
                for k in np.flatnonzero(ids % every == 0).tolist():
                    rows.append((part, int(rids[k]), int(ids[k]), int(labels[k]), vec[width * k : width * k + width]))
            yield row_batch(rows, ddl)

    packed = blocks.select("part", "vec", "ids", "rids", "labels")
    return landed(packed.mapInArrow(work, ddl), "anchors")


class Zones:
    """Bounds of the scores between anchors and boxes."""

    def __init__(self, low: np.ndarray, high: np.ndarray, full: np.ndarray | None = None):
        self.low, self.high, self.full = low.astype(np.float64), high.astype(np.float64), full

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per anchor and box the least and the largest score."""
        up, down = np.maximum(anchors, 0).astype(np.float64), np.minimum(anchors, 0).astype(np.float64)
        least, most = up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T
        return least.astype(np.int64), most.astype(np.int64)


def part_zones(blocks: DataFrame, space: Space, parts: int) -> tuple[np.ndarray, Zones]:
    """For every part its group, and the groups' boxes; their number has a fixed bound."""
    groups = min(parts, max(1, ZONES * 64 // max(space.size, 1)))
    ddl = "zone_group int, low binary, high binary"

    def hulls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        boxes: dict[int, tuple] = {}
        for batch in batches:
            for g, low, high in zip(*(batch.column(k).to_pylist() for k in range(3))):
                low, high = np.frombuffer(low, np.int32), np.frombuffer(high, np.int32)
                known = boxes.get(g, (low, high))
                boxes[g] = np.minimum(known[0], low), np.maximum(known[1], high)
        yield row_batch([(g, a.tobytes(), b.tobytes()) for g, (a, b) in boxes.items()], ddl)

    grouped = blocks.select(F.expr(f"CAST(part * {groups}L DIV {parts} AS INT) AS zone_group"), "low", "high")
    # a box of nothing: no bound reaches any window
    low, high = np.full((groups, space.size), 0, np.int64), np.full((groups, space.size), 0, np.int64)
    full = np.zeros(groups, bool)
    for row in grouped.mapInArrow(hulls, ddl).coalesce(1).mapInArrow(hulls, ddl).collect():
        g = row["zone_group"]
        low[g], high[g], full[g] = np.frombuffer(row["low"], np.int32), np.frombuffer(row["high"], np.int32), True
    return np.arange(parts) * groups // parts, Zones(low, high, full)


def reaching(least: np.ndarray, most: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Per anchor and box, whether the bounds meet one of the anchor's windows."""
    found = np.zeros(least.shape, bool)
    for w in range(low.shape[1]):
        found |= (most >= low[:, w, None]) & (least <= high[:, w, None]) & (low[:, w] <= high[:, w])[:, None]
    return found


def routed(anchors: DataFrame, space: Space, parts: int, zones: tuple[np.ndarray, Zones], where: str) -> DataFrame:
    """A copy of each anchor for its own part, or for every other one that may hold rows of its windows."""
    group_of, boxes = zones

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = max(1, 20_000 // parts)
        for batch in batches:
            for begin in range(0, batch.num_rows, rows):
                yield sent(batch.slice(begin, rows))

    def sent(batch: pa.RecordBatch) -> pa.RecordBatch:
        home = batch.column(0).to_numpy()
        matrix = space.matrix(batch.column(4).to_pylist())
        low, high = (np.array(batch.column(k).to_pylist(), np.int64) for k in (5, 6))
        reach = (reaching(*boxes.bounds(matrix), low, high) & boxes.full)[:, group_of]
        own = home[:, None] == np.arange(parts)
        reach = own if where == "own" else reach & ~own
        row, part = np.nonzero(reach)
        pick = pa.array(row)
        packed = [pa.array([x.tobytes() for x in windows], pa.binary()).take(pick) for windows in (low, high)]
        ids = pa.array([int(x).to_bytes(8, "little", signed=True) for x in batch.column(2).to_pylist()], pa.binary())
        nothing = pa.nulls(len(row), pa.binary())
        columns = [part, np.ones(len(row), np.int32), batch.column(1).take(pick), batch.column(3).take(pick), batch.column(4).take(pick)]
        return column_batch([*columns, ids.take(pick), nothing, nothing, *packed], BLOCKS)

    return anchors.select("home", "rid", "id", "label", "vec", "low", "high").mapInArrow(work, BLOCKS)


class Part:
    """The blocks of one part in a task, and the search in them."""

    def __init__(self, space: Space, block_rows: int, same: bool, best: int):
        self.space, self.same, self.best = space, same, best
        self.shift = max((block_rows - 1).bit_length(), 1)
        self.blocks: list[tuple] = []
        self.boxes: Zones | None = None

    def add(self, vec: bytes, ids: bytes, rids: bytes, labels: bytes, low: bytes, high: bytes) -> None:
        rids = np.frombuffer(rids, np.int64)
        matrix = np.frombuffer(vec, np.int32).reshape(len(rids), self.space.size)
        labels = np.frombuffer(labels, np.int32)
        box = np.frombuffer(low, np.int32), np.frombuffer(high, np.int32)
        self.blocks.append((matrix.astype(self.space.kind), np.frombuffer(ids, np.int64), rids, labels, np.unique(labels), *box))

    def labelled(self, labels: np.ndarray) -> np.ndarray:
        """Per anchor and block, whether the block has rows of a label that counts."""
        found = np.zeros((len(labels), len(self.blocks)), bool)
        for b, (*_, known, _, _) in enumerate(self.blocks):
            has = np.isin(labels, known)
            found[:, b] = has if self.same else ~has | (len(known) > 1)
        return found

    def search(self, rids: np.ndarray, labels: np.ndarray, matrix: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple:
        """Scores, identifiers and row numbers of the best rows per anchor and window; LOWEST where there are fewer."""
        shape = (*low.shape, self.best)
        score, ids, found = np.full(shape, LOWEST), np.full(shape, HIGHEST), np.full(shape, HIGHEST)
        if not self.blocks:
            return score, ids, found
        if self.boxes is None:
            self.boxes = Zones(np.array([b[5] for b in self.blocks]), np.array([b[6] for b in self.blocks]))
        least, most = self.boxes.bounds(matrix)
        counts = self.labelled(labels)
        floor, exact = low.copy(), matrix.astype(self.space.kind)
        for b in np.argsort(-most.max(axis=0), kind="stable"):
            need = counts[:, b] & reaching(least[:, b : b + 1], most[:, b : b + 1], floor, high)[:, 0]
            rows = np.flatnonzero(need)
            if not len(rows):
                continue
            block, block_ids, block_rids, block_labels, *_ = self.blocks[b]
            scores = (exact[rows] @ block.T).astype(np.int64)
            right = block_labels == labels[rows, None]
            right = right & (block_rids != rids[rows, None]) if self.same else ~right
            # the score, then the place in the block, the first one highest
            places = (scores << self.shift) + ((1 << self.shift) - 1 - np.arange(len(block)))
            for w in range(low.shape[1]):
                valid = right & (scores >= floor[rows, w, None]) & (scores <= high[rows, w, None])
                some = np.flatnonzero(valid.any(axis=1))
                if len(some):
                    top = np.where(valid[some], places[some], LOWEST)
                    if top.shape[1] > self.best:
                        top = np.partition(top, top.shape[1] - self.best, axis=1)[:, -self.best :]
                    self._merge(rows[some], w, top, block_ids, block_rids, score, ids, found)
                    floor[rows[some], w] = np.maximum(low[rows[some], w], score[rows[some], w, -1])
        return score, ids, found

    def _merge(self, rows: np.ndarray, w: int, top: np.ndarray, block_ids, block_rids, score, ids, found) -> None:
        place = (1 << self.shift) - 1 - (top & ((1 << self.shift) - 1))
        met = top > LOWEST
        place = np.where(met, place, 0)
        both = [
            np.concatenate([old[rows, w], np.where(met, new, none)], axis=1)
            for old, new, none in (
                (score, top >> self.shift, LOWEST),
                (ids, block_ids[place], HIGHEST),
                (found, block_rids[place], HIGHEST),
            )
        ]
        order = np.lexsort((both[2], both[1], -both[0]), axis=1)[:, : self.best]
        for known, new in zip((score, ids, found), both):
            known[rows, w] = np.take_along_axis(new, order, axis=1)


def search(
    blocks: DataFrame, anchors: DataFrame, space: Space, parts: int, zones, same: bool, best: int, where: str, block_rows: int
) -> DataFrame:
    """Landed: per anchor, window and part the best rows in the window, of the anchor's label or of others.

    A task gets the blocks of its part first, which have a bounded size, and then streams the anchors sent there.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blocks_of, held = None, None, []
        for batch in batches:
            for own, kind, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                if own != part:
                    yield from answered(blocks_of, held)
                    part, blocks_of, held = own, Part(space, block_rows, same, best), []
                if kind == 0:
                    blocks_of.add(*rest[2:])
                    continue
                held.append(rest)
                if len(held) == ANCHOR_ROWS:
                    yield from answered(blocks_of, held)
                    held = []
        yield from answered(blocks_of, held)

    def answered(blocks_of: Part | None, held: list) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        rids, labels = (np.array([r[k] for r in held]) for k in (0, 1))
        ids = np.frombuffer(b"".join(r[3] for r in held), np.int64)
        low, high = (np.array([np.frombuffer(r[k], np.int64) for r in held]) for k in (6, 7))
        score, found_ids, found = blocks_of.search(rids, labels, space.matrix([r[2] for r in held]), low, high)
        row, slot, k = np.nonzero(score > LOWEST)
        columns = [rids[row], ids[row], slot, score[row, slot, k], found_ids[row, slot, k], found[row, slot, k]]
        yield column_batch(columns, FOUND)

    names = [f.split()[0] for f in BLOCKS.split(", ")]
    rows = blocks.select(*names).unionByName(routed(anchors, space, parts, zones, where).select(*names))
    dealt = rows.repartition(parts, "part").sortWithinPartitions("part", "kind", "number")
    return landed(dealt.mapInArrow(work, FOUND), "scores")


def best_of(found: DataFrame, keys: Sequence[str], best: int) -> DataFrame:
    """The first rows per key, by score and then identifier, numbered from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id", "found_rid")
    return found.withColumn("place", F.row_number().over(order)).where(f"place <= {best}")


def hard_negatives(
    embeddings: DataFrame,
    every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    lowest_percent: int = 50,
    highest_percent: int = 95,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    part_rows: int = PART_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Per anchor and positive the best rows of other labels whose score is within the percentages of the positive's."""
    spark = embeddings.sparkSession
    on_workers(spark)
    given = embeddings.select(
        F.col(id_column).cast("long"), F.col(vector_column).cast("array<double>"), F.col(label_column).cast("int")
    )
    vectors = landed(given.mapInArrow(integer_vectors, VECTORS), "integer-vectors")
    space = space_of(vectors)
    parts = max(shuffle_width(spark), -(-vectors.count() // part_rows))
    blocks = blocked(vectors, space, parts, block_rows)
    parts = (blocks.agg(F.max("part")).first()[0] or 0) + 1
    zones = part_zones(blocks, space, parts)
    anchors = anchors_of(blocks, space, every)

    def asked(rows: DataFrame, same: bool, best: int) -> DataFrame:
        """The own part first: what it gives beats most of the other parts' blocks and rows."""
        near = search(blocks, rows, space, parts, zones, same, best, "own", block_rows)
        reached = near.groupBy("rid", "slot").agg(F.min("score").alias("last"), F.count(F.lit(1)).alias("n"))
        lasts = reached.where(f"n = {best}").groupBy("rid").agg(F.expr("map_from_entries(collect_list(struct(slot, last))) AS lasts"))
        low = F.expr("transform(low, (x, w) -> greatest(x, coalesce(lasts[w], x)))")
        floors = rows.join(lasts, "rid", "left").withColumn("low", low).drop("lasts")
        others = search(blocks, floors, space, parts, zones, same, best, "others", block_rows)
        return best_of(near.unionByName(others), ["rid", "slot"], best)

    wide = anchors.withColumns({"low": F.array(F.lit(LOWEST)), "high": F.array(F.lit(HIGHEST))})
    known = asked(wide, True, positives)
    known = landed(known.selectExpr("rid", "anchor_id", "place", "id AS positive_id", "score AS positive_score"), "positives")

    # whole numbers n with lowest * p <= 100 * n <= highest * p; of a negative p the first bound exceeds the second
    low, high = f"-((-{lowest_percent} * positive_score) DIV 100)", f"({highest_percent} * positive_score) DIV 100"
    low, high = f"IF(positive_score < 0, 1L, {low})", f"IF(positive_score < 0, 0L, {high})"
    listed = f"transform(sort_array(collect_list(struct(place, {low} AS low, {high} AS high))), x -> x.%s) AS %s"
    windows = known.groupBy("rid").agg(F.expr(listed % ("low", "low")), F.expr(listed % ("high", "high")))
    # a window list has the same length everywhere
    pad = {"low": F.lit(1).cast("long"), "high": F.lit(0).cast("long")}
    windows = windows.withColumns(
        {c: F.concat(c, F.array_repeat(pad[c], F.lit(positives) - F.size(c))) for c in ("low", "high")}
    )
    found = asked(anchors.join(windows, "rid"), False, negatives)
    found = found.selectExpr("rid", "slot + 1 AS place", "place AS rank", "id AS negative_id", "score AS negative_score")
    return known.join(found, ["rid", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
