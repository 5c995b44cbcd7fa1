"""Packing by minimum bin slack.

Documents become token ids plus one end id, cut into full windows and a rest. What the rests look like is a histogram
with at most ``window`` entries, whatever the size of the corpus, so the plan is made on it: the longest remaining
length opens a window, a subset-sum over bitsets finds the multiset of remaining lengths that fills it closest to
capacity, and the counts are traced back. The pattern is used as often as its counts last, which exhausts a length
each time, so there are at most ``window`` patterns. When no window can be filled whole any more, the remaining
pieces are laid end to end and cut at every window, which leaves less than one window of padding in all.

Spark numbers the pieces of each length across the cluster; number and plan give every piece its sequence and offset.

Defined cases: a null or empty text is its end id alone. Repeated rows are packed once each. Long texts are encoded
whole. An empty table gives an empty result. Only the identifier and the text are read, whatever else there is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadtrail.llm.sharding import with_slots
from loadtrail.llm.staging import landed, on_workers, row_batch
from loadtrail.llm.subwords import subwords

WINDOW = 1024
END_ID = 0
#: The string to which the vocabulary's tokenizer gives an id of its own.
SPECIAL = (("<|endoftext|>", 50256),)
PIECES = "row_id long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
CUT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


def piece_rows(ranks: tuple, window: int, end_id: int):
    """Encode documents; full windows carry their checksum, the rest carries its ids as well.

    An id takes two bytes, or four in a piece with ids above 65,535.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = subwords(*ranks)
        row_id = TaskContext.get().partitionId() << 33
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                rows = []
                part = batch.slice(low, 256)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = np.append(model.ids(text), np.uint32(end_id))
                    for start in range(0, len(ids), window):
                        piece = ids[start : start + window]
                        rest = piece.astype("<u2" if piece.max() < 1 << 16 else "<u4").tobytes() if len(piece) < window else None
                        rows.append((row_id, doc_id, start, len(piece), checksum(piece), len(ids), rest))
                    row_id += 1
                yield row_batch(rows, PIECES)

    return run


def fullest(counts: dict[int, int], anchor: int, capacity: int) -> dict[int, int]:
    """The multiset with the anchor in it that fills the capacity best: length -> how many.

    Bit ``k`` of a bitset says that sum ``k`` can be reached. Lengths enter from long to short, each with as many
    copies as remain and fit, and the bitset before each is kept to trace the counts back.
    """
    room = capacity - anchor
    mask = (1 << (room + 1)) - 1
    reached, layers = 1, []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        copies = min(counts[length] - (length == anchor), room // length)
        if copies < 1:
            continue
        layers.append((length, reached, copies))
        for _ in range(copies):
            more = (reached | reached << length) & mask
            if more == reached:
                break
            reached = more
        if reached >> room & 1:
            break
    total = reached.bit_length() - 1
    used = {anchor: 1}
    for length, before, copies in reversed(layers):
        taken = next(k for k in range(copies + 1) if total >= k * length and before >> (total - k * length) & 1)
        if taken:
            used[length] = used.get(length, 0) + taken
            total -= taken * length
    return used


def plan(histogram: dict[int, int], capacity: int, cut_rest: bool = True) -> tuple[list[tuple], list[tuple], int]:
    """Patterns and the line of what is left.

    Patterns: (length, first number, end number, uses in a window, offset, first sequence). Line: (length, first
    number, place of the first). The third value is the first sequence of the line. Without ``cut_rest`` windows are
    closed at their best fill and nothing is left for the line.
    """
    counts = {n: c for n, c in histogram.items() if c}
    begun = dict.fromkeys(counts, 0)
    patterns, sequence, left = [], 0, {}
    while counts:
        anchor = max(counts)
        used = fullest(counts, anchor, capacity)
        if cut_rest and sum(n * k for n, k in used.items()) < capacity:
            left[anchor] = counts.pop(anchor)
            continue
        times = min(counts[n] // k for n, k in used.items())
        offset = 0
        for n, k in used.items():
            patterns.append((n, begun[n], begun[n] + k * times, k, offset, sequence))
            begun[n] += k * times
            offset += n * k
            counts[n] -= k * times
            if not counts[n]:
                del counts[n]
        sequence += times
    line, place = [], 0
    for n in sorted(left):
        line.append((n, begun[n], place))
        place += n * left[n]
    return patterns, line, sequence


def cut_pieces(window: int):
    """Cut the pieces of the line at window borders; checksums are taken anew from the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, start, length, doc_tokens, place, first, ids in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(ids, f"<u{len(ids) // length}")
                at = 0
                while at < length:
                    sequence, offset = divmod(place + at, window)
                    n = min(length - at, window - offset)
                    rows.append((doc_id, start + at, n, checksum(ids[at : at + n]), doc_tokens, first + sequence, offset))
                    at += n
            yield row_batch(rows, CUT)

    return run


def packed(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
    ranks: tuple[str, str] | None = None,
    cut_rest: bool = True,
    special: tuple[tuple[str, int], ...] | None = None,
) -> DataFrame:
    """Per piece: document, start and length in it, checksum, tokens of the document, sequence and offset there.

    ``special`` names strings with an id of their own; with ``ranks`` of the caller there are none unless given.
    """
    spark = docs.sparkSession
    on_workers(spark)
    rows = docs.select(docs[id_column].cast("long"), F.coalesce(docs[text_column], F.lit("")))
    if special is None:
        special = () if ranks else SPECIAL
    pieces = landed(rows.mapInArrow(piece_rows((*(ranks or vocabulary()), special), window, end_id), PIECES), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    patterns, line, first = plan(histogram, window, cut_rest)
    slim = pieces.drop("ids")
    numbered = landed(with_slots(slim, "length", ["row_id", "start"]), "numbered-pieces")
    names = "length long, low long, high long, uses long, place long, first long"
    table = F.broadcast(spark.createDataFrame(patterns, names))
    here = (numbered["length"] == table["length"]) & (numbered["slot"] >= table["low"]) & (numbered["slot"] < table["high"])
    filled = numbered.join(table, here).select(
        "doc_id",
        "start",
        numbered["length"],
        "ids_crc32",
        "doc_tokens",
        (F.col("first") + F.expr("(slot - low) div uses")).alias("sequence_id"),
        (F.col("place") + (F.col("slot") - F.col("low")) % F.col("uses") * numbered["length"]).alias("offset"),
    )
    rest = F.broadcast(spark.createDataFrame(line, "length long, low long, place long"))
    there = (numbered["length"] == rest["length"]) & (numbered["slot"] >= rest["low"])
    laid = numbered.join(rest, there).select(
        "row_id",
        "doc_id",
        "start",
        numbered["length"],
        "doc_tokens",
        (F.col("place") + (F.col("slot") - F.col("low")) * numbered["length"]).alias("place"),
    )
    laid = laid.join(pieces.where("ids IS NOT NULL").select("row_id", "start", "ids"), ["row_id", "start"])
    laid = laid.select("doc_id", "start", "length", "doc_tokens", "place", F.lit(first).cast("long"), "ids")
    return filled.unionByName(laid.mapInArrow(cut_pieces(window), CUT))
