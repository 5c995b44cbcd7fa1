"""Sharding by rendezvous hashing over weighted shards.

Every shard draws a score from the record key and its own number; the record goes to the highest score. Scores
of the old shards do not depend on how many there are, so a further shard only takes rows into itself. With
weights, ``-ln(u) / weight`` is smallest for the winner and shares follow the weights.

Defined cases: rows without a key share one key of their own (null hashes as the text ``null``); rows that repeat
a key go to the same shard. A null text has size 1 (no bytes plus one) and the checksum of the empty text. Equal
scores go to the smaller shard. An empty table gives an empty result. Only named columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadtrail.llm.staging import landed, shuffle_width


def drawn(key: Column, shard: int) -> Column:
    """A number in (0, 1) from key and shard, 52 bits of it random."""
    text = F.concat_ws("/", F.coalesce(key.cast("string"), F.lit("null")), F.lit(str(shard)))
    return (F.shiftrightunsigned(F.xxhash64(text), 12) + F.lit(0.5)) / F.lit(float(1 << 52))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key among ``len(weights)`` shards."""
    scores = [F.struct(-F.log(drawn(key, k)) / F.lit(float(w)), F.lit(k).alias("shard")) for k, w in enumerate(weights)]
    return F.least(*scores)["shard"] if len(scores) > 1 else F.lit(0)


def with_slots(rows: DataFrame, shard: str, order: Sequence[str]) -> DataFrame:
    """Number the rows of each shard from 0 without a gap, in the given order.

    Rows are dealt by ranges of the order, which has a random last key so that rows equal in all columns can be
    cut as well; a shard's rows in one range are numbered there and start where the ranges before end. The table
    of starts has one row per shard and range.
    """
    width = shuffle_width(rows.sparkSession)
    dealt = rows.withColumn("slot_tie", F.rand(11))
    keys = [shard, *order, "slot_tie"]
    dealt = dealt.repartitionByRange(width, *keys).withColumn("slot_range", F.spark_partition_id())
    dealt = landed(dealt, "shard-ranges")
    before = Window.partitionBy(shard).orderBy("slot_range").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        dealt.groupBy(shard, "slot_range")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(shard, "slot_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("slot_first"))
    )
    within = Window.partitionBy(shard, "slot_range").orderBy(*order, "slot_tie")
    numbered = dealt.withColumn("slot", F.row_number().over(within) - 1)
    return (
        numbered.join(firsts, [shard, "slot_range"])
        .withColumn("slot", (F.col("slot_first") + F.col("slot")).cast("long"))
        .drop("slot_tie", "slot_range", "slot_first")
    )


def sharded(
    docs: DataFrame,
    weights: Sequence[float] = (1.0,) * 8,
    grown: Sequence[float] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per row: identifier, size, checksum of the text, shard, slot, and the shard after growing to ``grown``."""
    grown = [*weights, 1.0] if grown is None else grown
    text, key = F.coalesce(docs[text_column], F.lit("")), docs[id_column]
    rows = docs.select(
        key.alias(id_column),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(key, weights).cast("int").alias("shard"),
        rendezvous(key, grown).cast("int").alias("grown_shard"),
    )
    return with_slots(rows, "shard", [id_column, "text_crc32", "size"])
