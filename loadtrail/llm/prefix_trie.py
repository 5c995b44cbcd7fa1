"""Prefix trie of conversations: which share their first turns, and what sharing saves.

A turn is a key of 20 bytes, 16 of a SHA-256 over role and text and 4 for the text's code points, and a conversation the
keys of its turns end to end, so no text is shuffled. Equal conversations become one sequence with a count before they
meet. Sequences are dealt into shards by a prefix: one turn, or two, four, ... where the sequences that share a prefix have
too many turns for one shard. Each shard numbers its turns densely and packs its trie into a double array: the child of
node ``s`` by turn ``c`` is ``BASE[s] + c`` if ``CHECK`` there names ``s``. All sequences walk it together for the
nodes and their aggregates. Nodes above a shard's prefix lie in several shards; their aggregates are merged globally,
keyed by path, and their children, leaves and savings are counted after that.

Defined cases: rows without a conversation id take no part. A null role or text is empty. Turns come in the order of
their numbers, null first; equal numbers in the order of their keys, repeated rows as turns of their own. The block of a
negative id follows the sign of ``%``. Without conversations there are no nodes, not even a root. Only the named
columns are read. A conversation is held by one task with 20 bytes a turn, its text never; the ids that end at one node are
hashed as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadtrail.llm.staging import column_batch, landed, on_workers, row_batch, shuffle_width

KEY = 20
TURN = np.dtype([("key", "S16"), ("chars", ">u4")])
#: Turns of sequences with one prefix, from which on a longer prefix deals them out.
PREFIX_TURNS = 5_000
#: Turns that a shard holds, more or less.
SHARD_TURNS = 100_000
BLOCK, HEADS = 100, 6
NODES = (
    "upper boolean, path binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, chars long, ends long"
)


class DoubleArray:
    """A trie over dense codes, packed into BASE and CHECK; node 0 is the root."""

    def __init__(self, codes: np.ndarray, offsets: np.ndarray, alphabet: int):
        self.alphabet = max(alphabet, 1)
        self.base = np.zeros(1, np.int64)
        self.check = np.zeros(1, np.int64)
        self.used = 1  # all places from here on are free
        lengths = np.diff(offsets)
        state = np.zeros(len(lengths), np.int64)
        for depth in range(int(lengths.max(initial=0))):
            going = np.flatnonzero(lengths > depth)
            code = codes[offsets[going] + depth]
            pairs = np.unique(state[going] * self.alphabet + code)
            self._place(pairs // self.alphabet, pairs % self.alphabet)
            state[going] = self.base[state[going]] + code

    def _room(self, places: int) -> None:
        """Let so many places lie free beyond those in use."""
        if self.used + places > len(self.check):
            more = max(self.used + places, 2 * len(self.check)) - len(self.check)
            self.check = np.concatenate([self.check, np.full(more, -1)])
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])

    def _place(self, parents: np.ndarray, codes: np.ndarray) -> None:
        """Give every parent a base where all its children find room; pairs come sorted."""
        firsts = np.flatnonzero(np.diff(parents, prepend=-1))
        counts = np.diff(firsts, append=len(parents))
        self._room(len(parents) + self.alphabet)
        free = np.flatnonzero(self.check[: self.used] < 0)
        at = 0
        for k in np.flatnonzero(counts > 1):
            own = codes[firsts[k] : firsts[k] + counts[k]]
            base = None
            while base is None and at < len(free):  # gaps where the smallest child could lie, 64 at a time
                bases = free[at : at + 64] - own[0]
                fits = (self.check[bases[:, None] + own] < 0).all(axis=1)
                if fits.any():
                    base = bases[fits.argmax()]
                else:
                    at += 64
            if base is None:
                base = self.used - own[0]
            self._take(parents[firsts[k] : firsts[k] + 1], base, base + own)
            self._room(len(parents) + self.alphabet)
        single = firsts[counts == 1]
        places = np.flatnonzero(self.check < 0)[: len(single)]
        if len(single):
            self._take(parents[single], places - codes[single], places)

    def _take(self, parents: np.ndarray, bases: np.ndarray, places: np.ndarray) -> None:
        self.base[parents] = bases
        self.check[places] = parents
        self.used = max(self.used, int(places[-1]) + 1)

    def walk(self, codes: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Depth, the sequences that reach it, and their nodes, from the root on."""
        lengths = np.diff(offsets)
        going, state = np.arange(len(lengths)), np.zeros(len(lengths), np.int64)
        yield 0, going, state
        for depth in range(int(lengths.max(initial=0))):
            on = lengths[going] > depth
            going, state = going[on], state[on]
            step = self.base[state] + codes[offsets[going] + depth]
            if (self.check[step] != state).any():
                raise AssertionError("a sequence leaves the trie")
            state = step
            yield depth + 1, going, state


def shard_nodes(ids: np.ndarray, counts: np.ndarray, cuts: np.ndarray, sequences: list[bytes]) -> Iterator[list]:
    """Columns of NODES for the nodes of one shard's trie, level by level."""
    turns = np.frombuffer(b"".join(sequences), TURN)
    offsets = np.cumsum([0] + [len(s) // KEY for s in sequences])
    known, codes = np.unique(turns.view("S20"), return_inverse=True)
    trie = DoubleArray(codes, offsets, len(known))
    size = len(trie.check)
    n, children, leaves, saved = (np.zeros(size, np.int64) for _ in range(4))
    least, ends = np.full(size, np.iinfo(np.int64).max), np.full(size, -1)
    cut, chars, sample = (np.zeros(size, np.int64) for _ in range(3))
    levels = []
    for depth, going, state in trie.walk(codes, offsets):
        np.add.at(n, state, counts[going])
        np.minimum.at(least, state, ids[going])
        sample[state], cut[state] = going, cuts[going]
        last = going[np.diff(offsets)[going] == depth]
        ends[state[np.diff(offsets)[going] == depth]] = last
        if depth:
            chars[state] = turns["chars"][offsets[going] + depth - 1]
        levels.append(np.unique(state))
    for depth, nodes in reversed(list(enumerate(levels))):
        owned = nodes[cut[nodes] <= depth]
        leaves[owned] += children[owned] == 0
        saved[owned] += (n[owned] - 1) * chars[owned]
        if depth:
            above = trie.check[nodes]
            for total, part in ((children, 1), (leaves, leaves[nodes]), (saved, saved[nodes])):
                np.add.at(total, above, part)
    for depth, nodes in enumerate(levels):
        upper, top = cut[nodes] > depth, cut[nodes] == depth
        paths = [
            sequences[s][: KEY * (depth if u else depth - 1)] if u or t else None
            for s, u, t in zip(sample[nodes].tolist(), upper.tolist(), top.tolist())
        ]
        above = trie.check[nodes] if depth else nodes
        ended = ends[nodes]
        yield [
            upper,
            paths,
            np.full(len(nodes), depth),
            least[nodes],
            pa.array(least[above], mask=upper | top),
            n[nodes],
            children[nodes],
            leaves[nodes],
            saved[nodes],
            chars[nodes],
            pa.array(ids[np.maximum(ended, 0)], mask=ended < 0),
        ]


def trie_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of the tries of one task's sequences, one shard."""
    held = list(batches)
    if sum(b.num_rows for b in held):
        table = pa.Table.from_batches(held)
        ids, counts, cuts = (table.column(k).to_numpy() for k in range(3))
        for columns in shard_nodes(ids, counts, cuts, table.column(3).to_pylist()):
            yield column_batch(columns, NODES)


def prefix(sequence: str, turns: str) -> Column:
    return F.expr(f"substring({sequence}, 1, CAST({KEY} * ({turns}) AS INT))")


def sequences_of(conversations: DataFrame, id_column: str, turn_column: str, role_column: str, text_column: str) -> DataFrame:
    """One landed row per conversation: ``conv_id`` and the keys of its turns as ``seq``."""
    role, text = (F.coalesce(conversations[c], F.lit("")) for c in (role_column, text_column))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    key = F.concat(F.substring(digest, 1, 2 * (KEY - 4)), F.lpad(F.hex(F.length(text)), 8, "0"))
    turns = conversations.where(conversations[id_column].isNotNull()).select(
        conversations[id_column].cast("long").alias("conv_id"),
        F.struct(conversations[turn_column].alias("turn"), key.alias("key")).alias("turn"),
    )
    ordered = F.transform(F.sort_array(F.collect_list("turn")), lambda t: t["key"])
    whole = turns.groupBy("conv_id").agg(F.unhex(F.array_join(ordered, "")).alias("seq"))
    return landed(whole, "conversations")


def rebuilt(own: DataFrame, block: int = BLOCK, heads: int = HEADS) -> DataFrame:
    """Every conversation with the first turns of its block's first conversation in place of its own."""
    n = f"(crc32(CAST(CAST(conv_id AS STRING) AS BINARY)) % {heads})"
    first = own.where(f"conv_id % {block} = 0").select(F.col("conv_id").alias("base"), prefix("seq", str(heads)).alias("head"))
    head, tail = f"coalesce(substring(head, 1, CAST({KEY} * {n} AS INT)), X'')", f"substring(seq, CAST({KEY} * {n} + 1 AS INT))"
    joined = own.join(first, F.expr(f"conv_id - conv_id % {block} = base"), "left")
    return landed(joined.select("conv_id", F.expr(f"concat({head}, {tail})").alias("seq")), "rebuilt")


def with_cuts(classes: DataFrame, prefix_turns: int) -> DataFrame:
    """Per sequence the length of the prefix that deals it out: the first power of two whose prefix is no hot one.

    Sequences that share the prefix agree on it. A prefix of one sequence is never hot, and hashes that collide only make a
    prefix longer.
    """
    depth = f"(length(seq) DIV {KEY})"
    hashed = "xxhash64(p, substring(seq, 1, CAST({} * p AS INT)))".format(KEY)
    lengths = f"filter(transform(sequence(0, 30), k -> shiftleft(1L, k)), p -> p = 1 OR p < 2 * {depth})"
    counted = (
        classes.selectExpr("seq", f"{depth} AS turns", f"explode({lengths}) AS p")
        .selectExpr("p", f"{hashed} AS mark", "turns")
        .groupBy("p", "mark")
        .agg(F.expr("count(*) AS n"), F.expr("sum(turns) AS turns"))
    )
    hot = landed(counted.where(f"n > 1 AND turns > {prefix_turns}").select("p", "mark"), "hot-prefixes")
    found = classes.withColumn("cut", F.lit(1).cast("long"))
    for row in hot.select("p").distinct().orderBy("p").collect():  # powers of two: thirty at most
        p = row["p"]
        marks = hot.where(F.col("p") == p).select(F.col("mark").alias("hot_mark"))
        own = F.expr(hashed.replace("* p", f"* {p}").replace("(p,", f"({p}L,"))
        found = (
            found.join(marks, (F.col("cut") == p) & (own == F.col("hot_mark")), "left")
            .withColumn("cut", F.when(F.col("hot_mark").isNotNull(), F.lit(2 * p)).otherwise(F.col("cut")))
            .drop("hot_mark")
        )
    return found


def chunks_of_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``class, id`` in order become rows ``class, first id, ids joined by commas``."""
    for batch in batches:
        classes, ids = (batch.column(k).to_numpy() for k in range(2))
        firsts = np.flatnonzero(np.diff(classes, prepend=classes[:1] - 1))
        ends = np.append(firsts[1:], len(classes))
        rows = [(int(classes[a]), int(ids[a]), ",".join(map(str, ids[a:b].tolist()))) for a, b in zip(firsts, ends)]
        yield row_batch(rows, "class long, first long, ids string")


def digests_of_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``class, first id, ids`` in order become one row per class: the digest of all ids."""
    own, digest = None, None
    for batch in batches:
        done = []
        for one, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if one == own:
                digest.update(b"," + ids.encode())
                continue
            if own is not None:
                done.append((own, digest.hexdigest()))
            own, digest = one, hashlib.sha256(ids.encode())
        if done:
            yield row_batch(done, "class long, sha string")
    if own is not None:
        yield row_batch([(own, digest.hexdigest())], "class long, sha string")


def end_digests(conversations: DataFrame, classes: DataFrame) -> DataFrame:
    """Per class of several conversations the digest of their ids, ascending and joined by commas.

    Ranges cut a large class; each becomes a few long texts, which one task streams through the hash.
    """
    width = shuffle_width(conversations.sparkSession)
    several = classes.where("n > 1").select("seq", "class")
    pairs = conversations.join(several, "seq").select("class", "conv_id")
    ranges = pairs.repartitionByRange(width, "class", "conv_id").sortWithinPartitions("class", "conv_id")
    chunks = ranges.mapInArrow(chunks_of_ids, "class long, first long, ids string")
    return chunks.repartition(width, "class").sortWithinPartitions("class", "first").mapInArrow(digests_of_ids, "class long, sha string")


def merged_upper(parts: DataFrame) -> DataFrame:
    """The nodes above the shards' prefixes, one landed row per path, with subtree sums over all shards."""
    above = F.expr(f"substring(path, 1, CAST({KEY} * (depth - 1) AS INT))")
    whole = landed(
        parts.where("upper")
        .groupBy("path")
        .agg(
            F.first("depth").alias("depth"),
            F.min("conv_id").alias("conv_id"),
            F.sum("n_convs").alias("n_convs"),
            F.sum("n_leaves").alias("n_leaves"),
            F.sum("saved_tokens").alias("saved_tokens"),
            F.first("chars").alias("chars"),
            F.max("ends").alias("ends"),
        ),
        "upper-nodes",
    )
    tops = parts.where("NOT upper AND path IS NOT NULL").select("path")
    children = tops.unionAll(whole.where("depth > 0").select(above.alias("path"))).groupBy("path").agg(F.expr("count(*) AS n_children"))
    counted = landed(
        whole.join(children, "path", "left").selectExpr(
            "path", "depth", "conv_id", "n_convs", "coalesce(n_children, 0L) AS n_children", "n_leaves", "saved_tokens", "ends",
            "CAST(n_children IS NULL AS LONG) AS own_leaf", "(n_convs - 1) * chars AS own_saved",
        ),
        "upper-children",
    )
    own = counted.selectExpr("path AS node", "own_leaf", "own_saved", "explode(sequence(0L, depth)) AS k")
    sums = own.select(prefix("node", "k").alias("path"), "own_leaf", "own_saved").groupBy("path").agg(
        F.sum("own_leaf").alias("own_leaf"), F.sum("own_saved").alias("own_saved")
    )
    parents = counted.selectExpr("path AS above", "conv_id AS parent_conv_id")
    return landed(
        counted.drop("own_leaf", "own_saved")
        .join(sums, "path")
        .withColumn("above", F.when(F.col("depth") > 0, above))
        .join(parents, "above", "left")
        .selectExpr(
            "path", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children",
            "n_leaves + own_leaf AS n_leaves", "saved_tokens + own_saved AS saved_tokens", "ends",
        ),
        "upper",
    )


def prefix_nodes(
    conversations: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    rebuild: bool = True,
    prefix_turns: int = PREFIX_TURNS,
    shard_turns: int = SHARD_TURNS,
) -> DataFrame:
    """One row per node of the trie over all conversations, rebuilt by their blocks or as they are."""
    spark = conversations.sparkSession
    on_workers(spark)
    own = sequences_of(conversations, id_column, turn_column, role_column, text_column)
    own = rebuilt(own) if rebuild else own
    classes = landed(own.groupBy("seq").agg(F.min("conv_id").alias("class"), F.expr("count(*) AS n")), "sequences")
    turns = classes.agg(F.expr(f"sum(length(seq)) DIV {KEY} AS turns")).first()["turns"] or 0
    shards = max(shuffle_width(spark), -(-turns // shard_turns))
    dealt = with_cuts(classes, prefix_turns).select("class", "n", "cut", "seq", prefix("seq", "cut").alias("path"))
    dealt = dealt.repartition(shards, "path").drop("path")
    parts = landed(dealt.mapInArrow(trie_parts, NODES), "trie-parts")
    upper = merged_upper(parts)
    names = "depth conv_id parent_conv_id n_convs n_children n_leaves saved_tokens ends".split()
    inner = parts.where("NOT upper AND path IS NULL").select(*names)
    parents = upper.selectExpr("path", "conv_id AS top_parent")
    tops = parts.where("NOT upper AND path IS NOT NULL").drop("parent_conv_id").join(parents, "path")
    tops = tops.withColumnRenamed("top_parent", "parent_conv_id").select(*names)
    nodes = inner.unionByName(tops).unionByName(upper.select(*names))
    return (
        nodes.join(end_digests(own, classes).withColumnRenamed("class", "ends"), "ends", "left")
        .withColumn("ends_sha256", F.coalesce("sha", F.sha2(F.coalesce(F.col("ends").cast("string"), F.lit("")), 256)))
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    )
