"""Self join of documents on the Jaccard similarity of their word shingles, by T-occurrence search.

Two sets of sizes n <= m with Jaccard similarity of p percent share at least ``p * m / 100`` shingles, so of any
order of all shingles the first ``n - T + 1`` of each meet. The order puts shingles with a rare word first: a table of
word counts, of fixed size and over all documents, ranks them. These rare ends are the only lists that are built and
sorted across the cluster; neighbours in a list are candidates if their sizes allow it, and candidates fall into groups.

Sharing one rare shingle chains documents that have little in common, the more the larger the table. So a group is first
cut by the parities of its sets, one or two bits a shingle: parities differ in no more places than the sets do, so a pair
whose parities differ too much has no link. What still hangs together is a group that is searched with its shingles, by
DivideSkip: the lists of a document are divided into short ones, which are merged and
counted, and long ones, which are only probed by binary search for the candidates that can still reach T. Where links
are not counted, documents known to be linked through others are not compared again. Groups too large for a task are
dealt as pairs of blocks; before the parities are compared, large ones fall into cells of neighbouring sizes.

Equal sets are one class from the start, so exact copies cost one row each, and within a task one list entry.

Defined cases: a document without words has an empty set and is linked with nothing; one with fewer words than a
shingle has all its words as its only shingle. A null identifier is linked with nothing and its component is null;
rows that share an identifier are one node, and each of them is a link of the others in ``n_links``. An empty table gives an empty result. Only the identifier and the
text are read, whatever else there is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadtrail.llm.components import components
from loadtrail.llm.staging import arrow_schema, joined_by_size, landed, on_workers, row_batch, signed, small_batches

#: Cells of the table of word counts as a power of two: a million cells, one byte each when broadcast.
CELL_BITS = 20
#: Cells in a row of the count table while it is added up.
BLOCK = 1 << 14
#: Shingles of all documents in a group that one task searches at once.
GROUP_SHINGLES = 2_000_000
#: Documents, and shingles behind their parities, that one task compares at once.
CELL_DOCS = 16_384
CELL_SHINGLES = 32_000_000
#: Share of the lists set aside as long ones: T / (LONG_FACTOR * log2(longest list) + 1).
LONG_FACTOR = 0.0085

SETS = "doc_id long, n_shingles long, high long, low long, parities binary, block int, counts binary"
BLOCKS = "block int, counts binary"
LISTS = "shingle long, n int, node long"
EDGES = "a long, b long"
MEMBERS = "group_key long, first_block int, last_block int, doc_id long, own_block int, n_rows long, node long, shingles binary"
#: A link of the spanning forest (documents a, b), or how many rows a class's partners in a task stand for (class a, links).
LINKS = "a long, b long, links long"
#: Documents that a worker looks at together.
TOGETHER = 256


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_codes(text: bytes) -> np.ndarray:
    """Hashes of the words; bytes.lower() changes A-Z only, bytes.split() cuts at the six ASCII white spaces."""
    found = text.lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def runs(codes: np.ndarray, words: int) -> np.ndarray:
    """Hashes of the runs of ``words`` words, or of all words where there are fewer."""
    width = min(words, len(codes))
    out = np.full(len(codes) - width + 1 if width else 0, width, np.uint64)
    for k in range(width):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + codes[k : len(codes) - width + 1 + k])
    return out


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Sorted hashes of the different runs."""
    return np.unique(runs(word_codes(text), words))


def cells_of(codes: np.ndarray) -> np.ndarray:
    return (codes >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set as two signed numbers."""
    code = xxhash.xxh3_128_intdigest(shingles.tobytes())
    return signed(code >> 64), signed(code & ((1 << 64) - 1))


def parity_bits(shingles: np.ndarray) -> bytes:
    """For each cell the parity of the set's shingles there; the cells are a power of two, 64 or no fewer than shingles."""
    cells = 1 << max(6, (len(shingles) - 1).bit_length())
    counts = np.bincount((shingles & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def folded(parities: bytes, length: int) -> np.ndarray:
    """The parities over as many cells as ``length`` bytes have bits."""
    return np.bitwise_xor.reduce(np.frombuffer(parities, np.uint64).reshape(-1, length // 8))


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, TOGETHER):
            yield batch.slice(low, TOGETHER)


def least_overlap(n: int, percent: int) -> int:
    """Shingles that a set of size n shares at least with any set no smaller that is similar enough."""
    return (percent * n + 99) // 100


def describe(words: int):
    """Size and key of every document's set; at the end the task's counts of words per cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELL_BITS, np.uint32)
        seen: set[tuple[int, int]] = set()
        for batch in slices(batches):
            rows, counted = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                codes = word_codes(text)
                shingles = np.unique(runs(codes, words))
                key = set_key(shingles) if len(shingles) else (None, None)
                parities = parity_bits(shingles) if len(shingles) else None
                rows.append((doc_id, len(shingles), *key, parities, None, None))
                if key not in seen:
                    seen.add(key)
                    counted.append(cells_of(codes))
            if counted:
                cells += np.bincount(np.concatenate(counted), minlength=len(cells)).astype(np.uint32)
            if len(seen) > 1_000_000:
                seen.clear()
            yield row_batch(rows, SETS)
        blocks = cells.reshape(-1, BLOCK)
        for low in range(0, len(blocks), 32):
            yield row_batch([(None, None, None, None, None, k, blocks[k].tobytes()) for k in range(low, low + 32)], SETS)

    return run


def add_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up the rows of each block; what is held is the table's size at most."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts = np.frombuffer(counts, np.uint32).astype(np.uint64)
            sums[block] = sums[block] + counts if block in sums else counts
    for block, counts in sums.items():
        yield row_batch([(block, counts.tobytes())], BLOCKS)


def frequency_levels(described: DataFrame) -> np.ndarray:
    """One byte per cell: its count on a logarithmic scale. The table's size is fixed by CELL_BITS."""
    sums = described.where("block IS NOT NULL").select("block", "counts").repartition("block")
    cells = np.zeros(1 << CELL_BITS, np.float64)
    for row in sums.mapInArrow(add_blocks, BLOCKS).toLocalIterator():
        cells[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = np.frombuffer(row["counts"], np.uint64)
    return np.minimum(np.round(4 * np.log2(cells + 1)), 255).astype(np.uint8)


def rare_ends(words: int, percent: int, levels):
    """The list entries of every document: its rarest shingles, as many as prove a link.

    A shingle is as rare as its rarest word; the hash decides between equals, so the order is the same everywhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        seen: set[tuple[int, int]] = set()
        for batch in slices(batches):
            shingle_parts, sizes, nodes = [], [], []
            for text in batch.column(0).to_pylist():
                codes = word_codes(text)
                shingles, first = np.unique(runs(codes, words), return_index=True)
                if not len(shingles):
                    continue
                key = set_key(shingles)
                if key in seen:
                    continue
                seen.add(key)
                of_words = level[cells_of(codes)]
                rarest = np.minimum.reduce([of_words[first + k] for k in range(min(words, len(codes)))])
                end = len(shingles) - least_overlap(len(shingles), percent) + 1
                order = np.argsort(rarest, kind="stable")[:end]
                shingle_parts.append(shingles[order])
                sizes.append(len(shingles))
                nodes.append(key[1])
            if len(seen) > 1_000_000:
                seen.clear()
            if nodes:
                each = [len(x) for x in shingle_parts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(shingle_parts).view(np.int64)),
                        pa.array(np.repeat(np.asarray(sizes, np.int32), each)),
                        pa.array(np.repeat(np.asarray(nodes, np.int64), each)),
                    ],
                    names=["shingle", "n", "node"],
                )

    return run


def may_link(
    sizes: np.ndarray, parities: list[bytes], percent: int, opens: np.ndarray, blocks: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """A forest over the pairs of sets whose parities allow a similarity of ``percent``; the sets come by size.

    Sets of sizes summing to s with that similarity differ in (100 - percent) / (100 + percent) * s shingles at most.
    Pairs begin with a set that ``opens`` and, where ``blocks`` are given, lie in different ones.
    """
    labels = np.arange(len(sizes))
    lengths = np.array([len(x) for x in parities])
    until = np.searchsorted(sizes, 100 * sizes // percent, "right")
    found = []
    for length in np.unique(lengths):
        low, high = np.searchsorted(lengths, (length, length + 1))
        table = np.stack([folded(x, int(length)) for x in parities[low : until[high - 1]]])
        for q in range(low, high):
            if not opens[q]:
                continue
            later = np.arange(q + 1, until[q])
            apart = labels[later] != labels[q]
            if blocks is not None:
                apart &= blocks[later] != blocks[q]
            later = later[apart]
            differ = np.bitwise_count(table[later - low] ^ table[q - low]).sum(1, dtype=np.int64)
            near = later[differ * (100 + percent) <= (sizes[later] + sizes[q]) * (100 - percent)]
            if len(near):
                joined, first = np.unique(labels[near], return_index=True)
                found += [(q, int(p)) for p in near[first]]
                labels[np.isin(labels, joined)] = labels[q]
    return found


def near_parities(percent: int):
    """Search each cell, or pair of its blocks, for pairs of sets that may be linked."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("n", "ascending"), ("node", "ascending")])
        sizes, nodes, blocks, opens = (rows.column(c).to_numpy() for c in ("n", "node", "own_block", "opens"))
        apart = blocks if key[2].as_py() != key[3].as_py() else None
        pairs = may_link(sizes, rows.column("parities").to_pylist(), percent, opens, apart)
        pairs = nodes[np.array(pairs, np.int64).reshape(-1, 2)]
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]}, schema=arrow_schema(EDGES))

    return run


def cut_groups(chained: DataFrame, percent: int) -> DataFrame:
    """``node``, ``root`` of the groups that are left of ``chained`` when pairs need parities that allow a link.

    Sets of a similarity of ``percent`` lie in one class of sizes or in two that follow each other, so in a large group
    a cell holds a class, which opens the pairs, and the next one.
    """
    totals = [F.count(F.lit(1)).alias("docs"), F.sum("n").alias("shingles")]
    blocks = F.ceil(F.greatest(F.col("docs") / CELL_DOCS, F.col("shingles") / CELL_SHINGLES)).alias("blocks")
    # what is broadcast has a row for every so many documents or shingles of a bound
    large = chained.groupBy("root").agg(*totals).select("root", blocks).where("blocks > 1")
    ratio = max(1.01, 100 / percent * (1 + 1e-9))
    sized = chained.join(F.broadcast(large.select("root", F.lit(True).alias("large"))), "root", "left").withColumn(
        "size_class", F.when(F.col("large"), F.floor(F.log("n") / F.log(F.lit(ratio)))).otherwise(0)
    )
    cells = F.when(F.col("large"), F.array(F.col("size_class") - 1, F.col("size_class"))).otherwise(F.array("size_class"))
    sized = sized.withColumn("cell", F.explode(cells))
    large_cells = sized.groupBy("root", "cell").agg(*totals).select("root", "cell", blocks).where("blocks > 1")
    dealt = sized.join(F.broadcast(large_cells), ["root", "cell"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.expr("cast(pmod(xxhash64(low), blocks) as int)")
    other = F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")))
    dealt = dealt.select("*", own.alias("own_block")).select("*", other.alias("other_block"))
    dealt = dealt.select(
        "root",
        "cell",
        F.least("own_block", "other_block").alias("first_block"),
        F.greatest("own_block", "other_block").alias("last_block"),
        "own_block",
        (F.col("size_class") == F.col("cell")).alias("opens"),
        "n",
        F.col("low").alias("node"),
        "parities",
    )
    found = dealt.groupBy("root", "cell", "first_block", "last_block").applyInArrow(near_parities(percent), EDGES)
    return with_roots(components(found))


def with_roots(groups: DataFrame) -> DataFrame:
    return groups.unionAll(groups.select("root", "root").distinct())


def group_members(words: int):
    """The shingles of each candidate, if the text is the one that was described."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for *dealt, high, low, text in zip(*(c.to_pylist() for c in batch.columns)):
                shingles = shingle_set(text, words)
                if set_key(shingles) == (high, low):
                    rows.append((*dealt, low, shingles.tobytes()))
            yield row_batch(rows, MEMBERS)

    return run


class Roots:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def of(self, k: int) -> int:
        while self.up[k] != k:
            self.up[k] = self.up[self.up[k]]
            k = self.up[k]
        return k

    def join(self, a: int, b: int) -> None:
        a, b = self.of(a), self.of(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def divide_skip(
    sets: list[np.ndarray], percent: int, blocks: np.ndarray | None = None, weights: np.ndarray | None = None
) -> tuple[Roots, np.ndarray]:
    """Components of the sets whose similarity reaches ``percent``, and the weight of every set's partners; the sets
    come by size.

    For a set, partners are later in the list and, where ``blocks`` are given, in the other block. Its inverted lists
    are cut into the longest, as many as the rule of the method allows, and the rest. The rest are merged and counted;
    a partner needs T less the number of long lists there. The long lists are then probed one by one, and a partner is
    dropped when those left cannot make up for what it lacks. Exact sizes decide at the end. Without ``weights`` no
    partners are counted, and those in the set's own component already are not compared again.
    """
    roots = Roots(len(sets))
    partner_weight = np.zeros(len(sets), np.int64)
    sizes = np.array([len(x) for x in sets])
    shingles = np.concatenate(sets)
    order = np.argsort(shingles, kind="stable")
    shingles = shingles[order]
    owners = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)[order]
    del order
    borders = np.flatnonzero(np.concatenate(([True], shingles[1:] != shingles[:-1], [True])))
    lists_of = shingles[borders[:-1]]
    lengths = np.diff(borders)
    longest = int(lengths.max())
    for q, own in enumerate(sets):
        largest = 100 * len(own) // percent
        until = int(np.searchsorted(sizes, largest, "right"))
        if until <= q + 1:
            continue
        need = least_overlap(len(own), percent)
        at = np.searchsorted(lists_of, own)
        at = at[lengths[at] > 1]
        if len(at) < need:
            continue
        at = at[np.argsort(lengths[at], kind="stable")]
        n_long = min(need - 1, int(need / (LONG_FACTOR * np.log2(longest) + 1)), len(at) - 1)
        short, long_ones = at[: len(at) - n_long], at[len(at) - n_long :]
        merged = np.concatenate([owners[borders[k] : borders[k + 1]] for k in short])
        merged = merged[(merged > q) & (merged < until)]
        if blocks is not None:
            merged = merged[blocks[merged] != blocks[q]]
        partners, counts = np.unique(merged, return_counts=True)
        partners, counts = partners[counts >= need - n_long], counts[counts >= need - n_long]
        if weights is None:
            mine = roots.of(q)
            apart = np.fromiter((roots.of(int(p)) != mine for p in partners), bool, len(partners))
            partners, counts = partners[apart], counts[apart]
        for k, one in enumerate(long_ones):
            if not len(partners):
                break
            entries = owners[borders[one] : borders[one + 1]]
            place = np.minimum(np.searchsorted(entries, partners), len(entries) - 1)
            counts = counts + (entries[place] == partners)
            alive = counts + (n_long - k - 1) >= need
            partners, counts = partners[alive], counts[alive]
        partners = partners[100 * counts >= percent * (len(own) + sizes[partners] - counts)]
        for p in partners.tolist():
            roots.join(q, p)
        if weights is not None:
            partner_weight[q] += weights[partners].sum()
            partner_weight[partners] += weights[q]
    return roots, partner_weight


def search(percent: int, count_links: bool):
    """Search each group as its rows come by; a group is bounded by the deal of its blocks.

    A pair of different blocks compares documents across them only, so every pair of documents meets in one task.
    """

    def links(members: dict[tuple[int, int], tuple[int, int, bytes]]) -> Iterator[tuple[int, int | None, int | None]]:
        keys = sorted(members, key=lambda k: (len(members[k][2]), k))
        own, rows, sets = zip(*map(members.__getitem__, keys))
        weights = np.array(rows, np.int64) if count_links else None
        blocks = np.array(own) if min(own) < max(own) else None
        roots, found = divide_skip([np.frombuffer(x, np.uint64) for x in sets], percent, blocks, weights)
        for k, (doc_id, node) in enumerate(keys):
            if roots.of(k) != k:
                yield doc_id, keys[roots.of(k)][0], None
            if found[k]:
                yield node, None, int(found[k])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, members, rows = None, {}, []
        for batch in batches:
            for *key, doc_id, block, n_rows, node, shingles in zip(*(c.to_pylist() for c in batch.columns)):
                if key != current:
                    if two_sides(current, members):
                        rows.extend(links(members))
                    current, members = key, {}
                members[doc_id, node] = block, n_rows, shingles
            if rows:
                yield row_batch(rows, LINKS)
                rows = []
        if two_sides(current, members):
            yield row_batch(list(links(members)), LINKS)

    return run


def two_sides(key: list[int] | None, members: dict[tuple[int, int], tuple[int, int, bytes]]) -> bool:
    """Whether there is anything to compare: two sets, of both blocks where the pair has two."""
    return len(members) > 1 and (key[1] == key[2] or len({m[0] for m in members.values()}) > 1)


def similar_components(
    docs: DataFrame,
    words: int = 3,
    percent: int = 90,
    id_column: str = "doc_id",
    text_column: str = "text",
    count_links: bool = False,
) -> DataFrame:
    """Per row: identifier, size of the shingle set and the smallest identifier that links reach.

    With ``count_links`` also ``n_links``, the number of other rows that the row is linked with: those of its class,
    which have the same set, and those of every linked class.
    """
    spark = docs.sparkSession
    on_workers(spark)
    rows = docs.select(
        docs[id_column].cast("long").alias("doc_id"), F.coalesce(docs[text_column], F.lit("")).cast("binary").alias("text")
    )
    described = landed(rows.mapInArrow(describe(words), SETS), "shingle-sets")
    sets = described.where("block IS NULL").drop("block", "counts")
    classes = landed(
        sets.where("high IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("high", "low")
        .agg(
            F.min("doc_id").alias("first_id"),
            F.first("n_shingles").alias("n"),
            F.count(F.lit(1)).alias("n_rows"),
            F.first("parities").alias("parities"),
        ),
        "set-classes",
    )

    levels = spark.sparkContext.broadcast(frequency_levels(described))
    lists = rows.where("doc_id IS NOT NULL").select("text").mapInArrow(rare_ends(words, percent, levels), LISTS)
    in_list = Window.partitionBy("shingle").orderBy("n", "node")
    before = lists.select("node", "n", F.lag("node").over(in_list).alias("before"), F.lag("n").over(in_list).alias("n_before"))
    near = (F.col("before") != F.col("node")) & (F.col("n_before") * 100 >= F.col("n") * percent)
    neighbours = before.where(near).select(F.col("before").alias("a"), F.col("node").alias("b"))
    groups = with_roots(components(neighbours))
    chained = landed(classes.join(groups, classes["low"] == groups["node"]).drop("node"), "chained")

    groups = cut_groups(chained, percent)
    members = chained.drop("root", "parities").join(groups, chained["low"] == groups["node"]).drop("node")
    members = landed(members, "candidates")
    weights = members.groupBy("root").agg(F.ceil(F.sum("n") / GROUP_SHINGLES).alias("blocks"))
    own = F.expr("pmod(xxhash64(first_id), blocks)")
    dealt = members.join(weights, "root").select(
        F.col("root").alias("group_key"),
        own.alias("own_block"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other_block"),
        F.col("first_id").alias("doc_id"),
        "n_rows",
        "high",
        "low",
    )
    dealt = dealt.select(
        "group_key",
        F.least("own_block", "other_block").cast("int").alias("first_block"),
        F.greatest("own_block", "other_block").cast("int").alias("last_block"),
        "doc_id",
        F.col("own_block").cast("int").alias("own_block"),
        "n_rows",
        "high",
        "low",
    )
    dealt = landed(dealt, "dealt-candidates")
    dealt = joined_by_size(dealt, dealt.count())
    texts = rows.join(dealt, "doc_id").select(
        "group_key", "first_block", "last_block", "doc_id", "own_block", "n_rows", "high", "low", "text"
    )
    grouping = ["group_key", "first_block", "last_block"]
    found = (
        texts.mapInArrow(group_members(words), MEMBERS)
        .repartition(*grouping)
        .sortWithinPartitions(*grouping)
        .mapInArrow(search(percent, count_links), LINKS)
    )
    with small_batches(spark):  # the search runs here
        found = landed(found, "links")
    reached = components(found.where("b IS NOT NULL").select("a", "b"))

    final = classes.join(reached, classes["first_id"] == reached["node"], "left").select(
        "high", "low", "first_id", "n_rows", F.coalesce("root", "first_id").alias("class_root")
    )
    if count_links:
        partners = found.where("links IS NOT NULL").groupBy("a").agg(F.sum("links").alias("links"))
        final = final.join(partners, final["low"] == partners["a"], "left")
        final = final.withColumn("class_links", F.col("n_rows") - 1 + F.coalesce("links", F.lit(0)))
    else:
        final = final.withColumn("class_links", F.lit(None).cast("long"))
    final = landed(final.select("high", "low", "class_root", "class_links"), "class-roots")
    alone = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_root", "doc_id"))
    # documents without words have no class and stay out of the join, where they would be one large key
    columns = ["doc_id", "n_shingles", "class_root", "class_links"]
    worded = sets.where("high IS NOT NULL").join(final, ["high", "low"], "left").select(columns)
    nothing = F.lit(None).cast("long")
    empty = sets.where("high IS NULL").select("doc_id", "n_shingles", nothing.alias("class_root"), nothing.alias("class_links"))
    linked = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_links", F.lit(0))).otherwise(F.lit(0))
    counted = [linked.alias("n_links")] if count_links else []
    return worded.unionAll(empty).select(F.col("doc_id").alias(id_column), "n_shingles", alone.alias("component_id"), *counted)


def drop_similar(
    docs: DataFrame, words: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of one document, the smallest identifier, of each component; rows without identifier stay."""
    found = similar_components(docs, words, percent, id_column, text_column)
    dropped = found.where(F.col(id_column) != F.col("component_id")).select(F.col(id_column).alias("dropped_id")).distinct()
    dropped = landed(dropped, "dropped-ids")
    dropped = joined_by_size(dropped, dropped.count())
    return docs.join(dropped, docs[id_column].cast("long") == dropped["dropped_id"], "left_anti")
