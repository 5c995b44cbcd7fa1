"""Exact deduplication with Patricia tries.

Every map task puts its texts into a compressed radix trie and hands on one row per different text, so a text
that fills a third of the table leaves a task once. Length and content hash then choose the partition that owns a
text, and the owner inserts the full byte strings of its partition into one trie, whose terminal nodes hold the
smallest identifier and the number of rows. Two texts are equal only if they end in the same terminal node. A trie
that outgrows its budget gives up its heaviest subtrees until it is half full: a map task sends their rows on, an
owner writes them to the task's scratch file, where later texts that lead there follow. When the partition has been
read, each subtree is worked off as a trie of its own, past the prefix that its texts share, with the first trie gone.

Defined cases: a null text counts as empty; empty texts form one group. A null identifier loses against any
other; a group without identifiers keeps ``null``. Rows that repeat both text and identifier are one document:
they carry the same decision, and the filter keeps one of them. An empty table gives an empty result. Other
columns are left alone, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from array import array
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadtrail.llm.staging import ascii_lower, landed, on_workers, row_batch, signed, small_batches

#: Bytes of edges and nodes that a trie holds before subtrees leave it.
TRIE_BYTES = 96 << 20
#: What a node takes beside its label.
NODE_BYTES = 350

LOCAL = "n_bytes long, content_hash long, content binary, first_order long, first_rows long, n_rows long"
OWNED = "text_sha256 string, n_bytes long, first_order long, first_rows long, n_rows long"


class Node:
    """A compressed edge and what hangs below it.

    ``entry``: smallest order, rows that have it, rows in all. ``places``: where the scratch file holds the texts below.
    """

    __slots__ = ("children", "entry", "label", "places")

    def __init__(self, label: bytes, entry: tuple | None = None):
        self.label = label
        self.children: dict[int, Node] | None = None
        self.entry = entry
        self.places: array | None = None

    def adopt(self, child: Node) -> None:
        if self.children is None:
            self.children = {}
        self.children[child.label[0]] = child


def shared_length(a: bytes, b: bytes) -> int:
    """Length of the common prefix: doubling steps until they differ, then halving."""
    low, step, most = 0, 16, min(len(a), len(b))
    while low < most and a[low : low + step] == b[low : low + step]:
        low, step = min(low + step, most), 2 * step
    high = min(low + step, most)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def merged(a: tuple | None, b: tuple) -> tuple:
    """Entries of the same text: the smallest order wins, nulls last; equal orders add up."""
    if a is None:
        return b
    if a[0] == b[0]:
        return a[0], a[1] + b[1], a[2] + b[2]
    if b[0] is None or (a[0] is not None and a[0] < b[0]):
        return a[0], a[1], a[2] + b[2]
    return b[0], b[1], a[2] + b[2]


class PatriciaTrie:
    """Byte strings with entries. ``held``: bytes of its edges and nodes, which spilling keeps within ``budget``.

    Without a budget nothing is spilled. A spilled text leaves eight bytes in memory, its place in the scratch file.
    """

    def __init__(self, budget: int | None = TRIE_BYTES):
        self.budget = budget
        self.root = Node(b"")
        self.held = 0
        self.scratch = None

    def insert(self, key: bytes, entry: tuple) -> None:
        node, at = self.root, 0
        while True:
            if node.places is not None:
                self.write(node, key[at:], entry)
                return
            if at == len(key):
                node.entry = merged(node.entry, entry)
                return
            child = node.children.get(key[at]) if node.children else None
            if child is None:
                node.adopt(Node(key[at:], entry))
                self.held += len(key) - at + NODE_BYTES
                if self.budget is not None and self.held > self.budget:
                    self.spill()
                return
            if not key.startswith(child.label, at):
                child = self.split(node, child, shared_length(child.label, key[at : at + len(child.label)]))
            node, at = child, at + len(child.label)

    def split(self, node: Node, child: Node, length: int) -> Node:
        """Cut the edge to ``child`` after ``length`` bytes and return the node between."""
        between = Node(child.label[:length])
        child.label = child.label[length:]
        between.adopt(child)
        node.adopt(between)
        self.held += NODE_BYTES
        return between

    def heaviest(self) -> list[tuple[bytes, Node, Node]]:
        """Subtrees that weigh half the trie together: (prefix of the parent, parent, child).

        From the root down while one child has half of the weight, then that node's children from the heaviest on.
        """
        weights = subtree_weights(self.root)
        half = weights[id(self.root)] / 2
        node, prefix = self.root, b""
        while True:
            inner = [c for c in (node.children or {}).values() if c.places is None]
            inner.sort(key=lambda c: weights[id(c)], reverse=True)
            if not inner or not inner[0].children or weights[id(inner[0])] < half:
                break
            node, prefix = inner[0], prefix + inner[0].label
        taken, freed = [], 0
        for child in inner:
            if freed >= half:
                break
            taken.append((prefix, node, child))
            freed += weights[id(child)]
        return taken

    def cut(self) -> Iterator[tuple[bytes, tuple]]:
        """Take the heaviest subtrees out and give their strings."""
        for prefix, parent, child in self.heaviest():
            del parent.children[child.label[0]]
            yield from ((prefix + key, node.entry) for key, node in walk(child) if node.entry is not None)
        self.held = sum(map(node_weight, nodes(self.root)))

    def spill(self) -> None:
        """Move the heaviest subtrees to the scratch file. One byte of edge stays; keys that lead there follow."""
        for _, parent, child in self.heaviest():
            stub = Node(child.label[:1])
            stub.places = array("Q")
            parent.adopt(stub)
            for key, node in walk(child):
                if node.entry is not None:
                    self.write(stub, key[1:], node.entry)
                if node.places is not None:
                    for rest, entry in self.read(node.places):
                        self.write(stub, key[1:] + rest, entry)
        self.held = sum(map(node_weight, nodes(self.root)))

    def write(self, stub: Node, rest: bytes, entry: tuple) -> None:
        if self.scratch is None:
            self.scratch = tempfile.TemporaryFile()
        stub.places.append(self.scratch.seek(0, os.SEEK_END))
        pickle.dump((rest, entry), self.scratch)

    def read(self, places: array) -> Iterator[tuple[bytes, tuple]]:
        for place in places:
            self.scratch.seek(place)
            yield pickle.load(self.scratch)

    def items(self) -> Iterator[tuple[bytes, tuple]]:
        """Every string with its entry, once: the trie is empty afterwards."""
        spilled = []
        for key, node in walk(self.root):
            if node.entry is not None:
                yield key, node.entry
            if node.places is not None:
                spilled.append((key, node.places))
        self.root, self.held = Node(b""), 0
        for prefix, places in spilled:
            shared = None
            for rest, _ in self.read(places):
                shared = rest if shared is None else shared[: shared_length(shared, rest)]
            below = PatriciaTrie(self.budget)
            for rest, entry in self.read(places):
                below.insert(rest[len(shared) :], entry)
            for key, entry in below.items():
                yield prefix + shared + key, entry
        if self.scratch is not None:
            self.scratch.close()
            self.scratch = None


def node_weight(node: Node) -> int:
    return len(node.label) + NODE_BYTES


def nodes(top: Node) -> Iterator[Node]:
    """Every node below and with ``top``, parents first."""
    waiting = [top]
    while waiting:
        node = waiting.pop()
        yield node
        if node.children:
            waiting += node.children.values()


def subtree_weights(top: Node) -> dict[int, int]:
    weights: dict[int, int] = {}
    for node in reversed(list(nodes(top))):
        weights[id(node)] = node_weight(node) + sum(weights[id(c)] for c in (node.children or {}).values())
    return weights


def walk(top: Node) -> Iterator[tuple[bytes, Node]]:
    """Nodes with the string that leads to them, from the label of ``top`` on."""
    waiting = [(top, b"")]
    while waiting:
        node, prefix = waiting.pop()
        prefix += node.label
        yield prefix, node
        if node.children:
            waiting += [(child, prefix) for child in node.children.values()]


def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map side: one row per different text that the task has seen, or several where its subtree was sent on before."""
    trie = PatriciaTrie(budget=None)
    for batch in batches:
        for text, order in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            trie.insert(text, (order, 1, 1))
            if trie.held > TRIE_BYTES:
                yield from local_rows(trie.cut())
    yield from local_rows(trie.items())


def local_rows(entries: Iterator[tuple[bytes, tuple]]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for text, entry in entries:
        rows.append((len(text), signed(xxhash.xxh3_64_intdigest(text)), text, *entry))
        size += len(text)
        if size > 4 << 20 or len(rows) >= 10_000:
            yield row_batch(rows, LOCAL)
            rows, size = [], 0
    if rows:
        yield row_batch(rows, LOCAL)


def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Owners: one trie for the whole partition."""
    trie = PatriciaTrie()
    for batch in batches:
        for text, *entry in zip(*(c.to_pylist() for c in batch.columns)):
            trie.insert(text, tuple(entry))
    rows = []
    for text, entry in trie.items():
        rows.append((hashlib.sha256(text).hexdigest(), len(text), *entry))
        if len(rows) >= 10_000:
            yield row_batch(rows, OWNED)
            rows = []
    if rows:
        yield row_batch(rows, OWNED)


def owned_texts(docs: DataFrame, id_column: str, text_column: str, keep: str, normalise) -> DataFrame:
    """Full texts with their entries, combined by map task, in the partition that length and content hash choose."""
    order = docs[id_column].cast("long")
    order = F.bitwise_not(order) if keep == "largest" else order
    content = normalise(F.coalesce(docs[text_column], F.lit(""))).cast("binary")
    local = docs.select(content, order).mapInArrow(combine, LOCAL)
    return local.repartition("n_bytes", "content_hash").select("content", "first_order", "first_rows", "n_rows")


def text_groups(docs: DataFrame, id_column: str, text_column: str, keep: str, normalise) -> DataFrame:
    """One row per different normalised text: its SHA-256, length, the order that stays, how many rows have it."""
    on_workers(docs.sparkSession)
    with small_batches(docs.sparkSession):
        return landed(owned_texts(docs, id_column, text_column, keep, normalise).mapInArrow(own, OWNED), "text-groups")


def exact_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "smallest", normalise=ascii_lower
) -> DataFrame:
    """Per row: identifier, the identifier that stays (``keep_id``), ``group_size``, ``kept`` and ``text_sha256``."""
    groups = text_groups(docs, id_column, text_column, keep, normalise)
    content = normalise(F.coalesce(docs[text_column], F.lit("")))
    rows = docs.select(
        docs[id_column].alias(id_column),
        F.sha2(content.cast("binary"), 256).alias("text_sha256"),
        F.octet_length(content).cast("long").alias("n_bytes"),
    )
    kept_id = F.bitwise_not("first_order") if keep == "largest" else F.col("first_order")
    return rows.join(groups, ["text_sha256", "n_bytes"]).select(
        id_column,
        kept_id.alias("keep_id"),
        F.col("n_rows").alias("group_size"),
        F.col(id_column).eqNullSafe(kept_id).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "smallest", normalise=ascii_lower
) -> DataFrame:
    """The rows that stay, with all their columns. Of rows equal in text and identifier one stays."""
    groups = text_groups(docs, id_column, text_column, keep, normalise)
    columns = docs.columns
    order = docs[id_column].cast("long")
    order = F.bitwise_not(order) if keep == "largest" else order
    content = normalise(F.coalesce(docs[text_column], F.lit("")))
    keyed = docs.select(F.struct("*").alias("row"), order.alias("own_order"), F.sha2(content.cast("binary"), 256).alias("sha"))
    stays = groups.select(F.col("text_sha256").alias("sha"), F.col("first_order").alias("own_order"), "first_rows")

    def matching(which: DataFrame) -> DataFrame:
        same = (keyed["sha"] == which["sha"]) & keyed["own_order"].eqNullSafe(which["own_order"])
        return keyed.join(which, same, "left_semi")

    rows = matching(stays.where("first_rows = 1"))
    ties = stays.where("first_rows > 1")
    if not ties.isEmpty():
        rows = rows.unionByName(matching(ties).dropDuplicates(["sha", "own_order"]))
    return rows.select([F.col("row").getField(c).alias(c) for c in columns])
