"""Benchmark passages in training documents, found by winnowing.

Words are hashed, every run of ``GRAM`` words gets a hash from theirs, and of the ``span - GRAM + 1`` runs that a
window of ``span`` words holds the smallest hash is kept, the rightmost of equals. Equal windows keep the same run, so
every passage of ``span`` words that a document shares with an item has a fingerprint in both. Fingerprints of the
items set bits of two fixed-size filters, one over kept runs and one over whole windows. A document's fingerprint that
passes is extended to the windows that kept it; those that pass the second filter are digested as text and joined with
the windows of the items by fingerprint and digest. An item of fewer words than ``span`` is one window; its length
gets fingerprints of its own, one at every word. Nothing is sampled, and no window is left out.

Documents move nowhere: one pass over them writes a narrow table without text, and only windows that passed the filters
are joined. The join is an equality with one row per different window, so a passage in a third of all documents or
items makes no pairs. Items are gathered per different set of windows, not per document.

Defined cases: a null text has no words, nor does one without letters and digits; such rows come out with zeros. Every
row of the documents gives one row, rows without or with a repeated identifier too. Items without words occur nowhere,
items with equal identifiers are one item, and an item without identifier is listed as ``null``. Without items nothing
is hit. Empty documents give an empty result. Texts are read in pieces of some ``PIECE_BYTES``, so their length does not
matter; a single word is never cut. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadtrail.llm.staging import landed, on_workers

SPAN = 10
GRAM = 5
#: Bits of each filter: half a megabyte, whatever the number of items.
FILTER_BITS = 1 << 22
BITMAP_BITS = 32_768
PIECE_BYTES = 1 << 20
HITS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int32()), ("print", pa.int64()), ("key", pa.binary())]))
SCANNED = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("n_words", pa.int64()), ("hits", HITS)])
SCANNED_DDL = "row long, id long, n_words long, hits array<struct<start: long, length: int, print: long, key: binary>>"

_BYTES = np.arange(256, dtype=np.uint8)
LOWERED = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: Digits, a to z, and every byte of a character beyond ASCII.
IN_WORD = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
POWERS = np.multiply.accumulate(np.full(1 << 16, 0x9E3779B97F4A7C15, np.uint64))
STEP = 0xD6E8FEB86659FD93


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the number."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(STEP)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(STEP)
    return x ^ (x >> np.uint64(32))


def cells(x: np.ndarray) -> np.ndarray:
    """The filter's bit of a hash."""
    return (x >> np.uint64(42)).astype(np.int64)


class Words:
    """Lower-cased bytes of one or more texts and the words in them, with their hashes.

    Texts are laid side by side with a space between; ``owner`` tells whose each word is.
    """

    def __init__(self, *texts: bytes):
        self.bytes = LOWERED[np.frombuffer(b" ".join(texts), np.uint8)]
        inside = IN_WORD[self.bytes]
        edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
        self.starts, self.ends = edges[::2], edges[1::2]
        lengths = self.ends - self.starts
        first = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        if len(lengths) and lengths.max() > len(POWERS):
            place &= len(POWERS) - 1
        values = (self.bytes[inside].astype(np.uint64) + np.uint64(1)) * POWERS[place]
        self.hashes = mixed(np.add.reduceat(values, first)) if len(first) else np.empty(0, np.uint64)
        begins = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        self.owner = np.searchsorted(begins, self.starts, "right") - 1
        self.counts = np.bincount(self.owner, minlength=len(texts))
        self.first_word = np.cumsum(self.counts) - self.counts

    def __len__(self) -> int:
        return len(self.starts)

    def whole(self, starts: np.ndarray, length: int) -> np.ndarray:
        """Of the starts, those from which ``length`` words belong to one text."""
        starts = starts[starts + length <= len(self)]
        return starts[self.owner[starts] == self.owner[starts + length - 1]]

    def grams(self, n: int, starts: np.ndarray | None = None) -> np.ndarray:
        """A hash of every run of ``n`` words, or of those at ``starts``."""
        count = max(len(self) - n + 1, 0) if starts is None else len(starts)
        found = np.zeros(count, np.uint64)
        for k in range(n if count else 0):
            found *= np.uint64(STEP)
            found += self.hashes[k : k + count] if starts is None else self.hashes[starts + k]
        return mixed(found)

    def window(self, start: int, length: int) -> bytes:
        """The window's words, one space between them."""
        pairs = zip(self.starts[start : start + length], self.ends[start : start + length])
        return b" ".join(self.bytes[a:b].tobytes() for a, b in pairs)


def winnowed(grams: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` grams the place of the smallest, the rightmost of equals; low bits do not count."""
    n = max(len(grams) - width + 1, 0)
    low = np.uint64((1 << (width - 1).bit_length()) - 1)
    high = grams & ~low
    best = np.full(n, ~np.uint64(0))
    for k in range(width):
        np.minimum(best, high[k : k + n] | np.uint64(width - 1 - k), out=best)
    return np.arange(n) + (width - 1) - (best & low).astype(np.int64)


def windows(words: Words, length: int, span: int, known: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and fingerprints of the windows of ``length`` words; with ``known`` filters, of those that pass."""
    if length < span or span <= GRAM:
        prints, starts = words.grams(length), np.arange(max(len(words) - length + 1, 0))
        if known:
            starts = starts[known[0][cells(prints)]]
        starts = words.whole(starts, length)
        return starts, prints[starts]
    grams = words.grams(GRAM)
    place = winnowed(grams, span - GRAM + 1)
    starts = np.arange(len(place))
    if known:
        # a kept run is looked up once, then extended to the windows that kept it
        kept = np.flatnonzero(np.diff(place, prepend=-1))
        starts = np.flatnonzero(np.repeat(known[0][cells(grams[place[kept]])], np.diff(kept, append=len(place))))
    starts = words.whole(starts, length)
    if known:
        starts = starts[known[1][cells(words.grams(length, starts))]]
    return starts, grams[place[starts]]


def pieces(text: bytes, span: int, size: int) -> Iterator[tuple[Words, int, int]]:
    """The text in pieces that overlap by ``span - 1`` words: words, the number of words before, how many overlap."""
    begin, before, overlap = 0, 0, 0
    while True:
        end = begin + size
        if end >= len(text):
            yield Words(text[begin:]), before, overlap
            return
        words = Words(text[begin:end])
        # the last word may go on, and whatever follows needs the words before it again
        while len(words) <= span + overlap:
            end = min(end + size, len(text))
            words = Words(text[begin:end])
            if end == len(text):
                yield words, before, overlap
                return
        cut = len(words) - 1
        short = Words(text[begin : begin + int(words.starts[cut])])
        yield short, before, overlap
        back = min(span - 1, cut)
        begin += int(words.starts[cut - back])
        before += cut - back
        overlap = back


def digests(words: Words, starts: np.ndarray, length: int) -> list[bytes]:
    return [hashlib.blake2b(words.window(int(s), length), digest_size=16).digest() for s in starts]


def item_windows(texts: Sequence[bytes], span: int) -> list[tuple[int, list[tuple]]]:
    """Per item its word count and all its windows, with the cells of their hashes."""
    found = []
    for text in texts:
        words = Words(text)
        length = min(len(words), span)
        starts, prints = windows(words, length, span, None) if length else (np.empty(0, int), np.empty(0, np.uint64))
        cell = cells(words.grams(length, starts))
        columns = (starts, np.full(len(starts), length), prints.view(np.int64), digests(words, starts, length), cells(prints), cell)
        found.append((len(words), list(zip(*(c if isinstance(c, list) else c.tolist() for c in columns)))))
    return found


def document_windows(
    texts: Sequence[bytes], lengths: Sequence[int], span: int, known: tuple[np.ndarray, np.ndarray], size: int
) -> list[tuple[int, list[tuple]]]:
    """Per document its word count and the windows that pass the filters; one longer than ``size`` comes alone."""
    counts, found = [0] * len(texts), [[] for _ in texts]
    parts = pieces(texts[0], span, size) if len(texts) == 1 else [(Words(*texts), 0, 0)]
    for words, before, overlap in parts:
        counts = [before + int(n) for n in words.counts]
        for length in lengths:
            starts, prints = windows(words, length, span, known)
            new = starts + length > overlap  # those inside the overlap were seen in the piece before
            starts, prints = starts[new], prints[new]
            owner = words.owner[starts]
            inside = starts - words.first_word[owner] + before
            keys = digests(words, starts, length)
            for k, *hit in zip(owner.tolist(), inside.tolist(), [length] * len(starts), prints.view(np.int64).tolist(), keys):
                found[k].append(tuple(hit))
    return list(zip(counts, found))


def texts_of(batch: pa.RecordBatch) -> Iterator[tuple[int | None, bytes]]:
    ids, texts = batch.column(0), batch.column(1)
    for k in range(batch.num_rows):
        yield ids[k].as_py(), (texts[k].as_buffer().to_pybytes() if texts[k].is_valid else b"")


def scanned(
    frame: DataFrame, id_column: str, text_column: str, find, ddl: str, schema: pa.Schema, size: int
) -> DataFrame:
    """One row per row of the frame: a row number of its own, identifier, word count and windows.

    ``find`` gets some texts at a time, ``size`` bytes of them or one longer text.
    """
    on_workers(frame.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, weight = TaskContext.get().partitionId() << 40, [], 0
        for batch in batches:
            for own_id, text in texts_of(batch):
                if held and weight + len(text) > size:
                    yield out(held)
                    held, weight = [], 0
                held.append((number, own_id, text))
                weight += len(text) + 64
                number += 1
        if held:
            yield out(held)

    def out(held: list[tuple]) -> pa.RecordBatch:
        found = find([text for *_, text in held])
        names = schema.field("hits").type.value_type
        columns = list(zip(*[hit for _, hits in found for hit in hits])) or [()] * names.num_fields
        hits = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, names)], fields=list(names))
        ends = np.cumsum([0] + [len(hits) for _, hits in found])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), hits)
        plain = [[row for row, *_ in held], [own_id for _, own_id, _ in held], [n for n, _ in found]]
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in plain), lists], schema=schema)

    return frame.select(F.col(id_column).cast("long"), F.col(text_column)).mapInArrow(work, ddl)


def bits(windows_of_items: DataFrame, cell: str) -> np.ndarray:
    """The filter over a column of cells: at most FILTER_BITS / BITMAP_BITS rows come to the driver."""
    position = F.col(cell) + 1
    found = windows_of_items.groupBy(F.bitmap_bucket_number(position).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(position)).alias("bitmap")
    )
    whole = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in found.collect():
        begin = (row["bucket"] - 1) * BITMAP_BITS // 8
        whole[begin : begin + BITMAP_BITS // 8] = np.frombuffer(row["bitmap"], np.uint8)
    return whole


def passages_of(items: DataFrame, span: int, id_column: str, text_column: str) -> DataFrame:
    """All windows of all items, landed: item, length, fingerprint, digest and the cells of both filters."""
    hit = pa.struct([*HITS.value_type, ("print_cell", pa.int64()), ("window_cell", pa.int64())])
    schema = SCANNED.set(3, pa.field("hits", pa.list_(hit)))
    ddl = SCANNED_DDL.replace("key: binary", "key: binary, print_cell: long, window_cell: long")
    found = scanned(items, id_column, text_column, lambda texts: item_windows(texts, span), ddl, schema, PIECE_BYTES)
    named = F.coalesce(F.col("id").cast("string"), F.lit("null")).alias("item")
    return landed(found.select(named, F.inline("hits")).drop("start").distinct(), "benchmark-windows")


def document_hits(docs: DataFrame, passages: DataFrame, span: int, id_column: str, text_column: str, size: int) -> DataFrame:
    """One landed row per document, with the windows that pass the filters of the passages."""
    lengths = sorted(row["length"] for row in passages.select("length").distinct().collect())  # span of them at most
    held = docs.sparkSession.sparkContext.broadcast([bits(passages, c) for c in ("print_cell", "window_cell")])
    unpacked: list = []

    def find(texts: list[bytes]) -> list[tuple[int, list[tuple]]]:
        if not unpacked:
            unpacked.append(tuple(np.unpackbits(b, bitorder="little").view(bool) for b in held.value))
        return document_windows(texts, lengths, span, unpacked[0], size)

    return landed(scanned(docs, id_column, text_column, find, SCANNED_DDL, SCANNED, size), "document-windows")


def covered(occurring: DataFrame) -> DataFrame:
    """Per row, how many of its words lie in a window: each window counts what reaches beyond those before it."""
    before = Window.partitionBy("row").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max(F.col("start") + F.col("length")).over(before), F.lit(0))
    new = F.greatest(F.lit(0), F.col("start") + F.col("length") - F.greatest("start", reached))
    return occurring.select("row", new.alias("new")).groupBy("row").agg(F.sum("new").alias("n_hit"))


def items_of_sets(occurring: DataFrame, passages: DataFrame) -> DataFrame:
    """Per row, its items: counted and listed once for every different set of windows."""
    sets = occurring.groupBy("row").agg(F.array_sort(F.collect_set("key")).alias("keys"))
    sets = landed(sets.withColumn("set_key", F.sha2(F.concat_ws("", F.transform("keys", F.hex)), 256)), "window-sets")
    each = sets.groupBy("set_key").agg(F.first("keys").alias("keys")).select("set_key", F.explode("keys").alias("key"))
    found = each.join(passages.select("key", "item").distinct(), "key").select("set_key", "item").distinct()
    listed = found.groupBy("set_key").agg(
        F.count(F.lit(1)).alias("n_items"), F.array_sort(F.collect_list("item")).alias("items")
    )
    return sets.select("row", "set_key").join(listed, "set_key").drop("set_key")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    span: int = SPAN,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """Per document row: its words, those inside passages of the benchmark, and the sorted list of items met."""
    passages = passages_of(benchmark, span, item_column, item_text_column)
    rows = document_hits(docs, passages, span, id_column, text_column, piece_bytes)
    hits = rows.where("size(hits) > 0").select("row", F.inline("hits"))
    # one row per different window: a document's window meets at most one of them
    occurring = landed(hits.join(passages.select("print", "key").distinct(), ["print", "key"], "left_semi"), "occurring")
    return (
        rows.select("row", F.col("id").alias(id_column), "n_words")
        .join(covered(occurring), "row", "left")
        .join(items_of_sets(occurring, passages), "row", "left")
        .select(
            id_column,
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def contamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The same with the list of items as a digest, and a verdict."""
    return contamination(docs, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
