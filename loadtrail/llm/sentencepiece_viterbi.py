"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

A text gets the usual preparation (a space in front, spaces as U+2581) and is cut where a space follows something
else; no piece of the vocabulary crosses such a place, which is checked when it is loaded. Of the segments that a
worker has not met lately, those of equal length advance together (long ones, filled up, with those of nearly their
length): prefix hashes give the hash of every substring, its leading bits say where to look in the sorted hashes of the
pieces, and a maximum over the lengths of the pieces that end at a place stores score and backpointer for all segments
at once. A character without a piece becomes its UTF-8 bytes. Decoding joins the pieces, so it gives back the text, but for U+2581 in it, which comes back as a space.

The public vocabulary file holds merge ranks rather than log probabilities. A piece scores the logarithm of what
its rank's place in a Zipf distribution would be; the segmentation is the one of highest total score.

Defined cases: null and empty texts have no ids. Equal texts have equal ids; ties go to the shorter last piece.
Long texts are encoded whole. An empty table gives an empty result. Only the identifier and the text are read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadtrail.llm.staging import on_workers

SPACE = "▁"
SEGMENT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
BASE = np.uint64(0x100000001B3)
GOLDEN = 0x9E3779B97F4A7C15
ALL_BITS = (1 << 64) - 1
#: Segments that a Python worker remembers before it starts anew, and characters in a batch of the search.
CACHED_SEGMENTS = 300_000
BATCH_CHARS = 1 << 15
#: Leading bits of a hash that give the first key to compare with: a table of four megabytes.
TOP_BITS = 20
#: Up to this length segments of equal length advance together, beyond it those within a sixteenth.
EXACT_LENGTH = 32
#: What a character without a piece scores below the least piece.
UNKNOWN_PENALTY = 10.0


class Vocabulary:
    """Pieces as sorted hashes with ids and scores."""

    def __init__(self, model_path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        count = model.get_piece_size()
        self.pieces = [model.id_to_piece(k) for k in range(count)]
        self.byte_ids = {int(p[3:5], 16): k for k, p in enumerate(self.pieces) if model.is_byte(k)}
        usual = [
            k for k in range(count) if not (model.is_byte(k) or model.is_control(k) or model.is_unknown(k) or model.is_unused(k))
        ]
        if any(SPACE in self.pieces[k].lstrip(SPACE) for k in usual):
            raise ValueError("a piece has a space inside: texts cannot be cut at spaces")
        self.bytes_of = {k: b for b, k in self.byte_ids.items()}
        self.longest = max(len(self.pieces[k]) for k in usual)
        by_rank = sorted(usual, key=lambda k: -model.get_score(k))
        scores = dict(zip(by_rank, -np.log(np.arange(len(by_rank)) + 2.0)))
        self.unknown = min(scores.values()) - UNKNOWN_PENALTY
        singles = {self.pieces[k] for k in usual if len(self.pieces[k]) == 1}
        for byte in range(128):  # a byte that is a character of its own acts as a piece
            if chr(byte) not in singles and byte in self.byte_ids:
                usual.append(self.byte_ids[byte])
                scores[self.byte_ids[byte]] = self.unknown
        strings = [chr(self.bytes_of[k]) if k in self.bytes_of else self.pieces[k] for k in usual]
        keys = np.array([piece_key(s) for s in strings], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(usual, np.int32)[order]
        self.scores = np.array([scores[k] for k in usual])[order]
        if (np.diff(self.keys) == 0).any():
            raise ValueError("two pieces have the same hash")
        tops = self.keys >> np.uint64(64 - TOP_BITS)
        self.crowd = int(np.bincount(np.unique(tops, return_inverse=True)[1]).max())
        self.first = np.full(1 << TOP_BITS, -1, np.int32)
        self.first[tops[::-1]] = np.arange(len(tops), dtype=np.int32)[::-1]
        self.powers = np.cumprod(np.concatenate(([1], np.full(self.longest, BASE))).astype(np.uint64))
        self.known: dict[str, bytes] = {}

    def learn(self, segments: set[str]) -> None:
        """Encode segments not met lately, those of a length together; long ones with those of nearly their length."""
        if len(self.known) > CACHED_SEGMENTS:
            self.known.clear()
        new = sorted(segments.difference(self.known), key=len)
        low = 0
        while low < len(new):
            high = bisect_right(new, length_class(len(new[low])), low, key=len)
            high = min(high, low + max(1, BATCH_CHARS // len(new[high - 1])))
            part = new[low:high]
            self.known.update(zip(part, self.viterbi(part)))
            low = high

    def matches(self, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the probes that are keys, and of these keys: by the first key with the same top bits, and on."""
        probes = probes.ravel()
        at = self.first[probes >> np.uint64(64 - TOP_BITS)]
        places = np.flatnonzero(at >= 0)
        at, probes = at[places], probes[places]
        for _ in range(self.crowd - 1):
            at = at + ((self.keys[at] < probes) & (at < len(self.keys) - 1))
        real = self.keys[at] == probes
        return places[real], at[real]

    def viterbi(self, segments: list[str]) -> list[bytes]:
        """The ids of segments that advance together, a row of each table for a place in all of them.

        Shorter segments are filled up behind their end, which nothing before it sees. The pieces that end at the
        next places are looked up in blocks of places, so that a long segment needs no more memory.
        """
        n, sizes = len(segments), np.fromiter(map(len, segments), np.int64, len(segments))
        length, columns = int(sizes.max()), np.arange(len(segments))
        filled = "".join(segments if int(sizes.min()) == length else [s.ljust(length) for s in segments])
        chars = np.frombuffer(filled.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, length).T
        hashes = np.zeros((length + 1, n), np.uint64)
        for k in range(length):
            hashes[k + 1] = hashes[k] * BASE + chars[k] + np.uint64(1)
        best = np.zeros((length + 1, n))
        back = np.zeros((length + 1, n), np.int32)
        piece = np.full((length + 1, n), -1, np.int32)
        block = max(1, BATCH_CHARS // n)
        for low in range(1, length + 1, block):
            ends = min(length + 1, low + block) - low
            most = min(self.longest, low + ends - 1)
            gains = np.full((ends, most, n), -np.inf)
            gains[:, 0] = self.unknown
            ids = np.full((ends, most, n), -1, np.int32)
            for size in range(1, most + 1):
                first = max(low, size)
                probes = hashes[first : low + ends] - hashes[first - size : low + ends - size] * self.powers[size]
                probes ^= np.uint64(size * GOLDEN & ALL_BITS)
                probes *= np.uint64(GOLDEN)
                places, at = self.matches(probes)
                rows, columns_met = np.divmod(places, n)
                gains[rows + (first - low), size - 1, columns_met] = self.scores[at]
                ids[rows + (first - low), size - 1, columns_met] = self.ids[at]
            for k in range(ends):
                end = low + k
                here = min(most, end)
                totals = gains[k, :here] + best[end - here : end][::-1]
                choice = totals.argmax(0)
                best[end] = totals[choice, columns]
                back[end] = choice + 1
                piece[end] = ids[k, choice, columns]
        return self.traced(segments, sizes, back, piece)

    def traced(self, segments: list[str], sizes: np.ndarray, back: np.ndarray, piece: np.ndarray) -> list[bytes]:
        """All segments are walked back together; the places met, read in order, are the ends of the pieces."""
        n = len(segments)
        met = np.zeros((n, len(back)), bool)
        rows, at = np.arange(n), sizes
        while len(rows):
            met[rows, at] = True
            at = at - back[at, rows]
            rows, at = rows[at > 0], at[at > 0]
        found = piece.T[met]
        ends = np.cumsum(4 * met.sum(1)).tolist()
        ids = found.tobytes()
        out = [ids[low:high] for low, high in zip([0, *ends], ends)]
        if (found < 0).any():
            for k in np.flatnonzero(((piece.T < 0) & met).any(1)).tolist():
                own = self.with_bytes(segments[k], np.flatnonzero(met[k]).tolist(), np.frombuffer(out[k], np.int32).tolist())
                out[k] = np.fromiter(own, np.int32).tobytes()
        return out

    def with_bytes(self, segment: str, ends: list[int], ids: list[int]) -> Iterator[int]:
        """The ids, with the bytes of a character where it has no piece."""
        for end, one in zip(ends, ids):
            if one >= 0:
                yield one
            else:
                yield from (self.byte_ids[b] for b in segment[end - 1].encode())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [SEGMENT.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        self.learn(set(chain.from_iterable(cut)))
        return [np.frombuffer(b"".join(map(self.known.__getitem__, c)), np.int32) for c in cut]

    def decode(self, ids: list[int]) -> str:
        """The text of the ids: pieces joined, runs of byte pieces read as UTF-8."""
        out = b"".join(map(self.raw.__getitem__, ids))
        return out.decode("utf-8", "replace").replace(SPACE, " ")[1:]

    @cached_property
    def raw(self) -> list[bytes]:
        return [bytes([self.bytes_of[k]]) if k in self.bytes_of else piece.encode() for k, piece in enumerate(self.pieces)]


def length_class(length: int) -> int:
    """The greatest length that is searched together with this one."""
    step = 1 << max(0, length.bit_length() - 5)
    return length if length <= EXACT_LENGTH else -(-length // step) * step


def piece_key(piece: str) -> int:
    code = 0
    for c in piece:
        code = (code * int(BASE) + ord(c) + 1) & ALL_BITS
    return (code ^ (len(piece) * GOLDEN & ALL_BITS)) * GOLDEN & ALL_BITS


LOADED: dict[str, Vocabulary] = {}


def vocabulary(model_path: str) -> Vocabulary:
    if model_path not in LOADED:
        LOADED[model_path] = Vocabulary(model_path)
    return LOADED[model_path]


def public_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode_rows(model_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(model_path)
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                texts = part.column(1).to_pylist()
                ids = pieces.encode(texts)
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["doc_id", "ids"]
                )

    return run


def round_trip_rows(model_path: str):
    encode = encode_rows(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(model_path)
        parts = (batch.slice(low, 512) for batch in batches for low in range(0, batch.num_rows, 512))
        for part in parts:
            (tokens,) = encode(iter([part]))
            flat, ends = tokens.column(1).values.to_numpy().tolist(), tokens.column(1).offsets.to_pylist()
            texts = [pieces.decode(flat[low:high]) for low, high in zip(ends, ends[1:])]
            digests = pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())
            same = pa.array([a == b for a, b in zip(texts, part.column(1).to_pylist())], pa.bool_())
            names = ["doc_id", "ids", "decoded_sha256", "round_trip"]
            yield pa.RecordBatch.from_arrays([*tokens.columns, digests, same], names=names)

    return run


def decode_rows(model_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(model_path)
        for batch in batches:
            texts = [pieces.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return run


def encoded(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", model_path: str | None = None) -> DataFrame:
    """Per row: identifier and the ids of the whole text."""
    on_workers(docs.sparkSession)
    rows = docs.select(docs[id_column].cast("long"), F.coalesce(docs[text_column], F.lit("")))
    found = rows.mapInArrow(encode_rows(model_path or public_model()), "doc_id long, ids array<int>")
    return found.withColumnRenamed("doc_id", id_column)


def decoded(tokens: DataFrame, id_column: str = "doc_id", ids_column: str = "ids", model_path: str | None = None) -> DataFrame:
    """Per row: identifier and the text of its ids."""
    on_workers(tokens.sparkSession)
    rows = tokens.select(tokens[id_column].cast("long"), tokens[ids_column].cast("array<int>"))
    return rows.mapInArrow(decode_rows(model_path or public_model()), "doc_id long, text string").withColumnRenamed("doc_id", id_column)


def round_trips(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", model_path: str | None = None) -> DataFrame:
    """Per row: identifier, ids, SHA-256 of the text decoded from the ids, and whether that is the row's text."""
    on_workers(docs.sparkSession)
    rows = docs.select(docs[id_column].cast("long"), F.coalesce(docs[text_column], F.lit("")))
    schema = "doc_id long, ids array<int>, decoded_sha256 string, round_trip boolean"
    return rows.mapInArrow(round_trip_rows(model_path or public_model()), schema).withColumnRenamed("doc_id", id_column)
