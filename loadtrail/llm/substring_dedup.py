"""Removal of passages that occur before, by sliding spans of sentences.

A span opens at every sentence and takes the following ones until it has at least two sentences and twenty words, so
spans slide over the whole text and none is so short that it comes back by chance. A sentence of ``alone_words`` is a span
by itself as well, whatever stands around it. All spans are hashed (128 bits) and joined across the corpus. The first
occurrence, by identifier and place, keeps its sentences; every sentence that lies in a later occurrence of any span is
removed, in the same document as well.

Sentences end at ``.``, ``!`` or ``?`` before white space, at a stop of another script, or at a line break, and keep what
separates them from the next, so what is left of a text is what it was. Spans compare sentences without case of A-Z and
with white space as one space. In scripts that set no spaces two characters count as a word.

With ``run_words``, a sentence of more words (text without stops) is a row of pieces, and spans take pieces in place of
sentences. A piece ends where a checksum of two neighbouring words says so, so a passage is cut alike wherever it stands,
or after ``LONGEST_PIECE`` words.

Defined cases: a null text counts as empty and stays empty; a text shorter than a span loses nothing. A null identifier
comes before all others. Rows that repeat identifier and text are one document. An empty table gives an empty result.
Only the identifier and the text are read, whatever else there is.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadtrail.llm.staging import landed, on_workers, row_batch, signed

#: Characters of scripts without spaces between words; stops that need no white space behind them.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
STOPS = "\u3002\uff01\uff1f\uff61\u0964\u0965\u061f\u06d4\u104b\u17d4\u1362"
SENTENCE = re.compile(rf".+?(?:[.!?](?=\s)|[{STOPS}]|\n|\Z)\s*|\s+", re.DOTALL)
UNIT = re.compile(rf"[{UNSPACED}]\s*|[^\s{UNSPACED}]+\s*|\s+")
OF_UNSPACED = re.compile(f"[{UNSPACED}]")
#: Of two neighbouring words one in CUT_EVERY ends a piece.
CUT_EVERY = 8
LONGEST_PIECE = 40
SPANS = "high long, low long, doc_id long, text_hash long, place int, sentences int"
CLEANED = "doc_id long, text string, n_sentences int, n_removed int"


def sentences(text: str) -> list[str]:
    """The sentences with what follows them; joined, they are the text."""
    return SENTENCE.findall(text)


def plain(sentence: str) -> bytes:
    return b" ".join(sentence.encode().lower().split())


def n_words(sentence: str) -> int:
    """Words between white space; of a script without spaces, half the characters."""
    own = len(sentence.encode().split())
    return own if sentence.isascii() else max(own, len(OF_UNSPACED.findall(sentence)) // 2)


def pieces(sentence: str) -> list[str]:
    """A sentence cut where two neighbouring words say so; joined, they are the sentence."""
    found, before, held, weight = [], b"", [], 0.0
    for unit in UNIT.findall(sentence):
        own = plain(unit)
        held.append(unit)
        weight += 0.5 if OF_UNSPACED.match(unit) else 1.0
        if weight >= LONGEST_PIECE or (before and own and zlib.crc32(before + b" " + own) % CUT_EVERY == 0):
            found.append("".join(held))
            held, weight = [], 0.0
        before = own
    return [*found, "".join(held)] if held else found


def cut(text: str, run_words: int | None) -> tuple[list[str], list[int]]:
    """Sentences, the longer ones in pieces, and where every sentence begins."""
    parts, begins = [], []
    for sentence in sentences(text):
        begins.append(len(parts))
        if run_words and len(sentence) > run_words and n_words(sentence) > run_words:
            parts += pieces(sentence)
        else:
            parts.append(sentence)
    return parts, begins


def spans(parts: list[str], begins: list[int], least_sentences: int, least_words: int, alone_words: int) -> set[tuple[int, int]]:
    """(first part, parts) of every span. Places without a word count as no sentence of a span."""
    sizes = [n_words(part) for part in parts]
    worded = [k for k, size in enumerate(sizes) if size]
    words = np.cumsum([0] + [sizes[k] for k in worded])
    starts = np.arange(len(worded))
    ends = np.maximum(np.searchsorted(words, words[:-1] + least_words), starts + least_sentences)
    found = {(worded[i], worded[j - 1] - worded[i] + 1) for i, j in zip(starts.tolist(), ends.tolist()) if j <= len(worded)}
    for low, high in zip(begins, [*begins[1:], len(parts)]):
        if sum(sizes[low:high]) >= alone_words:
            found.add((low, high - low))
    return found


def text_code(text: str) -> int:
    return signed(xxhash.xxh3_64_intdigest(text))


def span_rows(least_sentences: int, least_words: int, alone_words: int, run_words: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low64 = (1 << 64) - 1
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parts, begins = cut(text, run_words)
                compared = [plain(s) for s in parts]
                code = text_code(text)
                for first, n in spans(parts, begins, least_sentences, least_words, alone_words):
                    digest = xxhash.xxh3_128_intdigest(b"\n".join(compared[first : first + n]))
                    rows.append((signed(digest >> 64), signed(digest & low64), doc_id, code, first, n))
                if len(rows) > 50_000:
                    yield row_batch(rows, SPANS)
                    rows = []
            yield row_batch(rows, SPANS)

    return run


def with_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = pa.array(map(text_code, batch.column(1).to_pylist()), pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, codes], names=["doc_id", "text", "text_hash"])


def without_repeats(run_words: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, repeats in zip(*(c.to_pylist() for c in batch.columns)):
                parts, begins = cut(text, run_words)
                gone = np.zeros(len(parts), bool)
                for span in repeats or ():
                    gone[span["place"] : span["place"] + span["sentences"]] = True
                lost = int(np.logical_or.reduceat(gone, begins).sum()) if begins else 0
                rows.append((doc_id, "".join(p for p, g in zip(parts, gone) if not g), len(begins), lost))
            yield row_batch(rows, CLEANED)

    return run


def without_repeated_spans(
    docs: DataFrame,
    least_sentences: int = 2,
    least_words: int = 20,
    id_column: str = "doc_id",
    text_column: str = "text",
    alone_words: int = 20,
    run_words: int | None = None,
) -> DataFrame:
    """Per row: identifier, the text without repeated passages, its sentences and how many lost something."""
    on_workers(docs.sparkSession)
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), F.coalesce(docs[text_column], F.lit("")).alias("text"))
    # landed, since it is read twice and cutting and hashing cost more than some forty bytes a span
    found = landed(rows.mapInArrow(span_rows(least_sentences, least_words, alone_words, run_words), SPANS), "spans")
    where = F.struct("doc_id", "text_hash", "place")
    # the smallest and largest place differ only where a span occurs twice
    repeated = found.groupBy("high", "low").agg(F.min(where).alias("first"), F.max(where).alias("last"))
    repeated = landed(repeated.where("first <> last").select("high", "low", "first"), "repeated-spans")
    later = found.join(repeated, ["high", "low"]).where(~where.eqNullSafe(F.col("first")))
    per_text = later.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("place", "sentences")).alias("repeats"))
    per_text = landed(per_text, "texts-with-repeats")
    coded = rows.mapInArrow(with_codes, "doc_id long, text string, text_hash long")
    same = coded["doc_id"].eqNullSafe(per_text["doc_id"]) & (coded["text_hash"] == per_text["text_hash"])
    joined = coded.join(per_text, same, "left").select(coded["doc_id"], "text", "repeats")
    return joined.mapInArrow(without_repeats(run_words), CLEANED).withColumnRenamed("doc_id", id_column)
