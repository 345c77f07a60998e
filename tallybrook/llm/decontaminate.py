"""Benchmark decontamination by an FM-index for each training shard (operator 9).

A shard is a run of documents with some ``SHARD_BYTES`` of text. Its words are numbered by the benchmark's own
words; a stretch of other words, and the end of a document, becomes one separator, since no phrase can hold
or cross it. All windows of the benchmark are searched backward in the shard's index at once, the rows found
are located by sampled suffix positions, and overlapping places are merged into removal spans of
word positions in the document.

A phrase is ``window`` consecutive words of an item; an item of fewer words is one phrase. The benchmark is the query set: it
is cut into pieces, each with a run of an item's windows, and worked on in blocks of about ``BLOCK_BYTES`` of distinct pieces.
Each block is another pass over the documents, written to the shared folder before the next one, so that a task holds one block.

Cases: null and empty texts have no words and no spans; an item without words or without an id is never reported (one without
an id still marks words); repeated rows, null ids and an empty benchmark or table are fine; equal items are all reported;
extra columns are left out. Documents are neither grouped nor shuffled, so no key is hot.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import carried, exclusive_sum, groups, stage
from tallybrook.llm.fm_index import FmIndex

WINDOW = 13
BLOCK_BYTES = 8 << 20
#: Text of a shard. Its suffix order takes some twenty bytes of memory for each byte, beside all else that an executor holds by then.
SHARD_BYTES = 4 << 20
#: Windows in a piece of the benchmark; pieces overlap by a window less one word.
PIECE = 1000
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_SPANS_SQL = "array<struct<start:bigint,end:bigint>>"
#: lower case for A-Z, a space for every other ASCII byte but digits and a-z
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Phrases:
    """The windows of a block of pieces, as rows of word numbers filled from the right."""

    def __init__(self, pieces: list[tuple[int | None, bytes]], window: int):
        self.numbers: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[int]] = {}
        for item, piece in pieces:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in piece.split(b" ")]
            for i in range(max(1, len(ids) - window + 1)):
                found.setdefault(tuple(ids[i : i + window]), set()).update([] if item is None else [item])
        self.items = [sorted(s) for s in found.values()]
        self.lengths = np.array([len(k) for k in found], np.int64)
        self.rows = np.zeros((len(found), window), np.int64)
        for row, key in zip(self.rows, found):
            row[window - len(key) :] = key

    def occurrences(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, position) of all places in a shard."""
        none = np.zeros(0, np.int64)
        if not len(self.rows) or not len(symbols):
            return none, none
        index = FmIndex(symbols, len(self.numbers))
        low, high = index.ranges(self.rows, self.lengths)
        times = high - low
        phrase = np.repeat(np.arange(len(times)), times)
        rows = np.arange(int(times.sum())) + np.repeat(low - exclusive_sum(times)[:-1], times)
        return phrase, index.locate(rows)


def _pieces(window: int, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(item, words of a piece): every window of an item is in one of its pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in groups(batches):
            items, pieces = [], []
            for item, text in zip(batch.column("item").to_pylist(), texts):
                words = words_of(text)
                for i in range(0, max(1, len(words) - window + 1), most) if words else ():
                    items.append(item)
                    pieces.append(b" ".join(words[i : i + most + window - 1]))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(pieces, pa.binary())], names=["item", "piece"])

    return run


def _merged(starts: np.ndarray, ends: np.ndarray) -> list[dict[str, int]]:
    out: list[dict[str, int]] = []
    for a, b in sorted(zip(starts.tolist(), ends.tolist())):
        if out and a <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], b)
        else:
            out.append({"start": a, "end": b})
    return out


def _search(load: Callable[[], Phrases]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = load()
        number = phrases.numbers.get
        for batch, texts in groups(batches, limit=SHARD_BYTES):
            parts, counts = [], []
            for text in texts:
                words = words_of(text)
                counts.append(len(words))
                parts.append(np.fromiter(map(number, words, repeat(0)), np.int32, len(words)))
                parts.append(np.zeros(1, np.int32))
            flat = np.concatenate(parts)
            begin = exclusive_sum(np.array(counts, np.int64) + 1)  # each document ends with a separator
            kept = np.flatnonzero((flat != 0) | np.append(True, flat[:-1] != 0))  # one separator for a stretch
            symbols = np.append(flat[kept], np.zeros(1, np.int32)) if len(kept) else flat[:0]
            phrase, at = phrases.occurrences(symbols)
            start = kept[at]
            text_of = np.searchsorted(begin, start, "right") - 1
            order = np.argsort(text_of, kind="stable")
            phrase, start, text_of = phrase[order], start[order], text_of[order]
            cuts = np.searchsorted(text_of, np.arange(len(texts) + 1))
            spans, items = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
            for i in np.unique(text_of).tolist():
                own = slice(cuts[i], cuts[i + 1])
                first = start[own] - begin[i]
                earlier = spans[i]
                spans[i] = _merged(np.append(first, [s["start"] for s in earlier]), np.append(first + phrases.lengths[phrase[own]], [s["end"] for s in earlier]))
                items[i] = sorted({*items[i], *(x for p in np.unique(phrase[own]).tolist() for x in phrases.items[p])})
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-3], pa.array(counts, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.int64()))], names=batch.schema.names
            )

    return run


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns of ``keep`` with n_words, spans (array of (start, end) in words) and items (array of item ids)."""
    keep = ["doc_id"] if keep is None else keep
    narrow, names = carried(docs, text_col, keep)
    items = benchmark.select(benchmark[item_col].cast("long").alias("item"), benchmark[item_text_col].alias("text"))
    pieces = stage(items.mapInArrow(_pieces(window, PIECE), "item long, piece binary").distinct())
    size = pieces.agg(F.coalesce(F.sum(F.octet_length("piece")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    out = narrow.select(
        "*",
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast(_SPANS_SQL).alias("spans"),
        F.array().cast("array<bigint>").alias("items"),
    )
    schema = out.schema
    for block in range(blocks):
        own = pieces.filter(F.pmod(F.xxhash64("item", "piece"), F.lit(blocks)) == block)
        shared = docs.sparkSession.sparkContext.broadcast([(r.item, bytes(r.piece)) for r in own.collect()])
        out = out.mapInArrow(_search(_loader(shared, window)), schema)
        if block < blocks - 1:
            out = stage(out)
            shared.destroy()
    return out.select(*names, "n_words", "spans", "items").toDF(*keep, "n_words", "spans", "items")


def _loader(shared, window: int) -> Callable[[], Phrases]:
    return lambda: Phrases(shared.value, window)


def n_hit(spans: str = "spans"):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``find`` with n_hit and contaminated: at least a word in twenty is part of a benchmark window."""
    found = find(docs, benchmark, **options).withColumn("n_hit", n_hit())
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
