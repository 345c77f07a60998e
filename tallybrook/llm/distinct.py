"""Work on each distinct word of a corpus once, then bring the results back to the texts.

Texts are cut into pieces with positions; a block of documents keeps, for each
piece, its place in the block's own word list. The word lists, not the occurrences, are shuffled:
dealt by word hash, so each distinct word meets in one task, which works on
it once and answers every block that holds it. The answers go back to the blocks, where
documents are put together by position. The blocks themselves are stored in buckets by block and not shuffled.

A very common word is one row entry per block, not per occurrence, so no key is hot.
The block lists are packed by (block, bucket); a block has no more rows than
distinct words, so the packing never makes more rows than an unpacked shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tallybrook.llm.common import exclusive_sum, gather, give_back, groups, shuffle_width, stage_bucketed

STAGED = "block long, bucket int, ids array<long>, counts binary, body binary"
_STAGED = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("ids", pa.list_(pa.int64())), ("counts", pa.binary()), ("body", pa.binary())])
_ANSWER = "block long, bucket int, counts binary, body binary"
_ANSWER_ARROW = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("counts", pa.binary()), ("body", pa.binary())])
#: Text of a block of documents.
BLOCK_BYTES = 8 << 20
_DOCS = -1  # the bucket of a row that holds a block's documents


def pack(values: np.ndarray | bytes) -> bytes:
    raw = values if isinstance(values, bytes) else np.ascontiguousarray(values).tobytes()
    return zstandard.compress(raw, 3)


def pack_planes(values: np.ndarray) -> bytes:
    """Numbers by byte planes, which compress better."""
    return pack(np.ascontiguousarray(values.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4).T))


def unpack_planes(body: bytes) -> np.ndarray:
    return np.ascontiguousarray(unpack(body, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def unpack(body: bytes, dtype: type | None = None) -> np.ndarray | bytes:
    raw = zstandard.decompress(body) if body else b""
    return raw if dtype is None else np.frombuffer(raw, dtype)


def _to_blocks(pieces: Callable[[str], list[str]], buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch, texts in groups(batches, limit=BLOCK_BYTES):
            known: dict[str, int] = {}
            counts, index = [], []
            for text in texts:
                found = pieces(text.decode("utf-8", "replace"))
                counts.append(len(found))
                index.append(np.array([known.setdefault(w, len(known)) for w in found], np.uint32))
            words = [w.encode() for w in known]
            home = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int32, len(words))
            order = np.array(sorted(range(len(words)), key=lambda i: (home[i], words[i])), np.int64)
            place = np.empty(len(words), np.uint32)
            place[order] = np.arange(len(words), dtype=np.uint32)
            flat = place[np.concatenate(index)] if index else place
            rows = [(block, _DOCS, batch.column(0).to_pylist(), pack(np.array(counts, np.uint32)), pack_planes(flat))]
            for part in np.split(order, np.flatnonzero(np.diff(home[order])) + 1) if len(words) else []:
                own = [words[i] for i in part]
                rows.append((block, int(home[part[0]]), None, pack(np.array([len(w) for w in own], np.uint32)), pack(b"".join(own))))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _STAGED)], schema=_STAGED)
            block += 1

    return run


def _answers(make: Callable[[], Callable[[bytes], list[int]]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        known: dict[bytes, np.ndarray] = {}  # this task's share of the distinct words
        for batch in batches:
            for block, bucket, counts, body in zip(*(batch.column(c).to_pylist() for c in ("block", "bucket", "counts", "body"))):
                ends = exclusive_sum(unpack(counts, np.uint32)).tolist()
                raw, out = unpack(body), []
                for a, b in zip(ends, ends[1:]):
                    word = raw[a:b]
                    got = known.get(word)
                    if got is None:
                        got = known[word] = np.array(work(word), np.uint32)
                    out.append(got)
                sizes = np.fromiter(map(len, out), np.uint32, len(out))
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((block, bucket, pack(sizes), pack(np.concatenate(out))), _ANSWER_ARROW)], schema=_ANSWER_ARROW)
        known.clear()
        give_back()

    return run


def through_distinct(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    pieces: Callable[[str], list[str]],
    make: Callable[[], Callable[[bytes], list[int]]],
    combine: Callable[[np.ndarray, np.ndarray], list],
    result: str,
    result_type: pa.DataType,
) -> DataFrame:
    """``pieces`` cuts a text, ``make()`` gives a task its word function, ``combine(numbers,
    ends)`` turns the numbers of a block's pieces and the ends of its documents among them
    into one value per document. Returns (id, value), one row per input row.
    """
    spark = docs.sparkSession
    n = shuffle_width(spark)
    id_type = dict(docs.dtypes)[id_col]
    narrow = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    staged = stage_bucketed(narrow.mapInArrow(_to_blocks(pieces, n), STAGED), "block")
    lists = staged.filter(staged.bucket >= 0).select("block", "bucket", "counts", "body")
    answers = lists.repartition(n, "bucket").mapInArrow(_answers(make), _ANSWER)
    schema = pa.schema([("id", pa.int64()), ("value", result_type)])

    def together(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("bucket").to_numpy(), kind="stable")
        sizes = [unpack(b, np.uint32) for b in right.column("counts").to_pylist()]
        bodies = [unpack(b, np.uint32) for b in right.column("body").to_pylist()]
        none = np.zeros(0, np.uint32)
        lengths = np.concatenate([none, *(sizes[i] for i in order)]).astype(np.int64)
        flat = np.concatenate([none, *(bodies[i] for i in order)])
        starts = exclusive_sum(lengths)
        ids: list = []
        values: list = []
        for own, counts, body in zip(left.column("ids").to_pylist(), left.column("counts").to_pylist(), left.column("body").to_pylist()):
            index = unpack_planes(body)
            numbers = gather(flat, starts[index], lengths[index])
            ends = exclusive_sum(lengths[index])[exclusive_sum(unpack(counts, np.uint32))]
            ids += own
            values += combine(numbers, ends)
        del sizes, bodies, flat
        give_back()
        return pa.table([pa.array(ids, pa.int64()), pa.array(values, result_type)], schema=schema)

    held = staged.filter(staged.bucket == _DOCS).select("block", "ids", "counts", "body")
    out = held.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(together, f"id long, value {result}")
    return out.select(out["id"].cast(id_type).alias(id_col), "value")
