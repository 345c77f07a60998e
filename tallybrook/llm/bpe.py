"""Byte-level BPE encoding and decoding (operator 1).

Each match of the split pattern is a piece; each distinct piece of the corpus is
merged once, and its ids go back to all places that hold it
(see ``distinct``). Ids are stored as little-endian unsigned 32-bit integers, the
form they are hashed and trained on.

Cases: a null or empty text has no ids; ids and order of repeated rows are kept, one
row out per row in; a null document id stays null; other columns are not looked at; an
empty table gives an empty result. A decoded id beyond the table is an error.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import exclusive_sum, gather
from tallybrook.llm.distinct import through_distinct

# Unicode white space as the tokenizer's own library knows it (\\s here would also take
# U+001C to U+001F), and the letters and numbers below U+0250.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LETTERS = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
_NUMBERS = r"0-9\xb2\xb3\xb9\xbc-\xbe"


def _in_classes(pattern: str, replaced: dict[str, str]) -> str:
    """Write out classes of the pattern, inside brackets as they are and in brackets elsewhere."""

    def one(m: re.Match) -> str:
        if m[0].startswith("["):
            return re.sub("|".join(map(re.escape, replaced)), lambda x: replaced[x[0]], m[0])
        return f"[^{_SPACE}]" if m[0] == r"\S" else f"[{replaced[m[0]]}]" if m[0] in replaced else m[0]

    return re.sub(r"\[\^?(?:\\.|[^\]\\])*\]|\\p\{\w+\}|\\.", one, pattern)


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """Pieces of a text. Texts below U+0250 take a pattern with written-out classes, which is faster."""
    full = regex.compile(_in_classes(pattern, {r"\s": _SPACE}))
    latin = _in_classes(pattern, {r"\s": _SPACE, r"\p{L}": _LETTERS, r"\p{N}": _NUMBERS})
    if r"\p" in latin:
        return full.findall
    plain, beyond = re.compile(latin), re.compile(r"[^\x00-\u024f]")

    def split(text: str) -> list[str]:
        return (full if beyond.search(text) else plain).findall(text)

    return split


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank file of a public tokenizer: base64 piece and rank on each line; its size is the vocabulary's, not the corpus's."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids binary) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    cache: list = []

    def pieces(text: str) -> list[str]:
        if not cache:
            cache.append(splitter(pattern))
        return cache[0](text)

    def make() -> Callable[[bytes], list[int]]:
        ranks = shared.value
        merge = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._encode_single_piece

        def work(word: bytes) -> list[int]:
            whole = ranks.get(word)
            return [whole] if whole is not None else merge(word)

        return work

    def combine(numbers: np.ndarray, ends: np.ndarray) -> list[bytes]:
        numbers = numbers.astype("<u4", copy=False)
        return [numbers[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    return through_distinct(docs, id_col, text_col, pieces, make, combine, "binary", pa.binary()).withColumnRenamed("value", "ids")


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the bytes that the ids stand for: each id looks up its row of the token-byte table.

    The table is sent to every task; it is as large as the vocabulary file.
    """
    ranks = read_ranks(ranks_path)
    by_id = [b""] * (max(ranks.values(), default=-1) + 1)
    for word, i in ranks.items():
        by_id[i] = word
    shared = encoded.sparkSession.sparkContext.broadcast((np.frombuffer(b"".join(by_id), np.uint8), np.array([len(w) for w in by_id], np.int64)))
    names = [f"c{i}" for i in range(len(encoded.columns))]
    own = encoded.toDF(*names)
    at = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, lengths = shared.value
        starts = exclusive_sum(lengths)
        for whole in batches:
            for a in range(0, whole.num_rows, 256):
                batch = whole.slice(a, 256)
                texts = []
                for raw in batch.column(at).to_pylist():
                    ids = np.frombuffer(raw or b"", "<u4")
                    texts.append(gather(flat, starts[ids], lengths[ids]).tobytes())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=[*batch.schema.names, "out"])

    schema = own.select("*", F.lit(b"").alias("out")).schema
    return own.mapInArrow(run, schema).toDF(*encoded.columns, out)
