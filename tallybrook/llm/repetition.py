"""Repetition coverage (operator 5): how much of a text lies inside repeated n-grams and lines.

Words are hashed to 64 bits; a polynomial prefix sum over a group of texts gives the rolling hash of
every window of any length by one subtraction. Windows of one text with equal hashes are
repeats (two different windows of one text agree with a probability of about 2^-60), all
of them count, the first one included. A window of n words can only
repeat if its first ``min(lengths)`` words do, so longer windows are hashed only there. Lines are compared as bytes.

A text is rejected when the characters inside repeated windows of some length, or inside
repeats of lines, make up more than that length's share of all word characters.

Cases: a null or empty text has no words and fails the base rule; ids and repeated rows stay
as they are, one row out per row in; nothing is grouped, so ties, hot groups and extra columns do not matter; an
empty table gives an empty result; a text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import carried, exclusive_sum, groups, mixed

#: largest share of the characters, by window length; the base rule already looks at five words
LIMITS = {5: 0.25, 8: 0.20, 10: 0.15}
LINE_LIMIT = 0.30
#: Text whose words a worker compares at once: some fifty bytes of memory for each byte of it.
GROUP_BYTES = 2 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SYMBOLS = b"#*$%&|<>"


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which entries have an equal one."""
    order = np.argsort(keys)
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def covered_words(words: np.ndarray, ends: np.ndarray, lengths: list[int]) -> dict[int, np.ndarray]:
    """For each window length, which words lie in a window that its text holds twice or more.

    words: a 64-bit hash each; ends: where the texts end, with a leading 0.
    """
    n = len(words)
    text = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(words * _powers(_BASE, n), out=prefix[1:], dtype=np.uint64)
    inverse = _powers(_INVERSE, n)
    own = mixed(np.arange(len(ends) - 1, dtype=np.uint64), 7)
    starts, out = np.arange(n), {}
    for size in sorted(lengths):
        starts = starts[starts + size <= ends[1:][text[starts]]]
        rolling = (prefix[starts + size] - prefix[starts]) * inverse[starts]
        starts = starts[repeated(mixed(rolling) + own[text[starts]])]
        step = np.zeros(n + 1, np.int64)
        np.add.at(step, starts, 1)
        np.subtract.at(step, starts + size, 1)
        out[size] = np.cumsum(step[:-1]) > 0
    return out



def line_repeats(text: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and their characters without outer white space."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    if len(set(lines)) == len(lines):
        return 0, 0
    seen: set[bytes] = set()
    count = chars = 0
    for line in lines:
        if line in seen:
            count += 1
            chars += len(line.strip().decode("utf-8", "replace"))
        seen.add(line)
    return count, chars


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = exclusive_sum(values)
    return total[ends[1:]] - total[ends[:-1]]


def measure(docs: DataFrame, lengths: list[int], text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns of ``keep`` and n_words, word_chars, n_symbols, n_dup_lines, dup_line_chars,
    then for every length n repeat_words_n and repeat_chars_n."""
    keep = ["doc_id"] if keep is None else keep
    narrow, names = carried(docs, text_col, keep)
    figures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "dup_line_chars", *[f"repeat_{k}_{n}" for n in lengths for k in ("words", "chars")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in groups(batches, limit=GROUP_BYTES):
            split = [t.split() for t in texts]
            ends = exclusive_sum(np.array([len(w) for w in split], np.int64))
            flat = [w for words in split for w in words]
            hashes = mixed(np.fromiter(map(hash, flat), np.int64, len(flat)).view(np.uint64))
            bytes_at = exclusive_sum(np.fromiter(map(len, flat), np.int64, len(flat)))
            points = exclusive_sum((np.frombuffer(b"".join(flat), np.uint8) & 0xC0) != 0x80)
            chars = np.diff(points[bytes_at])
            lines = [line_repeats(t) for t in texts]
            columns = [np.diff(ends), _sums(chars, ends), np.array([len(t) - len(t.translate(None, _SYMBOLS)) for t in texts], np.int64), np.array([x[0] for x in lines], np.int64), np.array([x[1] for x in lines], np.int64)]
            inside = covered_words(hashes, ends, lengths)
            for size in lengths:
                columns += [_sums(inside[size], ends), _sums(inside[size] * chars, ends)]
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), *(pa.array(c, pa.int64()) for c in columns)], names=[*names, *figures])

    schema = narrow.select(*names, *[F.lit(0).cast("long").alias(f) for f in figures]).schema
    return narrow.mapInArrow(run, schema).toDF(*keep, *figures)


def judge(docs: DataFrame, limits: dict[int, float] | None = None, line_limit: float = LINE_LIMIT, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``measure`` with base_failed and kept."""
    limits = LIMITS if limits is None else limits
    figures = measure(docs, sorted({5, *limits}), text_col, keep)
    failed = (F.col("n_words") < 10) | (100 * F.col("repeat_words_5") > 20 * F.col("n_words"))
    over = F.col("dup_line_chars") > line_limit * F.col("word_chars")
    for size, limit in limits.items():
        over = over | (F.col(f"repeat_chars_{size}") > limit * F.col("word_chars"))
    return figures.select("*", failed.alias("base_failed"), (~failed & ~over).alias("kept"))
