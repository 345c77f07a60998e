"""Fill-in-middle transformation by a wavelet matrix over character classes (operator 13).

A text is cut into units: runs of characters that end after a character of certain classes, or with the text. ``UNITS`` names
these classes: lines end after a line feed; sentences after ``. ! ?`` or a line feed; words after a blank, a tab or a line feed.
The classes of a group of texts are held as a wavelet matrix, two bit planes deep:

- the number of units is the boundary count, the sum of the classes' ranks at the text's ends, and one more for a rest without a boundary;
- the place of the k-th boundary of one class is selected, of several classes it is found by bisection on the sum of their ranks.

So both cuts of every text are found together, in about log2(text) steps over arrays, and no list of units is ever made.

The two cut points are drawn from digests of a seed and the row's id, not from the layout. Output: psm is ``<P>prefix<S>suffix<M>middle``,
spm ``<S>suffix<P>prefix<M>middle``; plain texts stay as they are.

Cases: null and empty texts are plain and have no unit; texts with one of the marks are plain, so that every output can be turned
back; rows with a null id draw from the empty text in its place; repeated rows give repeated rows; one very long text is a group of its own; any columns can be kept,
whatever their names, beside the results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import exclusive_sum, groups

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
OTHER, BLANK, STOP, FEED = range(4)
#: Classes that end a unit.
UNITS = {"line": (FEED,), "sentence": (STOP, FEED), "word": (BLANK, FEED)}
_CLASS_OF = np.zeros(128, np.uint8)
_CLASS_OF[[ord(c) for c in " \t"]] = BLANK
_CLASS_OF[[ord(c) for c in ".!?"]] = STOP
_CLASS_OF[ord("\n")] = FEED


class ClassMatrix:
    """Wavelet matrix over four classes: each plane is 64-bit words with the number of ones before each word."""

    def __init__(self, classes: np.ndarray):
        self.size = len(classes)
        self.planes = []
        for bit in (1, 0):
            ones = (classes >> bit) & 1
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(len(packed) // 8 + 2, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = exclusive_sum(np.bitwise_count(words).astype(np.int64))
            self.planes.append((words, before, self.size - int(before[-1])))
            mask = ones.astype(bool)
            classes = np.concatenate([classes[~mask], classes[mask]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, places: np.ndarray) -> np.ndarray:
        at, rest = places >> 6, (places & 63).astype(np.uint64)
        mask = (np.uint64(1) << rest) - np.uint64(1)
        return before[at] + np.bitwise_count(words[at] & mask).astype(np.int64)

    def rank(self, kind: int, places: np.ndarray) -> np.ndarray:
        """How often the class stands before each place."""
        start, end = np.zeros(len(places), np.int64), places.astype(np.int64)
        for bit, (words, before, zeros) in zip((1, 0), self.planes):
            a, b = self._ones(words, before, start), self._ones(words, before, end)
            start, end = (zeros + a, zeros + b) if (kind >> bit) & 1 else (start - a, end - b)
        return end - start

    def boundaries(self, kinds: tuple[int, ...], places: np.ndarray) -> np.ndarray:
        return sum((self.rank(k, places) for k in kinds), np.zeros(len(places), np.int64))

    def after(self, kinds: tuple[int, ...], counts: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Least place in (low, high] with ``counts`` boundaries before it: bisection on ranks, all rows at once."""
        low, high = low.copy(), high.copy()
        for _ in range(int(np.max(high - low, initial=0)).bit_length()):
            middle = (low + high) // 2
            enough = self.boundaries(kinds, middle) >= counts
            high = np.where(enough, middle, high)
            low = np.where(enough, low, np.minimum(middle + 1, high))
        return high


def classes_of(points: np.ndarray) -> np.ndarray:
    return np.where(points < 128, _CLASS_OF[np.minimum(points, 127)], OTHER).astype(np.uint8)


def draws(seed: int, ids: list[object]) -> np.ndarray:
    """Four numbers below 2^32 for each id."""
    digests = b"".join(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(digests, ">u4").reshape(-1, 4).astype(np.int64)


def cuts(texts: list[str], drawn: np.ndarray, unit: str = "line") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of units, end of the prefix, end of the middle) of every text, in code points."""
    kinds = UNITS[unit]
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    starts = exclusive_sum(np.fromiter(map(len, texts), np.int64, len(texts)))
    begin, end = starts[:-1], starts[1:]
    classes = classes_of(points)
    matrix = ClassMatrix(classes)
    passed = matrix.boundaries(kinds, begin)
    whole = matrix.boundaries(kinds, end) - passed
    last = np.zeros(len(texts), np.uint8)
    last[end > begin] = classes[end[end > begin] - 1]
    n = whole + ((end > begin) & ~np.isin(last, kinds))
    ends = []
    for k in np.sort(drawn[:, :2] % (n + 1)[:, None], axis=1).T:
        found = end.copy()
        inner = np.flatnonzero(k <= whole)  # the last unit may have no boundary; it ends with the text
        found[inner] = matrix.after(kinds, passed[inner] + k[inner], begin[inner], end[inner])
        ends.append(found - begin)
    return n, ends[0], ends[1]


def rewrite(text: str, first: int, second: int, spm: bool) -> str:
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if spm:
        return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore(output: str, form: str) -> str:
    """The text that an output was made of. Marks stand in rewritten outputs only where they were put."""
    if form == "plain":
        return output
    head, middle = output.split(MIDDLE)
    if form == "psm":
        prefix, suffix = head[len(PREFIX) :].split(SUFFIX)
    else:
        suffix, prefix = head[len(SUFFIX) :].split(PREFIX)
    return prefix + middle + suffix


_RESULTS = "n long, form string, prefix_chars long, middle_chars long, output string"


def _transformer(kept: int, seed: int, unit: str, rate: int, spm_rate: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in groups(batches):
            texts = [t.decode("utf-8", "replace") for t in raw]
            drawn = draws(seed, batch.column("id").to_pylist())
            n, first, second = cuts(texts, drawn, unit)
            forms, outputs = [], []
            for text, h, a, b in zip(texts, drawn.tolist(), first.tolist(), second.tolist()):
                if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= rate:
                    forms.append("plain")
                    outputs.append(text)
                else:
                    forms.append("spm" if h[3] % 100 < spm_rate else "psm")
                    outputs.append(rewrite(text, a, b, forms[-1] == "spm"))
            form = pa.array(forms, pa.string())
            plain = np.array([f == "plain" for f in forms], bool)
            own = [pa.array(n), form, pa.array(first, mask=plain), pa.array(second - first, mask=plain), pa.array(outputs, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[2 : 2 + kept], *own], names=[*(f"k{i}" for i in range(kept)), "n", "form", "prefix_chars", "middle_chars", "output"])

    return run


def transform(docs: DataFrame, keep: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text", seed: int = 7, unit: str = "line", rate: int = 100, spm_rate: int = 50) -> DataFrame:
    """The columns of ``keep`` with n, form, prefix_chars, middle_chars and output.

    ``rate``: rewritten texts in a hundred; ``spm_rate``: of these, the ones in a hundred whose suffix comes first.
    """
    keep = [id_col] if keep is None else keep
    names = [f"k{i}" for i in range(len(keep))]
    narrow = docs.select(docs[text_col].alias("text"), docs[id_col].cast("string").alias("id"), *[docs[c].alias(n) for c, n in zip(keep, names)])
    carried = ", ".join([*(f"k{i} {narrow.schema[n].dataType.simpleString()}" for i, n in enumerate(names)), _RESULTS])
    results = [p.split()[0] for p in _RESULTS.split(", ")]
    return narrow.mapInArrow(_transformer(len(keep), seed, unit, rate, spm_rate), carried).toDF(*keep, *results)


def restored(outputs: DataFrame) -> DataFrame:
    """The table of ``transform`` with the texts rebuilt from output and form, as ``restored``. The results are its last columns."""
    names = [f"c{i}" for i in range(len(outputs.columns))]
    output, form = names[-1], names[-4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in groups(batches, output):
            texts = [restore(t.decode("utf-8", "replace"), f) for t, f in zip(raw, batch.column(form).to_pylist())]
            yield batch.append_column("restored", pa.array(texts, pa.string()))

    numbered = outputs.toDF(*names)
    return numbered.mapInArrow(run, numbered.withColumn("restored", F.lit("")).schema).toDF(*outputs.columns, "restored")
