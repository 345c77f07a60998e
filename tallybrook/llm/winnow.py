"""Document fingerprints by winnowing (operator 12).

A text's k-grams of code points are hashed by a rolling sum (powers of an odd base, modulo 2^64) and mixed to 32 bits. Of every
``WINDOW`` neighbouring k-grams the one with the least hash is chosen, of equal ones the rightmost; a place chosen
by several windows counts once. So any passage of ``GRAM + WINDOW - 1`` code points that two texts share gives both the same hash, at places that
differ by the passages' offset: that is why places are kept. A text with fewer k-grams than a window is one window; a text of fewer code points than a
k-gram is one gram. Empty texts have no fingerprint.

``fingerprint`` is the base64 form of the hashes and then their places, 32-bit little-endian numbers. The likeness of two fingerprints is
the number of hashes they share, by that of all their different hashes; of two empty ones it is 1.

Edited texts: the end of a text is replaced by the beginning of the next document. Documents are dealt to ranges of ids, so a row
meets the next id in its own task. What a range needs of the one above, its first text, is looked up for all ranges at once. An id that fills several
ranges is dealt over them by place of input; all of its rows need the same next text.

Cases: null texts are empty; of several rows of the next id the one with the least text (in byte order) counts; after the last id comes the first; rows without
an id are nobody's next, and the first id is theirs; without any id the next text is empty. Extra columns are left out; empty tables are fine.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import groups, mixed, shuffle_width

GRAM, WINDOW = 8, 16
#: Windows that are worked on at once, so that a very long text takes bounded memory.
CHUNK = 1 << 19
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def gram_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """32-bit hashes of all k-grams, rolled: a sum of powers up to a gram's end, less the one up to its start, shifted back."""
    n = len(points) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(points)), out=sums[1:])
    rolled = (sums[k:] - sums[:n]) * _powers(_INVERSE, n)
    return mixed(rolled) >> np.uint64(32)


def _least(keys: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w neighbours, by doubling."""
    width = 1
    while 2 * width <= w:
        keys = np.minimum(keys[: len(keys) - width], keys[width:])
        width *= 2
    rest = w - width
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys


def winnow(points: np.ndarray, k: int = GRAM, w: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places) chosen from the code points of one text, by place."""
    if not len(points):
        return np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    k = min(k, len(points))
    grams = len(points) - k + 1
    w = min(w, grams)
    low, found = np.uint64(0xFFFFFFFF), []
    for start in range(0, grams - w + 1, CHUNK):
        stop = min(start + CHUNK, grams - w + 1)  # windows start..stop-1
        hashes = gram_hashes(points[start : stop + w - 1 + k - 1], k)
        places = np.arange(start, start + len(hashes), dtype=np.uint64)
        least = _least((hashes << np.uint64(32)) | (low - places), w)
        found.append(least[np.append(True, least[1:] != least[:-1])])
    keys = np.concatenate(found)
    keys = keys[np.append(True, keys[1:] != keys[:-1])]
    return (keys >> np.uint64(32)).astype(np.uint32), (low - (keys & low)).astype(np.uint32)


def pack(hashes: np.ndarray, places: np.ndarray) -> str:
    return base64.b64encode(hashes.astype("<u4").tobytes() + places.astype("<u4").tobytes()).decode()


def unpack(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(base64.b64decode(fingerprint), "<u4")
    return numbers[: len(numbers) // 2], numbers[len(numbers) // 2 :]


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    """Of two sorted arrays of different hashes."""
    if not len(left) and not len(right):
        return 1.0
    both = len(np.intersect1d(left, right, assume_unique=True))
    return both / (len(left) + len(right) - both)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def edited_text(text: str, following: str) -> str:
    """The last quarter of a text, in code points, replaced by as many of the next one's first."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """(id, n_chars, fingerprint) of every row; nothing is moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in groups(batches):
            texts = [t.decode("utf-8", "replace") for t in raw]
            packed = [pack(*winnow(_points(t), k, w)) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(map(len, texts), pa.int64()), pa.array(packed, pa.string())], names=["id", "n_chars", "fingerprint"])

    narrow = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return narrow.mapInArrow(run, f"id {narrow.schema['id'].dataType.simpleString()}, n_chars long, fingerprint string").withColumnRenamed("id", id_col)


class Ranges:
    """Consecutive ranges of ids: an id that fills several quantiles is a range of its own, the ids between two such are another.

    ``first[r]`` is the least id of range r; ``share[r]`` how many tasks its rows are dealt to.
    """

    def __init__(self, ids: DataFrame, n: int):
        wanted = [i / n for i in range(1, n)]
        quantiles = ids.agg(F.percentile_approx("id", F.array(*map(F.lit, wanted)), 20 * n)).first()[0] if wanted else []
        self.bounds = sorted(set(quantiles or []))
        times = [quantiles.count(b) for b in self.bounds]
        # range 2i + 1 is an id with several quantiles, range 2i the ids from bound i - 1 up to bound i
        self.hot = {b: t for b, t in zip(self.bounds, times) if t > 1}
        least = ids.filter("id is not null").groupBy(self.of(F.col("id")).alias("r")).agg(F.min("id")).collect()
        self.first = dict(sorted(map(tuple, least)))
        self.share = {2 * i + 1: t for i, (b, t) in enumerate(zip(self.bounds, times)) if t > 1}
        self.next = dict(zip(self.first, [*list(self.first.values())[1:], next(iter(self.first.values()), None)]))

    def of(self, own: Column) -> Column:
        """Number of the range of an id: twice the number of smaller bounds, one more if it is a bound that fills a range. By bisection."""
        if not self.bounds:
            return F.lit(0)
        held = F.array(*map(F.lit, self.bounds))
        steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(self.bounds).bit_length()))])
        below = F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.coalesce(F.get(held, at + s - 1) < own, F.lit(False)), at + s).otherwise(at))
        return 2 * below + (own.isin(*self.hot) if self.hot else F.lit(False)).cast("int")


_EDITED = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row."""
    spark = docs.sparkSession
    narrow = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    tasks = shuffle_width(spark)
    ranges = Ranges(narrow.select("id"), tasks)
    wanted = {r: i for r, i in ranges.next.items()}
    nothing = -1  # the range of rows without an id
    wanted[nothing] = next(iter(ranges.first.values()), None)

    # the first text of every range, for the range below: as many rows as there are ranges
    heads = narrow.filter(F.col("id").isin(*set(wanted.values()) - {None})).groupBy("id").agg(F.min("text").alias("text"))
    shares = [(r, i, s) for r, i in wanted.items() for s in range(tasks if r == nothing else ranges.share.get(r, 1))]
    guests = spark.createDataFrame(shares, "r int, id long, s int").join(heads, "id").select("r", "s", F.lit(True).alias("guest"), "id", "text")
    split = F.coalesce(*[F.when(F.col("r") == r, n) for r, n in {**ranges.share, nothing: tasks}.items()], F.lit(1))
    dealt = narrow.withColumn("r", F.when(F.col("id").isNull(), nothing).otherwise(ranges.of(F.col("id"))))
    dealt = dealt.withColumn("s", F.pmod(F.monotonically_increasing_id(), split).cast("int")).select("r", "s", F.lit(False).alias("guest"), "id", "text")
    # neighbouring ranges, and the parts of a range, go to different tasks
    rows = dealt.unionAll(guests).repartitionById(tasks, F.pmod(F.floor(F.col("r") / 2) + F.col("s"), F.lit(tasks)).cast("int"))
    # from the largest id down, the guest of a range before all others: each row follows the id it needs
    rows = rows.sortWithinPartitions("r", "s", F.desc("guest"), F.desc("id"))
    return rows.mapInArrow(lambda batches: _edit(batches, k, w), _EDITED).withColumnRenamed("id", id_col)


def _edit(batches: Iterator[pa.RecordBatch], k: int, w: int) -> Iterator[pa.RecordBatch]:
    at, own, least, above = None, None, "", ""  # range; id at hand, its least text, least text of the id above
    marks = last = ("", np.zeros(0, np.uint32))  # texts with their fingerprint hashes: the text above, the row before
    for batch, raw in groups(batches):
        out = []
        for r, s, guest, i, t in zip(*(batch.column(c).to_pylist() for c in ("r", "s", "guest", "id")), raw):
            text = t.decode("utf-8", "replace")
            if (r, s) != at:
                at, own, least, above = (r, s), None, "", ""
            if guest:
                above = text
                continue
            if own is not None and i != own:
                above = least
            least = text if own is None or i != own else min(least, text)  # code points sort as their UTF-8 bytes do
            own = i
            hashes, places = winnow(_points(text), k, w)
            edited = edited_text(text, above)
            edited_hashes, edited_places = winnow(_points(edited), k, w)
            if marks[0] != above:
                marks = last if last[0] == above else (above, np.unique(winnow(_points(above), k, w)[0]))
            mine = np.unique(hashes)
            last = (text, mine)
            digest = hashlib.sha256(edited.encode()).hexdigest()
            near = likeness(mine, np.unique(edited_hashes)), likeness(mine, marks[1])
            out.append((i, len(text), digest, pack(hashes, places), pack(edited_hashes, edited_places), *near))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        columns = list(zip(*out)) or [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=[c.split()[0] for c in _EDITED.split(", ")])
