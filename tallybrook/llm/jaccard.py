"""Exact Jaccard join of word n-gram sets by universe partitions (operator 6).

Sets with equal content are one class, which only its smallest document stands for. Class sizes fall into bands such that sets that can
link lie in the same or in neighbouring bands. For the pairs whose smaller set is in band k there is scheme k: a pair that links differs in
at most H(k) shingles. The universe of shingles is dealt by hash to segments; segment i tolerates t(i) = 0 or 1 differences, and the tolerances
plus one add up to H(k) + 1 + slack(k). So for a pair that links, segments worth at least slack + 1 agree within their tolerance. Which
segments tolerate one difference is chosen for each band by cost: the rows to be shuffled, against the candidates that small segments bring.

A set's row for a segment is the hash of what it has there; where one difference is tolerated, there is a row more for every way of
leaving one shingle out. Equal rows make candidates:

- a key that at most ``FULL`` sets share gives all their pairs;
- a fuller key gives only the pairs of its first set with the others (linear), and is noted for its sets. In a group of near copies
  these pairs already connect the group. A set that has noted and poor segments (with fewer shingles than tolerance plus one) worth at most
  its slack has lost nothing, by the count above. A set whose poor segments alone are worth more has rows for them, but its partner may have
  none, so it counts them as lost, too;
- sets that have lost more than that are joined once more among themselves, by their rarest shingles: of two that link, both hold one
  of the other's ``size - least overlap + 1`` rarest, where a common passage does not count. Pairs within a component are not made.

A candidate that shares keys of a scheme worth less than slack + 1, counting all that its set has lost, cannot link. Nor can two sets whose parity
sketches differ in more bits than two sets that link may differ in shingles: a bit tells whether the shingles dealt to it are odd in number, so each
shingle that only one set has changes one bit at most. Every other candidate is verified on the shingles themselves. Nothing is capped, sampled or dropped. Keys that are already full
within one group of texts do not meet in one task: their further sets go to the shuffle as finished pairs, spread evenly.

Cases: null text and text without words have no set and link with nothing; fewer words than n are one shingle; repeated rows and equal texts
are one class; a row without an id is a component of its own with a null id; extra columns are left out; empty tables are fine.
"""

from __future__ import annotations

import hashlib
import math
import operator
import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import drop_shuffles, exclusive_sum, give_back, groups, likely_among, mixed, shuffle_width, stage
from tallybrook.llm.components import components

WORDS = 4
PERCENT = 85
#: More sets than this on one key are linked through the first of them.
FULL = 24
#: Text that a worker turns into shingles at once, and pairs and notes that it holds at once: both become many Python objects.
TEXT_BYTES, HELD_ROWS = 1 << 20, 100_000
#: Longs of a parity sketch, 64 bits each.
SKETCH = [f"s{i}" for i in range(8)]
_ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))


def words_of(text: bytes) -> list[bytes]:
    """ASCII letters in lower case, cut at ASCII white space."""
    return text.lower().split()


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of every text's n-word shingles."""
    split = [words_of(t) for t in texts]
    flat = [w for words in split for w in words]
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, flat), np.uint64, len(flat))
    padded = np.append(hashes, np.zeros(n, np.uint64))
    rolled = np.zeros(len(flat), np.uint64)
    for k in range(n):
        rolled += padded[k : k + len(flat)] * _ODD[k % len(_ODD)] * np.uint64(2 * (k // len(_ODD)) + 1)
    rolled = mixed(rolled)
    out, start = [], 0
    for words in split:
        size = len(words)
        if 0 < size < n:
            short = hashlib.blake2b(b" ".join(words), digest_size=8, person=b"short").digest()
            out.append(np.frombuffer(short, np.uint64))
        else:
            out.append(np.unique(rolled[start : start + max(0, size - n + 1)]))
        start += size
    return out


def _digest(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def _sketch(own: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles dealt to each bit."""
    bits = 64 * len(SKETCH)
    dealt = np.bincount((mixed(own, 14) % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits((dealt & 1).astype(np.uint8)).view(np.int64)


def _may_link(left: list[str], right: list[str], x: str, y: str, percent: int) -> Column:
    """Whether sketches of sets of x and y shingles are near enough; true where one is null."""
    bits = reduce(operator.add, (F.bit_count(F.col(a).bitwiseXOR(F.col(b))) for a, b in zip(left, right)))
    return F.coalesce((100 + percent) * bits <= (100 - percent) * (F.col(x) + F.col(y)), F.lit(True))


def _sketch_as(prefix: str) -> list[Column]:
    return [F.col(c).alias(prefix + c) for c in SKETCH]


class Bands:
    """Sizes of band k: first[k] to first[k + 1] - 1."""

    def __init__(self, percent: int):
        self.percent = percent
        self.first = [1]
        while self.first[-1] < 1 << 40:
            b = self.first[-1]
            self.first.append(max(b + 1, -(-100 * b // percent)))

    def of(self, size: int) -> int:
        return int(np.searchsorted(self.first, size, "right")) - 1

    def most_differences(self, band: int) -> int:
        return (100 - self.percent) * (self.first[band + 1] - 1) // self.percent


class Scheme:
    """Segments of one band: the first ``ones`` of them tolerate a difference."""

    def __init__(self, zeros: int, ones: int, slack: int):
        self.segments, self.ones, self.slack = zeros + ones, ones, slack


def allocate(most: int, size: float, sets: int) -> Scheme | None:
    """Cheapest tolerances for sets of about ``size`` shingles among ``sets`` others. None: only equal sets can link."""
    if most == 0:
        return None
    slack = 1 + most // 24
    need, best = most + 1 + slack, None
    for ones in sorted({0, need // 8, need // 4, need // 2, (need + 1) // 2}):
        zeros = max(0, need - 2 * ones)
        mean = size / (zeros + ones)
        rows = zeros + ones * (1 + mean)
        # a segment of one or two shingles, and what is left of it, is likely to be shared by unrelated sets
        small = math.exp(-mean) * (zeros * (mean + mean**2 / 2) + ones * (mean + mean**2 / 2 + mean**3 / 6) * (1 + mean))
        # each such row can be shared by many sets, but a key brings at most FULL / 2 pairs a row: rows stay in proportion at every size
        cost = rows + min(1e-4 * sets, FULL / 2) * small
        if best is None or cost < best[0]:
            best = (cost, Scheme(zeros, ones, slack))
    return best[1]


_KEYS = "key long, node long, meta long, hub long"
_KEYS_ARROW = pa.schema([(c, pa.int64()) for c in ("key", "node", "meta", "hub")])
# meta: scheme, segment, and two flags: the set is of the scheme's own band; the row is the whole segment
_OWN, _WHOLE, _NOTED = 1, 2, 4


def meta_of(scheme: int, segment: np.ndarray, flags: np.ndarray | int) -> np.ndarray:
    return (np.int64(scheme) << 48) | (segment.astype(np.int64) << 3) | flags


def keys_of_set(own: np.ndarray, k: int, scheme: Scheme, is_own: bool) -> tuple[np.ndarray, np.ndarray, int]:
    """(keys, metas, budget of the poor segments) of one set in scheme k. A partner may have no row for a poor segment, though this set has one."""
    segment = (mixed(own, 11) % np.uint64(scheme.segments)).astype(np.int64)
    value = mixed(own, 12)
    sums = np.zeros(scheme.segments, np.uint64)
    np.add.at(sums, segment, value)
    size = np.bincount(segment, minlength=scheme.segments)
    every = np.arange(scheme.segments)
    budget = 1 + (every < scheme.ones)
    poor = size < budget
    missing = int(budget[poor].sum())
    sparse = missing > scheme.slack  # then it has rows for empty segments as well
    shown = every if sparse else np.flatnonzero(size)
    flag = _OWN if is_own else 0
    salt = mixed(every.astype(np.uint64) + np.uint64(k << 32), 13)
    keys, metas = [mixed(sums[shown] + salt[shown])], [meta_of(k, shown, flag | _WHOLE)]
    loose = np.flatnonzero((segment < scheme.ones) & ((size[segment] > 1) | sparse))
    if len(loose):
        at = segment[loose]
        keys.append(mixed(sums[at] - value[loose] + salt[at]))
        metas.append(meta_of(k, at, flag))
    return np.concatenate(keys), np.concatenate(metas), missing


def _key_rows(n: int, bands: Bands, schemes: dict[int, Scheme | None]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # 16 bytes for each class of this task's input
        for _, texts in groups(batches, limit=TEXT_BYTES):
            keys, nodes, metas = [], [], []
            for own in shingle_sets(texts, n):
                digest = _digest(own)
                if not len(own) or digest in seen:
                    continue
                seen.add(digest)
                band, node = bands.of(len(own)), int.from_bytes(digest[:8], "little", signed=True)
                for k in (band - 1, band):
                    if schemes.get(k):
                        key, meta, missing = keys_of_set(own, k, schemes[k], k == band)
                        if missing:  # told once, to be added to the noted segments of the set
                            key = np.append(key, np.uint64(0))
                            meta = np.append(meta, meta_of(k, np.array([missing]), 0))
                        keys.append(key)
                        metas.append(meta)
                        nodes.append(np.full(len(key), node, np.int64))
            if not keys:
                continue
            key, node, meta = np.concatenate(keys).view(np.int64), np.concatenate(nodes), np.concatenate(metas)
            order = np.lexsort((node, key))
            key, node, meta = key[order], node[order], meta[order]
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            sizes = np.diff(np.append(starts, len(key)))
            full = (np.repeat(sizes, sizes) > FULL) & (key != 0)
            head = np.zeros(len(key), bool)
            head[starts] = True
            meta = np.where(full, meta | _NOTED, meta)
            hub = pa.array(np.repeat(node[starts], sizes), mask=~(full & ~head))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(node), pa.array(meta), hub], schema=_KEYS_ARROW)

    return run


_FOUND = "kind int, a long, b long, meta long"
_FOUND_ARROW = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("meta", pa.int64())])
_PAIR, _NOTE, _MISSING = 0, 1, 2


def _candidates(ones: dict[int, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    return lambda batches: _read_keys(batches, ones)


def _read_keys(batches: Iterator[pa.RecordBatch], ones: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """Read rows sorted by key and node. Keeps at most FULL + 1 rows of a key; a pair comes with what the shared segments are worth."""
    held: list[tuple[int, int]] = []  # (node, meta) of the key at hand
    at, hub, noted = None, None, False
    pairs: dict[tuple[int, int, int], int] = {}
    notes: list[tuple[int, int, int]] = []

    def spill() -> None:
        nonlocal hub, noted
        if not noted:
            noted, hub = True, held[0]
            notes.append((held[0][0], at, held[0][1]))
        for node, meta in held:
            if node != hub[0]:
                add(hub, (node, meta))
                notes.append((node, at, meta))
        held.clear()

    def add(x: tuple[int, int], y: tuple[int, int]) -> None:
        # one of the pair is of the scheme's own band, and one has the whole segment
        if (x[1] | y[1]) & _OWN and (x[1] | y[1]) & _WHOLE and x[0] != y[0]:
            pair(x[0], y[0], x[1])

    def pair(x: int, y: int, meta: int) -> None:
        scheme = meta >> 48
        at = (x, y, scheme) if x < y else (y, x, scheme)
        pairs[at] = pairs.get(at, 0) + (2 if (meta & ((1 << 48) - 1)) >> 3 < ones[scheme] else 1)

    def close() -> None:
        nonlocal hub, noted
        if noted:
            spill()
        else:
            for i, x in enumerate(held):
                for y in held[i + 1 :]:
                    add(x, y)
        held.clear()
        hub, noted = None, False

    def out(missing: list[tuple[int, int]]) -> pa.RecordBatch:
        rows = [(_PAIR, x, y, (k << 48) | n) for (x, y, k), n in pairs.items()] + [(_NOTE, x, y, m) for x, y, m in notes] + [(_MISSING, x, 0, m) for x, m in missing]
        pairs.clear()
        notes.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else ([],) * 4, _FOUND_ARROW)], schema=_FOUND_ARROW)

    for batch in batches:
        key, node, meta = (batch.column(c).to_numpy() for c in ("key", "node", "meta"))
        hubs = batch.column("hub")
        told = key == 0
        missing = list(zip(node[told].tolist(), meta[told].tolist()))
        ready = hubs.is_valid().to_numpy(zero_copy_only=False)
        for x, k, m, h in zip(node[ready].tolist(), key[ready].tolist(), meta[ready].tolist(), hubs.drop_null().to_pylist()):
            pair(x, h, m)
            notes.append((x, k, m))
        rest = ~told & ~ready
        key, node, meta = key[rest], node[rest], meta[rest]
        # rows alone with their key, away from the batch's ends, need no further look
        new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
        alone = new & np.append(new[1:], False)
        if len(alone):
            alone[0] = alone[-1] = False
        for k, x, m, single in zip(key.tolist(), node.tolist(), meta.tolist(), alone.tolist()):
            if k != at:
                close()
                at = k
                if len(pairs) + len(notes) > HELD_ROWS:
                    yield out([])
            if single:
                continue
            if held and held[-1][0] == x:
                held[-1] = (x, held[-1][1] | m)
            else:
                held.append((x, m))
            if m & _NOTED or len(held) > FULL:
                spill()
        if len(pairs) + len(notes) + len(missing) > 20_000 or missing:
            yield out(missing)
    close()
    yield out([])
    give_back()


def _zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A text is shuffled with each of its pairs, so it travels compressed."""
    for batch, texts in groups(batches):
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([zlib.compress(t, 1) for t in texts], pa.binary())], names=["id", "zipped"])


def _verifier(n: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Compare the shingles themselves: words become numbers, and shingles rows of numbers."""

    def shingles(words: list[bytes]) -> set[tuple[bytes, ...]]:
        return {tuple(words)} if 0 < len(words) < n else set(zip(*(words[k:] for k in range(n))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[bytes | None, set] = (None, set())
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
                if last[0] != left:
                    last = (left, shingles(words_of(zlib.decompress(left))))
                x, y = last[1], shingles(words_of(zlib.decompress(right)))
                both = len(x & y)
                keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("u"), kept.column("v")], names=["u", "v"])
        last = (None, set())
        give_back()

    return run


def _verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Of (a, b) classes, the (u, v) representatives that link."""
    left = classes.select(F.col("node").alias("a"), F.col("rep").alias("u"), F.col("n_shingles").alias("x"), *_sketch_as("x"))
    right = classes.select(F.col("node").alias("b"), F.col("rep").alias("v"), F.col("n_shingles").alias("y"), *_sketch_as("y"))
    sized = pairs.join(left, "a").join(right, "b").filter(F.col("u") != F.col("v"))
    near = F.lit(percent) * F.greatest("x", "y") <= F.lit(100) * F.least("x", "y")
    near = near & _may_link([f"x{c}" for c in SKETCH], [f"y{c}" for c in SKETCH], "x", "y", percent)
    wanted = stage(sized.filter(near).select("u", "v"))
    ids = wanted.select(F.col("u").alias("id")).unionAll(wanted.select(F.col("v").alias("id"))).distinct()
    zipped = likely_among(texts.select("id", "text"), "id", ids, _zipped, "id long, zipped binary")
    used = stage(zipped.join(ids, "id", "left_semi").groupBy("id").agg(F.first("zipped").alias("zipped")))
    full = wanted.join(used.withColumnRenamed("id", "u").withColumnRenamed("zipped", "left"), "u")
    full = full.join(used.withColumnRenamed("id", "v").withColumnRenamed("zipped", "right"), "v").select("u", "v", "left", "right")
    linked = stage(full.mapInArrow(_verifier(n, percent), "u long, v long"))
    del full, used, ids, sized
    drop_shuffles(texts.sparkSession)
    return linked


def _by_rare_shingles(sets: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """(a, b) of ``sets`` (rep, node, top, n_shingles, sketch) in different components that share one of their rarest shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, own in groups(batches, limit=TEXT_BYTES):
            found = shingle_sets(own, n)
            sizes = np.array([len(s) for s in found], np.int64)
            at = np.repeat(np.arange(len(found)), sizes)
            flat = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("node").take(pa.array(at)), pa.array(flat)], names=["node", "shingle"])

    named = sets.select(F.col("rep").alias("id"), "node")
    used = likely_among(texts, "id", named.select("id")).join(named, "id").groupBy("id", "node").agg(F.first("text").alias("text"))
    held = stage(used.select("node", "text").mapInArrow(run, "node long, shingle long"))
    common = held.groupBy("shingle").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    # a shingle of one set makes no pair, but takes a place among the rarest
    order = Window.partitionBy("node").orderBy(F.coalesce("n", F.lit(1)), "shingle")
    ranked = held.join(common, "shingle", "left").withColumn("place", F.row_number().over(order))
    last = F.col("n_shingles") - F.ceil(F.lit(percent) * F.col("n_shingles") / 100) + 1
    rare = ranked.filter(F.col("n") > 1).join(sets, "node").filter(F.col("place") <= last).select("shingle", "node", "top", "place", F.col("n_shingles").alias("size"), *SKETCH)
    rare = stage(rare)
    # were this the first shingle that two sets share, so many could still follow; it is for one of the rows of a pair that links.
    # Asked first of a component's sets with the shingle together (the longest rest, the smallest set), then of a set and a component, then
    # of two sets. Sketches are asked wherever a side is a single set; several sets together have none
    of_one = [F.when(F.count("*") == 1, F.first(c)).alias(c) for c in SKETCH]
    tops = rare.groupBy("shingle", "top").agg(F.max(F.col("size") - F.col("place")).alias("s"), F.min("size").alias("z"), *of_one)

    def able(rest: str, other_rest: str, size: str, other_size: str) -> Column:
        return (100 + percent) * (F.least(rest, other_rest) + 1) >= percent * (F.col(size) + F.col(other_size))

    of_other, of_left, of_right = ([prefix + c for c in SKETCH] for prefix in "olr")
    others = tops.select("shingle", F.col("top").alias("other"), F.col("s").alias("t"), F.col("z").alias("w"), *_sketch_as("o"))
    two = tops.join(others, "shingle").filter((F.col("top") < F.col("other")) & able("s", "t", "z", "w") & _may_link(SKETCH, of_other, "z", "w", percent))
    two = two.select("shingle", "top", "other", "t", "w", *of_other)
    left = rare.select("shingle", "top", F.col("node").alias("a"), (F.col("size") - F.col("place")).alias("i"), F.col("size").alias("x"), *_sketch_as("l"))
    right = rare.select("shingle", F.col("top").alias("other"), F.col("node").alias("b"), (F.col("size") - F.col("place")).alias("j"), F.col("size").alias("y"), *_sketch_as("r"))
    one = two.join(left, ["shingle", "top"]).filter(able("i", "t", "x", "w") & _may_link(of_left, of_other, "x", "w", percent)).drop(*of_other)
    both = one.join(right, ["shingle", "other"]).filter(able("i", "j", "x", "y") & _may_link(of_left, of_right, "x", "y", percent))
    return stage(both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _classes(narrow: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """(id, n_shingles, digest) of each row, and (digest, node, rep, n_shingles, sketch) of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in groups(batches, limit=TEXT_BYTES):
            sets = shingle_sets(texts, n)
            digests = [_digest(s) if len(s) else None for s in sets]
            nodes = [int.from_bytes(d[:8], "little", signed=True) if d else None for d in digests]
            sketches = np.array([_sketch(s) for s in sets], np.int64).reshape(-1, len(SKETCH)).T
            columns = [batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(nodes, pa.int64()), *map(pa.array, sketches)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_shingles", "digest", "node", *SKETCH])

    rows = stage(narrow.mapInArrow(run, "id long, n_shingles long, digest binary, node long, " + ", ".join(f"{c} long" for c in SKETCH)))
    known = rows.filter(F.col("digest").isNotNull() & F.col("id").isNotNull())
    return rows, known.groupBy("digest").agg(F.min("id").alias("rep"), *[F.first(c).alias(c) for c in ("node", "n_shingles", *SKETCH)])


def link(docs: DataFrame, n: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) for every row."""
    spark = docs.sparkSession
    narrow = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    rows, classes = _classes(narrow, n)
    classes = stage(classes)
    bands = Bands(percent)
    first = F.array(*[F.lit(b) for b in bands.first])
    # as many rows as there are bands of sizes
    sizes = classes.groupBy(F.size(F.filter(first, lambda b: b <= F.col("n_shingles"))).alias("band")).agg(F.count("*"), F.avg("n_shingles")).collect()
    counts = {r[0] - 1: (r[1], r[2]) for r in sizes}
    schemes: dict[int, Scheme | None] = {}
    for k in counts.keys() | {k - 1 for k in counts if k}:
        near = [counts[j] for j in (k, k + 1) if j in counts]
        schemes[k] = allocate(bands.most_differences(k), near[0][1], sum(c for c, _ in near))

    keyed = narrow.select("text").mapInArrow(_key_rows(n, bands, schemes), _KEYS)
    home = F.when(F.col("hub").isNull() & (F.col("key") != 0), F.col("key")).otherwise(F.col("node"))
    sorted_ = keyed.repartition(shuffle_width(spark), home).sortWithinPartitions("key", "node")
    found = stage(sorted_.mapInArrow(_candidates({k: s.ones for k, s in schemes.items() if s}), _FOUND))
    del keyed, sorted_
    drop_shuffles(spark)
    # what each set has lost in full and empty segments
    scheme = F.shiftright("meta", 48)
    rest = F.col("meta").bitwiseAND(F.lit((1 << 48) - 1))
    ones = F.coalesce(*[F.when(F.col("scheme") == k, s.ones) for k, s in schemes.items() if s], F.lit(0))
    slack = F.coalesce(*[F.when(F.col("scheme") == k, s.slack) for k, s in schemes.items() if s], F.lit(0))
    noted = found.filter(F.col("kind") != _PAIR).select("kind", "a", scheme.alias("scheme"), rest.bitwiseAND(F.lit(-8)).alias("segment")).distinct()
    segment = F.shiftright("segment", 3)
    worth = F.when(F.col("kind") == _MISSING, segment).when(segment < ones, 2).otherwise(1)
    lost = stage(noted.groupBy("a", "scheme").agg(F.sum(worth).alias("lost")))

    shared = found.filter(F.col("kind") == _PAIR).groupBy("a", "b", scheme.alias("scheme")).agg(F.sum(rest).alias("shared"))
    enough = shared.join(lost, ["a", "scheme"], "left").filter(F.col("shared") + F.coalesce("lost", F.lit(0)) > slack)
    edges = _verified(enough.select("a", "b").distinct(), classes, narrow, n, percent)
    joined = components(edges)

    poor = lost.filter(F.col("lost") > slack).select(F.col("a").alias("node")).distinct()
    of_class = classes.join(joined.select(F.col("u").alias("rep"), F.col("v").alias("top")), "rep", "left").withColumn("top", F.coalesce("top", "rep"))
    more = _by_rare_shingles(stage(of_class.join(poor, "node", "left_semi").select("rep", "node", "top", "n_shingles", *SKETCH)), narrow, n, percent)
    if not more.isEmpty():
        edges = edges.unionAll(_verified(more, classes, narrow, n, percent))
        joined = components(edges)

    tops = classes.join(joined.select(F.col("u").alias("rep"), F.col("v").alias("top")), "rep", "left").select("digest", F.coalesce("top", "rep").alias("top"))
    out = rows.join(tops, "digest", "left")
    return out.select(F.col("id").alias(id_col), "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("top", "id")).alias("component_id"))
