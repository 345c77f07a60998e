"""Phrases by a weighted de Bruijn graph (operator 11).

Nodes are phrases of ``words - 1`` words, edges phrases of ``words`` words: an edge leads from its first words to its last ones, and its weight is how often
it occurs. Only edges are counted in the texts, and the ends of pieces: the last words of every piece, which no edge starts with. Everything
shorter follows from the graph, level by level: a phrase occurs as often as all the phrases that continue it by a word (the flow out of
its node), and as often as a piece ends with it.

A node with as much flow as one edge into it and as one edge out of it has no other edges, and no piece starts or ends there: paths over such
nodes are compacted to one row with one weight. A node inside a path is in an edge that is as frequent, so it is no candidate of its own, and it lends
its edges its count without a look-up; only the ends of paths look theirs up.

Scoring: a phrase cut after k words scores a * a / (l * r), in decimals of 38 digits; the lowest cut counts. A shorter candidate is left out if
one that contains it is at least half as frequent.

Work: each task makes the graph of a few megabytes of text before anything is moved, so a hot passage or word travels once for each such group. Words are
dealt by their hash, edges by the hash of the node they leave, where its flow is added up. A node with more than ``FULL`` times a bucket's share of a group's edges would be hot: its
edges are dealt by their own hashes instead, and only its flow goes to the node. Where that has happened in some groups and not in others, an edge's counts from both
places are added up at the end. All travel as packed blocks, one for each group and bucket: words once, numbers for the rest. Rows per language are cut to the first ``top`` in each task before they meet.

Cases: null texts have no words; a null language is ``und``; empty languages have no rows; repeated rows count as often as they stand; ties go to the smaller phrase in byte
order; words are any bytes between blanks and tabs; extra columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import exclusive_sum, give_back, groups, mixed, shuffle_width, stage
from tallybrook.llm.distinct import pack, pack_planes, unpack, unpack_planes

WORDS, LEAST, TOP = 3, 10, 2000
#: Text whose graph a task makes at once.
GROUP_BYTES = 4 << 20
#: Entries that a task holds of its buckets before it adds up equal ones.
HELD = 2_000_000
#: Shares of a bucket that a node's edges may take in a group.
FULL = 4
LEAST_FULL = 64
_BREAKS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)
_BLOCK = "bucket int, sizes array<long>, lengths binary, words binary, ids binary, counts binary"
_BLOCK_ARROW = pa.schema([("bucket", pa.int32()), ("sizes", pa.list_(pa.int64())), ("lengths", pa.binary()), ("words", pa.binary()), ("ids", pa.binary()), ("counts", pa.binary())])
_COUNTS = "lang string, size int, gram string, n long, part boolean"
_COUNTS_ARROW = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("gram", pa.string()), ("n", pa.int64()), ("part", pa.bool_())])


def pieces_of(text: bytes) -> list[list[bytes]]:
    """Words of every piece that has one; A-Z in lower case."""
    return [words for piece in text.lower().translate(_BREAKS).split(b"\n") if (words := piece.split())]


def coded(numbers: np.ndarray, base: int) -> np.ndarray:
    """One number for each row of word numbers below ``base``; equal rows, equal numbers."""
    code = numbers[:, 0].astype(np.int64)
    for j in range(1, numbers.shape[1]):
        if j > 1 and base ** (j + 1) >= 1 << 62:  # numbers of the rows so far instead of their codes: no code passes 64 bits
            code = np.unique(code, return_inverse=True)[1]
        code = code * base + numbers[:, j]
    return code


def added(numbers: np.ndarray, counts: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Different rows with the sums of their counts, in the order of their codes."""
    if not len(counts):
        return numbers, counts
    _, first, back = np.unique(coded(numbers, base), return_index=True, return_inverse=True)
    sums = np.zeros(len(first), np.int64)
    np.add.at(sums, back, counts)
    return numbers[first], sums


def count_grams(pieces: list[list[bytes]], size: int) -> tuple[list[bytes], list[tuple[np.ndarray, np.ndarray]]]:
    """Vocabulary, and for 1 to ``size`` words: (word numbers of different phrases, their counts).

    Of ``size`` words every phrase is counted, of fewer only those that end a piece.
    """
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    flat = list(chain.from_iterable(pieces))
    number = {w: i for i, w in enumerate(sorted(set(flat)))}  # in order, which packs better
    ids = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
    ends = np.cumsum(lengths)
    left = np.repeat(ends, lengths) - np.arange(len(flat))  # words from here to the end of the piece, this one included
    out = []
    for k in range(1, size + 1):
        at = np.flatnonzero(left >= k if k == size else left == k)
        out.append(added(ids[at[:, None] + np.arange(k)], np.ones(len(at), np.int64), max(1, len(number))))
    return list(number), out


def flows(found: list[tuple[np.ndarray, np.ndarray]], base: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Counts of all phrases of 1 to ``size`` words from ``count_grams``: a phrase's continuations and the pieces that end with it."""
    out = [found[-1]]
    for numbers, counts in reversed(found[:-1]):
        longer, more = out[0]
        out.insert(0, added(np.concatenate([numbers, longer[:, : numbers.shape[1]]]), np.concatenate([counts, more]), base))
    return out


def _levels(found: list[tuple[np.ndarray, np.ndarray]], base: int, most: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """What a group sends of ``count_grams``: counts of shorter phrases, nodes that end pieces, edges, and of nodes with more than ``most`` edges the flow and the edges apart."""
    shorter = flows(found, base)[:-2]
    edges, n = found[-1]
    # edges lie in the order of their codes, so those of a node are neighbours
    new = np.ones(len(n), bool)
    new[1:] = (edges[1:, :-1] != edges[:-1, :-1]).any(axis=1)
    degree = np.diff(np.append(np.flatnonzero(new), len(n)))
    full = np.repeat(degree > most, degree)
    return [*shorter, found[-2], (edges[~full], n[~full]), added(edges[full][:, :-1], n[full], base), (edges[full], n[full])]


def _blocks(size: int, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of each group of texts, dealt by hash. A word is its language, a line feed and the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in groups(batches, limit=GROUP_BYTES):
            by_lang: dict[str, list[list[bytes]]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), texts):
                by_lang.setdefault(lang, []).extend(pieces_of(text))
            vocabulary: list[bytes] = []
            levels: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(size + 2)]
            most = max(LEAST_FULL, FULL * sum(map(len, texts)) / 6 / buckets)
            for lang, pieces in by_lang.items():
                words, found = count_grams(pieces, size)
                pieces.clear()
                for level, (numbers, counts) in zip(levels, _levels(found, max(1, len(words)), most)):
                    level.append((numbers + len(vocabulary), counts))
                vocabulary += [lang.encode() + b"\n" + w for w in words]
            if not vocabulary:
                continue
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, vocabulary), np.uint64, len(vocabulary))
            every, cuts = [], []
            for k, level in enumerate(levels):
                numbers, counts = (np.concatenate(x) for x in zip(*level))
                dealt = np.zeros(len(counts), np.uint64)
                for column in numbers.T if k != size - 1 else numbers.T[:-1]:  # edges by the node they leave
                    dealt = mixed(dealt + hashes[column])
                home = (dealt % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(home, kind="stable")
                every.append((numbers[order], counts[order]))
                cuts.append(np.searchsorted(home[order], np.arange(buckets + 1)))
            rows = []
            for b in range(buckets):
                own = [(numbers[c[b] : c[b + 1]], counts[c[b] : c[b + 1]]) for (numbers, counts), c in zip(every, cuts)]
                used, ids = np.unique(np.concatenate([n.T.ravel() for n, _ in own]), return_inverse=True)
                if len(used):
                    words = [vocabulary[i] for i in used.tolist()]
                    lengths = np.fromiter(map(len, words), np.uint32, len(words))
                    rows.append((b, [len(c) for _, c in own], pack(lengths), pack(b"".join(words)), pack_planes(ids.astype(np.uint32)), pack(np.concatenate([c for _, c in own]))))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _BLOCK_ARROW)], schema=_BLOCK_ARROW)

    return run


def _added_up(size: int, least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums over the blocks of a task's buckets: frequent phrases, and all words of a language together as a phrase of no words.

    ``part``: the phrase is an edge of a node that was full somewhere, and may have another row.
    """
    widths = [*range(1, size + 1), size - 1, size]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[bytes, int] = {}
        held: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros((0, k), np.uint32), np.zeros(0, np.int64)) for k in widths]
        new: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in widths]
        base = lambda: max(1, len(number))

        def add_up() -> None:
            for k in range(len(widths)):
                numbers, counts = (np.concatenate(x) for x in zip(held[k], *new[k]))
                held[k] = added(numbers, counts, base())
                new[k].clear()

        waiting = 0
        for batch in batches:
            for sizes, lengths, words, ids, counts in zip(*(batch.column(c).to_pylist() for c in ("sizes", "lengths", "words", "ids", "counts"))):
                ends, raw = exclusive_sum(unpack(lengths, np.uint32)).tolist(), unpack(words)
                own = np.array([number.setdefault(raw[a:b], len(number)) for a, b in zip(ends, ends[1:])], np.uint32)
                flat, n, at, done = own[unpack_planes(ids)], unpack(counts, np.int64), 0, 0
                for k, (m, width) in enumerate(zip(sizes, widths)):
                    new[k].append((flat[at : at + m * width].reshape(width, m).T, n[done : done + m]))
                    at, done = at + m * width, done + m
                waiting += done
            if waiting > HELD + sum(len(c) for _, c in held) // 2:
                add_up()
                waiting = 0
        if not number:
            return
        add_up()
        langs, words = zip(*(w.rsplit(b"\n", 1) for w in number))
        words, langs = pa.array(words, pa.binary()).cast(pa.string()), pa.array(langs, pa.binary()).cast(pa.string())
        totals: dict[str, int] = {}
        for lang, n in zip(langs.take(pa.array(held[0][0][:, 0])).to_pylist(), held[0][1].tolist()):
            totals[lang] = totals.get(lang, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*[(lang, 0, "", n, False) for lang, n in totals.items()]) if totals else ((),) * 5, _COUNTS_ARROW)], schema=_COUNTS_ARROW)
        (ends, end_n), (edges, n), (full, full_n), (apart, apart_n) = held[-4:]
        nodes = added(np.concatenate([ends, edges[:, :-1], full]), np.concatenate([end_n, n, full_n]), base())
        # of a node that was full somewhere, edges lie elsewhere as well
        both = coded(np.concatenate([full, edges[:, :-1]]), base())
        part = np.isin(both[len(full) :], both[: len(full)])
        kept = [(x, c, c >= least, np.zeros(len(c), bool)) for x, c in [*held[: size - 2], nodes]]
        kept += [(edges, n, part | (n >= least), part), (apart, apart_n, np.ones(len(apart_n), bool), np.ones(len(apart_n), bool))]
        for numbers, counts, wanted, parts in kept:
            found = np.flatnonzero(wanted)
            for chosen in np.array_split(found, len(found) // 50_000 + 1):
                grams = pc.binary_join_element_wise(*[words.take(pa.array(c)) for c in numbers[chosen].T], " ")
                size_of = pa.array(np.full(len(chosen), numbers.shape[1], np.int32))
                yield pa.RecordBatch.from_arrays([langs.take(pa.array(numbers[chosen][:, 0])), size_of, grams, pa.array(counts[chosen]), pa.array(parts[chosen])], schema=_COUNTS_ARROW)
        number.clear()
        held.clear()
        give_back()

    return run


def _head(size: int) -> Column:
    """The first words of a phrase of ``size`` words."""
    return F.substring_index("gram", " ", size - 1)


def _tail(size: int) -> Column:
    return F.substring_index("gram", " ", 1 - size)


def graph(docs: DataFrame, words: int = WORDS, least: int = LEAST, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, size, gram, n): phrases of 1 to ``words`` words found at least ``least`` times; rows of size 0 add up to all words of a language."""
    buckets = shuffle_width(docs.sparkSession)
    narrow = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"), docs[text_col].alias("text"))
    blocks = narrow.mapInArrow(_blocks(words, buckets), _BLOCK)
    rows = stage(blocks.repartitionById(buckets, F.col("bucket")).mapInArrow(_added_up(words, least), _COUNTS))
    parts = rows.filter("part").groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return rows.filter("not part").drop("part").unionAll(parts)


def _with_out(counts: DataFrame, words: int) -> DataFrame:
    """(lang, node, n, out): frequent nodes with the largest weight of an edge that leaves them, 0 if none is frequent."""
    largest = counts.filter(F.col("size") == words).groupBy("lang", _head(words).alias("gram")).agg(F.max("n").alias("out"))
    nodes = counts.filter(F.col("size") == words - 1).join(largest, ["lang", "gram"], "left")
    return nodes.select("lang", F.col("gram").alias("node"), "n", F.coalesce("out", F.lit(0)).alias("out"))


def paths(counts: DataFrame, words: int = WORDS) -> DataFrame:
    """(lang, phrase, n) of compacted paths: every frequent edge lies on one of them, an edge without unary nodes on its own.

    Paths are found by doubling: every unary node asks the furthest node before it that it knows, about log2(longest path) times.
    """
    edges = counts.filter(F.col("size") == words).select("lang", "gram", _head(words).alias("head"), _tail(words).alias("tail"), "n")
    nodes = _with_out(counts, words).filter(F.col("n") == F.col("out")).select("lang", "node", F.col("n").alias("flow"))
    into = edges.select("lang", F.col("tail").alias("node"), F.col("n").alias("flow"), F.substring_index("gram", " ", 1).alias("before"), F.col("head").alias("back"))
    out = edges.select("lang", F.col("head").alias("node"), F.col("n").alias("flow"), F.substring_index("gram", " ", -1).alias("after"))
    unary = stage(nodes.join(into, ["lang", "node", "flow"]).join(out, ["lang", "node", "flow"]))
    # at: the node furthest back that is known, a number of steps away; done: no unary node comes before it
    state = unary.select("lang", "node", "back", F.col("node").alias("at"), F.lit(0).alias("steps"))
    known = unary.select("lang", F.col("node").alias("back"), F.lit(True).alias("known"))
    state = state.join(known, ["lang", "back"], "left").select("lang", "node", F.coalesce(F.when(F.col("known"), F.col("back")), F.col("at")).alias("at"), F.when(F.col("known"), 1).otherwise(0).alias("steps"))
    state = stage(state)
    while True:
        further = state.filter("steps > 0").select("lang", F.col("node").alias("at"), F.col("at").alias("to"), F.col("steps").alias("more"))
        if further.isEmpty():
            break
        grown = state.join(further, ["lang", "at"], "left").select("lang", "node", F.coalesce("to", "at").alias("at"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"))
        grown = stage(grown)
        moved = grown.agg(F.sum("steps")).first()[0] != state.agg(F.sum("steps")).first()[0]
        state = grown
        if not moved:
            break
    # a path is as long as a piece at most
    placed = unary.join(state, ["lang", "node"]).select("lang", "at", "flow", F.struct("steps", "before", "node", "after").alias("step"))
    chains = placed.groupBy("lang", "at", "flow").agg(F.sort_array(F.collect_list("step")).alias("chain"))
    last = F.element_at("chain", -1)
    inner = F.concat_ws(" ", F.element_at("chain", 1)["before"], F.element_at("chain", 1)["node"], F.transform(F.slice("chain", 2, F.greatest(F.size("chain") - 1, F.lit(0))), lambda s: F.substring_index(s["node"], " ", -1)), last["after"])
    compact = chains.select("lang", inner.alias("phrase"), F.col("flow").alias("n"))
    own = unary.select("lang", "node")
    alone = edges.join(own.withColumnRenamed("node", "head"), ["lang", "head"], "left_anti").join(own.withColumnRenamed("node", "tail"), ["lang", "tail"], "left_anti")
    return stage(compact.unionAll(alone.select("lang", F.col("gram").alias("phrase"), "n")))


def _cut(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (l * r)), exact for counts below 10^15: whole decimals, divided without a fraction."""
    wide = "decimal(15,0)"
    top = a.cast(wide) * a.cast(wide) * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", top, left.cast(wide) * right.cast(wide))


def scored(counts: DataFrame, words: int = WORDS) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of 2 and 3 words that no longer one takes the place of."""
    if words != 3:
        raise ValueError("phrases are scored from a graph of three words")
    by_path = paths(counts, words)
    single = counts.filter("size = 1").select("lang", "gram", F.col("n").alias("f"))
    pairs = _with_out(counts, words).select("lang", F.col("node").alias("gram"), F.col("n").alias("f"), "out")
    # edges along the paths; the inner nodes of a path have the path's count
    split = by_path.withColumn("w", F.split("phrase", " ")).select("lang", "n", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 2)).alias("i"))
    word = lambda j: F.element_at("w", F.col("i") + j)
    edges = split.select(
        "lang", F.col("n").alias("a"), word(0).alias("w1"), word(2).alias("w3"),
        F.concat_ws(" ", word(0), word(1)).alias("head"), F.concat_ws(" ", word(1), word(2)).alias("tail"),
        F.when(F.col("i") > 1, F.col("n")).alias("head_f"), F.when(F.col("i") < F.size("w") - 2, F.col("n")).alias("tail_f"),
    )
    edges = stage(edges)

    def looked_up(rows: DataFrame, of: str) -> DataFrame:
        """Rows with the count of one node; only those at the end of a path are asked for."""
        count = f"{of}_f"
        ends = rows.filter(F.col(count).isNull()).join(pairs.select("lang", F.col("gram").alias(of), "f"), ["lang", of]).withColumn(count, F.col("f")).drop("f")
        return rows.filter(F.col(count).isNotNull()).unionByName(ends)

    full = looked_up(looked_up(edges, "head"), "tail")
    full = full.join(single.select("lang", F.col("gram").alias("w1"), F.col("f").alias("f1")), ["lang", "w1"]).join(single.select("lang", F.col("gram").alias("w3"), F.col("f").alias("f3")), ["lang", "w3"])
    # (score, k, l, r): the least counts
    cuts = F.least(F.struct(_cut(F.col("a"), F.col("f1"), F.col("tail_f")).alias("score"), F.lit(1).alias("k"), F.col("f1").alias("l"), F.col("tail_f").alias("r")), F.struct(_cut(F.col("a"), F.col("head_f"), F.col("f3")).alias("score"), F.lit(2).alias("k"), F.col("head_f").alias("l"), F.col("f3").alias("r")))
    three = full.select("lang", F.concat_ws(" ", "head", "w3").alias("phrase"), "a", cuts.alias("c")).select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    # a node inside a path is in an edge as frequent; of the others, the largest edge in or out decides
    largest_in = edges.groupBy("lang", F.col("tail").alias("gram")).agg(F.max("a").alias("into"))
    open_nodes = pairs.filter(2 * F.col("out") < F.col("f")).join(largest_in, ["lang", "gram"], "left").filter(F.col("into").isNull() | (2 * F.col("into") < F.col("f")))
    nodes = open_nodes.select("lang", F.col("gram").alias("phrase"), F.col("f").alias("a"), F.substring_index("gram", " ", 1).alias("w1"), F.substring_index("gram", " ", -1).alias("w2"))
    nodes = nodes.join(single.select("lang", F.col("gram").alias("w1"), F.col("f").alias("l")), ["lang", "w1"]).join(single.select("lang", F.col("gram").alias("w2"), F.col("f").alias("r")), ["lang", "w2"])
    two = nodes.select("lang", "phrase", "a", "l", "r", _cut(F.col("a"), F.col("l"), F.col("r")).alias("score"))
    return three.unionAll(two)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of every language."""
    counts = stage(graph(docs, WORDS, least, text_col, lang_col))
    totals = counts.filter("size = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored(counts).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
