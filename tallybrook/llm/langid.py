"""Language of words and texts by a linear-chain conditional random field (operator 3).

Each word has features: its first and last one to four letters, its letter pairs and triples with word
ends marked, and its lexicon entry (languages in which the training words hold it). A label's score for a word is the sum of the features'
weights; transitions between the labels of neighbouring words are learned too. Training
documents have one label each, so training sequences are made of runs of words from
documents of different languages: that is code-switched text with a known label for every word, from which the transitions are learned.

The model is fitted on the driver on a bounded sample of the labelled rows (``SAMPLE_ROWS`` per language, chosen by a hash of the
id among texts of at most ``SAMPLE_CHARS`` characters; a sampled text is learned from as a whole). Prediction runs forward-backward over every word of every whole text; a
text's label is the one with the largest mean posterior, which is its score.

Cases: text that is null or has no letter is ``und`` with score 0, as is every text if nothing was there to learn from; repeated rows and null ids stay; ties go to the
label that sorts first; very long texts are one sequence, never cut; extra columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import carried, exclusive_sum, groups, held_out, lowest_hashes, mixed

UND = "und"
SAMPLE_ROWS = 250
SAMPLE_CHARS = 6000
BITS = 17
SEQUENCE = 48  # words of a training sequence
ROUNDS = 12
#: Distinct words whose scores a worker keeps; beyond it starts anew.
KEPT_WORDS = 100_000
#: Text whose words a worker labels at once.
GROUP_BYTES = 2 << 20
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def features(words: list[str], lexicon: dict[str, int], languages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words in turn, and how many each word has.

    lexicon: row of each known word; languages: a number for the set of languages that hold the word of that row.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    start = exclusive_sum(lengths + 2)[:-1]
    owner = np.repeat(np.arange(len(words)), lengths + 2)
    offset = np.arange(len(letters)) - start[owner]
    owners, numbers = [], []

    def add(own: np.ndarray, at: np.ndarray, size: int, kind: int) -> None:
        value = np.full(len(at), kind, np.uint64)
        for k in range(size):
            value = value * np.uint64(0x110001) + letters[at + k]
        owners.append(own)
        numbers.append(mixed(value))

    for size in (2, 3):
        at = np.flatnonzero(offset + size <= lengths[owner] + 2)
        add(owner[at], at, size, size)
    for size in range(1, 5):
        own = np.flatnonzero(lengths >= size)
        add(own, start[own] + 1, size, 8 + size)
        add(own, start[own] + 1 + lengths[own] - size, size, 16 + size)
    row = np.fromiter((lexicon.get(w, -1) for w in words), np.int64, len(words))
    own = np.flatnonzero(row >= 0)
    owners += [np.arange(len(words)), own]
    numbers += [mixed(np.where(row >= 0, languages[row] if len(languages) else 0, 0).astype(np.uint64), 1), mixed(row[own].astype(np.uint64), 2)]
    owners, numbers = np.concatenate(owners), np.concatenate(numbers)
    order = np.argsort(owners, kind="stable")
    return (numbers[order] & np.uint64((1 << BITS) - 1)).astype(np.int64), np.bincount(owners, minlength=len(words))


@dataclass
class Model:
    labels: list[str]
    lexicon: dict[str, int]
    languages: np.ndarray
    weights: np.ndarray  # (1 << BITS, labels)
    transitions: np.ndarray  # (labels, labels), from and to
    first: np.ndarray

    def scores(self, words: list[str]) -> np.ndarray:
        """exp of the label scores, the largest being 1."""
        out = []
        for a in range(0, len(words), 20_000):
            flat, sizes = features(words[a : a + 20_000], self.lexicon, self.languages)
            own = np.add.reduceat(self.weights[flat], exclusive_sum(sizes)[:-1], axis=0)
            out.append(np.exp(own - own.max(axis=1, keepdims=True)) + np.float32(1e-12))
        return np.concatenate(out)


def _passes(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """Forward and backward sums over many sequences at once, by step and then by sequence.

    scores: (words, labels), the words of all sequences in turn. Sequences are worked on longest first, so at each
    step the ones still running are a leading block. Returns scores, forward and backward sums, each step's start, and the words' places among them.
    """
    order = np.argsort(-lengths, kind="stable")
    running = lengths[order]
    steps = int(running[0]) if len(running) else 0
    active = np.searchsorted(-running, -np.arange(steps), "left")  # how many are longer than t
    at = exclusive_sum(active)
    begin = exclusive_sum(lengths)[:-1][order]
    place = np.empty(len(scores), np.int64)
    seq = np.repeat(np.arange(len(running)), running)
    t = np.arange(len(scores)) - np.repeat(exclusive_sum(running)[:-1], running)
    place[np.repeat(begin, running) + t] = at[t] + seq
    e = np.empty_like(scores)
    e[place] = scores
    alpha = np.empty_like(e)
    beta = np.ones_like(e)
    move, start = np.exp(transitions - transitions.max()), np.exp(first - first.max())
    move, start = move.astype(e.dtype), start.astype(e.dtype)
    for step in range(steps):
        a, b = at[step], at[step + 1]
        own = start * e[a:b] if step == 0 else (alpha[at[step - 1] : at[step - 1] + b - a] @ move) * e[a:b]
        alpha[a:b] = own / own.sum(axis=1, keepdims=True)
    for step in range(steps - 2, -1, -1):
        a, b = at[step + 1], at[step + 2]
        own = (e[a:b] * beta[a:b]) @ move.T
        beta[at[step] : at[step] + b - a] = own / own.sum(axis=1, keepdims=True)
    return e, alpha, beta, at, place


def posteriors(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The words' label posteriors, by forward-backward."""
    _, alpha, beta, _, place = _passes(scores, lengths, transitions, first)
    both = alpha * beta
    return (both / both.sum(axis=1, keepdims=True))[place]


def expectations(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words' label posteriors, and the expected number of each pair of neighbouring labels.

    A pair's probability is forward sum, transition, score and backward sum, each once, by their sum over all pairs.
    """
    e, alpha, beta, at, place = _passes(scores, lengths, transitions, first)
    move = np.exp(transitions - transitions.max()).astype(e.dtype)
    pairs = np.zeros_like(move)
    for step in range(1, len(at) - 1):
        a, b = at[step], at[step + 1]
        before, after = alpha[at[step - 1] : at[step - 1] + b - a], e[a:b] * beta[a:b]
        total = ((before @ move) * after).sum(axis=1, keepdims=True)
        pairs += (before / total).T @ after
    both = alpha * beta
    return (both / both.sum(axis=1, keepdims=True))[place], pairs * move


def fit(rows: list[tuple[str, str]], rounds: int = ROUNDS, seed: int = 7) -> Model | None:
    """Adaptive gradient steps on the exact log-likelihood gradient, over batches of made-up code-switched sequences."""
    rng = np.random.default_rng(seed)
    labels = sorted({lang for lang, _ in rows})
    docs = [(labels.index(lang), words_of(text)) for lang, text in rows]
    docs = [(y, w) for y, w in docs if w]
    if not docs:
        return None
    held: dict[str, dict[int, int]] = {}
    for y, words in docs:
        for w in set(words):
            held.setdefault(w, {}).setdefault(y, 0)
            held[w][y] += 1
    several = [w for w, by in held.items() if sum(by.values()) > 1]
    lexicon = {w: i for i, w in enumerate(several)}
    # a number for each set of languages: the sum of its languages' own numbers, however many there are
    own_number = [int(x) for x in mixed(np.arange(len(labels)), 5)]
    languages = np.array([sum(own_number[y] for y in held[w]) & 0xFFFFFFFFFFFFFFFF for w in several], np.uint64)
    vocabulary = {w: i for i, w in enumerate(held)}
    flat, sizes = features(list(held), lexicon, languages)
    starts = exclusive_sum(sizes)[:-1]
    runs: list[tuple[int, np.ndarray]] = []  # pieces of 1 to 16 words of one language
    for y, words in docs:
        ids = np.array([vocabulary[w] for w in words], np.int64)
        cuts = np.cumsum(rng.integers(4, 33, len(ids) // 4 + 1))
        runs += [(y, r) for r in np.split(ids, cuts[cuts < len(ids)])]
    n = len(labels)
    weights, g_weights = np.zeros((1 << BITS, n)), np.full((1 << BITS, n), 1e-2)
    moves, g_moves = np.zeros((n, n)), np.full((n, n), 1e-2)
    first, g_first = np.zeros(n), np.full(n, 1e-2)

    def step(x: np.ndarray, g: np.ndarray, gradient: np.ndarray, rate: float) -> None:
        g += gradient * gradient
        x += rate * gradient / np.sqrt(g)

    for round_ in range(rounds):
        order = rng.permutation(len(runs))
        words = np.concatenate([runs[i][1] for i in order])
        truth = np.concatenate([np.full(len(runs[i][1]), runs[i][0]) for i in order])
        for a in range(0, len(words), SEQUENCE * 256):
            w, y = words[a : a + SEQUENCE * 256], truth[a : a + SEQUENCE * 256]
            lengths = np.full(-(-len(w) // SEQUENCE), SEQUENCE, np.int64)
            lengths[-1] = len(w) - lengths[:-1].sum()
            distinct, inverse = np.unique(w, return_inverse=True)
            used = sizes[distinct]
            at = np.repeat(starts[distinct] - exclusive_sum(used)[:-1], used) + np.arange(used.sum())
            own = np.add.reduceat(weights[flat[at]], exclusive_sum(used)[:-1], axis=0)
            scores = np.exp(own - own.max(axis=1, keepdims=True))[inverse] + 1e-12
            p, pairs = expectations(scores, lengths, moves, first)
            error = -p
            error[np.arange(len(y)), y] += 1
            by_word = np.zeros((len(distinct), n))
            np.add.at(by_word, inverse, error)
            gradient = np.zeros_like(weights)
            np.add.at(gradient, flat[at], np.repeat(by_word, used, axis=0))
            # transitions: observed less expected pairs
            heads = exclusive_sum(lengths)[:-1]
            inner = np.ones(len(y), bool)
            inner[heads] = False
            right = np.flatnonzero(inner)
            seen = np.zeros((n, n))
            np.add.at(seen, (y[right - 1], y[right]), 1)
            rate = 0.5 / (1 + round_ / 4)
            step(weights, g_weights, gradient / len(w) * 100 - 1e-4 * weights, rate)
            step(moves, g_moves, (seen - pairs) / len(w) * 10 - 1e-2 * moves, rate / 5)
            start_error = -p[heads].sum(axis=0)
            np.add.at(start_error, y[heads], 1)
            step(first, g_first, start_error / len(heads) - 1e-2 * first, rate / 5)
    return Model(labels, lexicon, languages, weights.astype(np.float32), moves, first)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> Model | None:
    """Fit on ``rows`` rows of every label outside the held-out fold, of texts with at most ``chars`` characters."""
    known = docs.select(docs[lang_col].alias("lang"), docs[text_col].alias("text"), docs[id_col].cast("string").alias("id"))
    known = known.filter(~held_out(F.col("id")) & F.col("lang").isNotNull() & (F.char_length("text") <= chars))
    known = known.select("lang", "text", F.xxhash64("id").alias("hash"))
    last = lowest_hashes(known, "lang", "hash", rows).groupBy("lang").agg(F.max("hash")).collect()
    near = F.lit(False)
    for lang, hash_ in last:
        near = near | ((F.col("lang") == lang) & (F.col("hash") <= hash_))
    sample = known.filter(near).groupBy("lang", "hash").agg(F.min("text").alias("text")).orderBy("lang", "hash").select("lang", "text").collect()
    return fit([tuple(r) for r in sample])


def _predictor(load: Callable[[], Model | None], names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()
        known: dict[str, int] = {}
        table = np.zeros((0, len(model.labels) if model else 1), np.float32)
        for batch, raw in groups(batches, limit=GROUP_BYTES):
            texts = [t.decode("utf-8", "replace") for t in raw]
            words = [words_of(t) if model else [] for t in texts]
            # a run of number signs like superscripts is a "word" too, but no letter
            words = [w if any(x.isalpha() for x in w) or any(c.isalpha() for c in t) else [] for w, t in zip(words, texts)]
            lengths = np.array([len(w) for w in words], np.int64)
            labels, scores = [UND] * len(texts), [0.0] * len(texts)
            if model and lengths.any():
                if len(known) > KEPT_WORDS:
                    known, table = {}, table[:0]
                flat = [x for w in words for x in w]
                new = [w for w in dict.fromkeys(flat) if w not in known]
                if new:
                    known.update(zip(new, range(len(known), len(known) + len(new))))
                    table = np.concatenate([table, model.scores(new).astype(np.float32)])
                index = np.fromiter(map(known.__getitem__, flat), np.int64, len(flat))
                full = np.flatnonzero(lengths)
                p = posteriors(table[index], lengths[full], model.transitions, model.first)
                mean = np.add.reduceat(p.astype(np.float64), exclusive_sum(lengths[full])[:-1], axis=0) / lengths[full][:, None]
                for i, best, value in zip(full.tolist(), mean.argmax(axis=1).tolist(), mean.max(axis=1).tolist()):
                    labels[i], scores[i] = model.labels[best], min(1.0, value)
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(labels, pa.string()), pa.array(scores, pa.float64())], names=[*names, "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns of ``keep`` with lang_pred and score."""
    keep = ["doc_id"] if keep is None else keep
    narrow, names = carried(docs, text_col, keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = narrow.select(*names, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return narrow.mapInArrow(_predictor(lambda: shared.value, names), schema).toDF(*keep, "lang_pred", "score")


def word_labels(text: str, model: Model) -> list[tuple[str, str, float]]:
    """(word, label, posterior) for one text."""
    words = words_of(text)
    if not words:
        return []
    p = posteriors(model.scores(words).astype(np.float32), np.array([len(words)]), model.transitions, model.first)
    return [(w, model.labels[i], float(row[i])) for w, row, i in zip(words, p, p.argmax(axis=1))]
