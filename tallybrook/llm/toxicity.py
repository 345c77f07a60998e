"""Toxicity by a weighted finite-state grammar (operator 8).

Words are mapped to classes: insults and threats (learned from labelled texts, as whole words and as stems, each with a weight: the log
odds of its documents; a learned word that mostly follows a modal verb is a threat), and closed classes, listed below: verbs of harm, targets, negations before
and after a word, reporting verbs, subjects, modal verbs and first-person modals. A clause is read by two transducers, each composed once, by the
product of its parts' reachable states:

- from left to right, the pattern transducer turns an insult into a match, and a verb of harm into a threat if a subject and a modal verb (or a first-person modal) stand before it in the
  clause, else into mere harm; the target transducer marks what follows a target, the negation transducer the three words after a negation, the reporting transducer what
  follows a reporting verb;
- from right to left, the same is marked for what stands before a target, within three words before a following negation, or before a reporting verb.

The marks of both are put together: a match is a kind (insult, threat, harm) that is aimed or not, negated or not, reported or not. A
text's score is a logistic function of the weights of its matches, summed by kind and marks; these kinds' weights are learned as well, so that a
negated or reported insult counts for what the labels say, not as an isolated word.

The model is fitted on the driver on a bounded sample of labelled rows: ``SAMPLE_ROWS`` for each label, by a hash
of the id; sampled texts of more than ``SAMPLE_CHARS`` characters are not learned from, the others as a whole. Scoring reads every whole text.

Cases: null and empty texts have no match and get the model's score for that; with no labelled rows every score is 0; null labels are not
learned from, of several labels of a document the largest counts; repeated rows and null ids stay; extra columns are left out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import groups, held_out, lowest_hashes

SAMPLE_ROWS = 2500
SAMPLE_CHARS = 20_000
STEMS = (4, 5, 6)
KEPT_WORDS = 300_000

OTHER, END, INSULT, THREAT, TARGET, NEGATION, AFTER, REPORT, SUBJECT, MODAL, PLEDGE = SYMBOLS = range(11)
# Closed word classes in the four languages of the corpus.
CLOSED = {
    TARGET: "you your yours he him she her they them these those people du dich dir ihr euch sie ihn tu te toi vous il elle ils elles tú usted ustedes él ella ellos ellas",
    NEGATION: "not no never nobody neither nor cannot kein keine keinen niemals ne aucun aucune nunca ningún ninguna",
    AFTER: "nicht nie pas jamais jamás",
    REPORT: "said says say told called calls wrote writes claimed quoted sagte sagt schrieb nannte dit disait écrit appelé dijo dice escribió llamó",
    THREAT: "kill hurt destroy beat attack burn shoot töten schlagen vernichten tuer frapper détruire matar golpear destruir",
    SUBJECT: "i we someone somebody ich wir jemand man je nous on yo nosotros alguien",
    MODAL: "will shall must should going wird werden soll sollte muss va allons devons debe vamos debemos",
    PLEDGE: "gonna werde vais voy",
}
_TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n]")
_END = re.compile(r"[.!?;:\n]")


@dataclass
class Transducer:
    """moves[state][symbol] = (next state, marks put on the symbol)."""

    moves: list[dict[int, tuple[int, tuple[str, ...]]]]

    def compose(self, other: Transducer) -> Transducer:
        """Both read the same word; the marks of both are put on it. Only reachable pairs of states are made."""
        pairs, moves, at = {(0, 0): 0}, [], 0
        order = [(0, 0)]
        while at < len(order):
            a, b = order[at]
            row = {}
            for symbol in SYMBOLS:
                (x, m), (y, n) = self.moves[a][symbol], other.moves[b][symbol]
                if (x, y) not in pairs:
                    pairs[x, y] = len(pairs)
                    order.append((x, y))
                row[symbol] = (pairs[x, y], m + n)
            moves.append(row)
            at += 1
        return Transducer(moves)

    def read(self, symbols: list[int]) -> list[tuple[str, ...]]:
        """The marks put on each symbol."""
        state, out = 0, []
        for symbol in symbols:
            state, marks = self.moves[state][symbol]
            out.append(marks)
        return out


def _machine(states: int, move: Callable[[int, int], tuple[int, tuple[str, ...]]]) -> Transducer:
    return Transducer([{symbol: move(state, symbol) for symbol in SYMBOLS} for state in range(states)])


def _patterns(state: int, symbol: int) -> tuple[int, tuple[str, ...]]:
    """State 1: a subject was read; 2: a modal verb behind it."""
    if symbol == INSULT:
        return state, ("insult",)
    if symbol == THREAT:
        return state, ("threat" if state == 2 else "harm",)
    after = {END: 0, SUBJECT: max(state, 1), MODAL: 2 if state else 0, PLEDGE: 2}.get(symbol, state)
    return after, ()


def _following(kind: int, mark: str) -> Transducer:
    """Marks matches behind a word of the class, to the clause's end."""

    def move(state: int, symbol: int) -> tuple[int, tuple[str, ...]]:
        after = 0 if symbol == END else 1 if symbol == kind else state
        return after, (mark,) if state and symbol in (INSULT, THREAT) else ()

    return _machine(2, move)


def _negating(kinds_: tuple[int, ...]) -> Transducer:
    """Marks matches within three words behind a negation."""

    def move(state: int, symbol: int) -> tuple[int, tuple[str, ...]]:
        after = 0 if symbol == END else 3 if symbol in kinds_ else max(0, state - 1)
        return after, ("negated",) if state and symbol in (INSULT, THREAT) else ()

    return _machine(4, move)


def forward_grammar() -> Transducer:
    return _machine(3, _patterns).compose(_following(TARGET, "aimed")).compose(_negating((NEGATION, AFTER))).compose(_following(REPORT, "reported"))


def backward_grammar() -> Transducer:
    """Reads a clause from its end: what stands before a target, a following negation or a reporting verb."""
    return _following(TARGET, "aimed").compose(_negating((AFTER,))).compose(_following(REPORT, "reported"))


BASES, MARKS = ("insult", "threat", "harm"), ("aimed", "negated", "reported")


def kinds() -> list[tuple[str, ...]]:
    """Every kind of match: what it is, and what is marked on it."""
    return [(base, *(m for i, m in enumerate(MARKS) if n >> i & 1)) for base in BASES for n in range(1 << len(MARKS))]


@dataclass
class Model:
    words: dict[str, float]
    stems: dict[str, float]
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(kinds())))
    bias: float = 0.0
    threats: set[str] = field(default_factory=set)
    closed: dict[str, int] = field(default_factory=lambda: {w: k for k, text in CLOSED.items() for w in text.split()})

    def entry(self, word: str) -> tuple[int, float]:
        """Class and weight of a word. A threat verb has the weight that was learned for it, at least 1."""
        own = max([self.words.get(word, 0.0), *(self.stems.get(word[:n], 0.0) for n in STEMS if len(word) >= n)])
        kind = self.closed.get(word, THREAT if word in self.threats else OTHER)
        if kind == THREAT:
            return THREAT, max(own, 1.0)
        if kind != OTHER:
            return kind, 0.0
        return (INSULT, own) if own > 0 else (END, 0.0) if _END.fullmatch(word) else (OTHER, 0.0)


class Reader:
    """Runs both transducers over the clauses of texts, and remembers the words it has met."""

    def __init__(self, model: Model):
        self.model, self.forward, self.backward = model, forward_grammar(), backward_grammar()
        self.kinds = {k: i for i, k in enumerate(kinds())}
        self.known: dict[str, tuple[int, float]] = {}

    def clauses(self, text: str) -> Iterator[list[tuple[int, float]]]:
        """Classes and weights of the words of each clause with a word that could match."""
        tokens = _TOKEN.findall(text.lower())
        known = self.known
        if len(known) > KEPT_WORDS:
            known.clear()
        for w in set(tokens).difference(known):
            known[w] = self.model.entry(w)
        entries = list(map(known.__getitem__, tokens))
        places = [i for i, e in enumerate(entries) if e[1]]
        done = -1
        for i in places:
            if i < done:
                continue
            start, done = i, i
            while start and entries[start - 1][0] != END:
                start -= 1
            while done < len(entries) and entries[done][0] != END:
                done += 1
            yield entries[start:done]

    def matches(self, text: str) -> np.ndarray:
        """Weights of the text's matches, summed by kind."""
        out = np.zeros(len(self.kinds))
        for clause in self.clauses(text):
            symbols = [kind for kind, _ in clause]
            behind = self.backward.read(symbols[::-1])[::-1]
            for (_, weight), left, right in zip(clause, self.forward.read(symbols), behind):
                if left:
                    out[self.kinds[left[0], *(m for m in MARKS if m in left or m in right)]] += weight
        return out

    def score(self, text: str) -> float:
        x = self.model.bias + float(np.log1p(self.matches(text)) @ self.model.weights)
        return float(1 / (1 + np.exp(-x)))


def _after_modals(rows: list[tuple[str, int]], words: dict[str, float], closed: dict[str, int]) -> set[str]:
    """Of the words those that stand within three words behind a modal verb in half of their places or more, in toxic texts."""
    places, behind = Counter(), Counter()
    for text, label in rows:
        if label:
            tokens, last = _TOKEN.findall(text.lower()), -9
            for i, w in enumerate(tokens):
                if closed.get(w) in (MODAL, PLEDGE):
                    last = i
                elif _END.fullmatch(w):
                    last = -9
                elif w in words:
                    places[w] += 1
                    behind[w] += i - last <= 3
    return {w for w, n in places.items() if 2 * behind[w] >= n}


def _distinct_texts(rows: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """One of each group of near copies, by four minima of word hashes: else a copied text's words would look like a pattern."""
    seen: set[tuple[int, ...]] = set()
    out = []
    for text, label in rows:
        hashes = np.array([zlib.crc32(w.encode()) for w in set(_TOKEN.findall(text.lower()))] or [0], np.uint64)
        minima = tuple(int(((hashes * np.uint64(m)) & np.uint64(0xFFFFFFFF)).min()) for m in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F))
        if (label, *minima) not in seen:
            seen.add((label, *minima))
            out.append((text, label))
    return out


def fit(rows: list[tuple[str, int]]) -> Model | None:
    rows = _distinct_texts(rows)
    totals = Counter(label for _, label in rows)
    if not totals[1] or not totals[0]:
        return None
    words: dict[int, Counter] = {0: Counter(), 1: Counter()}
    stems: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for text, label in rows:
        own = set(re.findall(r"[^\W\d_]+", text.lower()))
        words[label].update(own)
        stems[label].update({w[:n] for w in own for n in STEMS if len(w) > n})
    least = max(3, 0.01 * totals[1])

    def chosen(counts: dict[int, Counter]) -> dict[str, float]:
        odds = {w: np.log((n + 0.5) / (totals[1] + 1)) - np.log((counts[0][w] + 0.5) / (totals[0] + 1)) for w, n in counts[1].items() if n >= least}
        return {w: float(x) for w, x in odds.items() if x >= 2.5}

    closed = Model({}, {}).closed
    learned = {w: x for w, x in chosen(words).items() if closed.get(w, THREAT) == THREAT}
    model = Model(learned, chosen(stems), threats=_after_modals(rows, learned, closed))
    reader = Reader(model)
    x = np.log1p(np.array([reader.matches(text) for text, _ in rows]))
    y = np.array([label for _, label in rows], float)
    # logistic regression by Newton steps with a small penalty
    full = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(full.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        hessian = (full * (p * (1 - p))[:, None]).T @ full + 0.05 * np.eye(len(w))
        w += np.linalg.solve(hessian, full.T @ (y - p) - 0.05 * w)
    model.weights, model.bias = w[:-1], float(w[-1])
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> Model | None:
    """Fit on at most ``rows`` labelled documents of each label outside the held-out fold, of at most ``chars`` characters each."""
    known = labels.select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("label")).filter(~held_out(F.col("id")) & F.col("label").isin(0, 1))
    one = known.groupBy("id").agg(F.max("label").alias("label")).withColumn("hash", F.xxhash64(F.col("id").cast("string")))
    sample = one.join(F.broadcast(lowest_hashes(one, "label", "hash", rows)), ["label", "hash"], "left_semi").select("id", "label")
    texts = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text")).filter(F.char_length("text") <= chars)
    # the sample has at most 2 * rows ids
    found = texts.join(F.broadcast(sample), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    return fit([tuple(r) for r in found.orderBy("id").select("text", "label").collect()])


def score(docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns of ``keep`` with score and predicted."""
    keep = ["doc_id"] if keep is None else keep
    names = [f"k{i}" for i in range(len(keep))]
    narrow = docs.select(docs[text_col].alias("text"), *[docs[c].alias(n) for c, n in zip(keep, names)])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value) if shared.value else None
        for batch, texts in groups(batches):
            found = [reader.score(t.decode("utf-8", "replace")) if reader else 0.0 for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found, pa.float64()), pa.array([int(x >= 0.5) for x in found], pa.int32())], names=[*names, "score", "predicted"])

    schema = narrow.select(*names, F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema
    return narrow.mapInArrow(run, schema).toDF(*keep, "score", "predicted")
