"""Number of tokens by count-only Viterbi (operator 4).

An Aho-Corasick automaton over the pieces of a unigram vocabulary enumerates all matches that end at a place; dynamic programming
carries the best score and its number of pieces, and no pieces. Tie rules are the tokenizer's: starts are tried from
left to right and a later one must be strictly better, so of equal scores the longest last piece wins; a character that is no piece by itself may be
unknown, for the least score less 10; unknown characters are byte pieces if the vocabulary has them, else a run of them is one token.

Spaces become the word mark, and one mark is put before a text. Where no piece holds a mark after another character, every best path has a boundary
before each run of marks, so texts are cut there and each distinct word is counted once (see ``distinct``); with any other vocabulary a whole text is one word.
Scores of words add up; the sums are exact for scores that are whole numbers, as here.

Cases: null and empty texts have 0 tokens; ids, nulls and repeated rows stay, one row out per row in; a word of any length is one piece of work,
linear in its matches; an empty vocabulary makes all characters unknown; extra columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallybrook.llm.distinct import through_distinct

MARK = "▁"
UNKNOWN_PENALTY = 10.0


def read_vocabulary(path: str) -> tuple[list[tuple[str, float]], bool]:
    """Ordinary pieces with scores, and whether bytes stand for unknown characters."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    pieces = [(model.id_to_piece(i), model.get_score(i)) for i in ids if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
    return pieces, any(model.is_byte(i) for i in ids)


def counter(pieces: list[tuple[str, float]], bytes_for_unknown: bool) -> Callable[[str], tuple[int, float]]:
    """(pieces, score) of the best path of a marked text."""
    automaton = ahocorasick.Automaton()
    for piece, score in pieces:
        automaton.add_word(piece, (len(piece), score))
    if pieces:
        automaton.make_automaton()
    singles = {p for p, _ in pieces if len(p) == 1}
    unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY

    def count(text: str) -> tuple[int, float]:
        n = len(text)
        score, number, lost = [0.0] + [None] * n, [0] * (n + 1), [False] * (n + 1)
        matches = automaton.iter(text) if pieces else iter(())
        match = next(matches, None)
        for end in range(1, n + 1):
            best = None
            while match is not None and match[0] + 1 == end:  # the longest comes first
                size, own = match[1]
                at = score[end - size] + own
                if best is None or at > best:
                    best, number[end] = at, number[end - size] + 1
                match = next(matches, None)
            if text[end - 1] not in singles:
                at = score[end - 1] + unknown
                if best is None or at > best:
                    best = at
                    more = len(text[end - 1].encode()) if bytes_for_unknown else int(not lost[end - 1])
                    number[end], lost[end] = number[end - 1] + more, True
            score[end] = best
        return number[n], score[n]

    return count


def token_counts(docs: DataFrame, pieces: list[tuple[str, float]], bytes_for_unknown: bool, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, score)."""
    shared = docs.sparkSession.sparkContext.broadcast((pieces, bytes_for_unknown))  # as large as the vocabulary
    crossing = any(re.search(f"[^{MARK}]{MARK}", p) for p, _ in pieces)
    unit = re.compile(f"{MARK}+[^{MARK}]*")

    def cut(text: str) -> list[str]:
        marked = (MARK + text.replace(" ", MARK)) if text else ""
        return [marked] if crossing and marked else unit.findall(marked)

    def make() -> Callable[[bytes], list[int]]:
        count = counter(*shared.value)

        def work(word: bytes) -> list[int]:
            number, score = count(word.decode())
            return [number, *np.array([score], "<f8").view("<u4").tolist()]

        return work

    def combine(numbers: np.ndarray, ends: np.ndarray) -> list[dict]:
        each = np.ascontiguousarray(numbers.astype("<u4", copy=False)).reshape(-1, 3)
        counts = np.append(0, np.cumsum(each[:, 0].astype(np.int64)))
        scores = np.ascontiguousarray(each[:, 1:]).view("<f8").ravel()
        return [{"n_tokens": int(counts[b // 3] - counts[a // 3]), "score": float(scores[a // 3 : b // 3].sum())} for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    kind = pa.struct([("n_tokens", pa.int64()), ("score", pa.float64())])
    out = through_distinct(docs, id_col, text_col, cut, make, combine, "struct<n_tokens:bigint,score:double>", kind)
    return out.select(id_col, "value.n_tokens", "value.score")
