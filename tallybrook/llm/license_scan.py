"""License scan by a positional index of rare words (operator 10), DataFrame functions only.

The corpus tells how many files hold each word of the templates; that gives the words' IDF. Of
each template the two rarest words are its index entry. In a file, the positions of these
rare words are looked up, each position less the word's place in the template is where the template
would start, and only starts on which both words agree are checked word by word. Every
place that passes is kept. A label needs all key phrases of its template.

Everything after the IDF is computed within the file's own row: no file's postings are shuffled, so neither a file with a
great many hits nor a word that a third of all files share makes a hot group.

score: the largest share of a template's IDF, over all its phrases, that stands in place; of each phrase counts the best
start that its rarest word gives. 1 for a whole template, 0 if the rarest word of no phrase occurs.

Cases: a null or empty text has no words and score 0; repeated rows and null ids stay; a template word
that no file holds has the largest IDF; an empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

import math
import operator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import ascii_lower

_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    phrases: tuple[str, ...]  # all are needed; the first one gives the places
    base: bool = False


# The phrases that the contract names, then opening words of further licences.
TEMPLATES = (
    Template("gpl", ("gnu general public license",), True),
    Template("apache", ("apache license",), True),
    Template("cc-by", ("cc by",), True),
    Template("mit", ("mit license",), True),
    Template("gpl-3.0", ("gnu general public license version 3",)),
    Template("gpl-2.0", ("gnu general public license version 2",)),
    Template("lgpl", ("gnu lesser general public license",)),
    Template("agpl", ("gnu affero general public license",)),
    Template("apache-2.0", ("apache license version 2 0",)),
    Template("cc-by-sa", ("cc by sa",)),
    Template("cc-by-nc", ("cc by nc",)),
    Template("cc-by-nd", ("cc by nd",)),
    Template("mpl-2.0", ("mozilla public license version 2 0",)),
    Template("mit", ("permission is hereby granted free of charge to any person obtaining a copy", "the software is provided as is")),
    Template("bsd", ("redistribution and use in source and binary forms", "redistributions of source code must retain")),
    Template("isc", ("permission to use copy modify and or distribute this software for any purpose", "the software is provided as is")),
    Template("unlicense", ("this is free and unencumbered software released into the public domain",)),
)


def words_of(text: Column) -> Column:
    """Words of a text, lower-cased; an ending or leading separator leaves an empty first or last element."""
    text = F.coalesce(text, F.lit(""))
    # lower() treats A-Z as asked for; of other letters only the Kelvin sign would turn into one of a-z, and none into a separator
    return F.split(F.when(text.contains("\u212a"), ascii_lower(text)).otherwise(F.lower(text)), _NO_WORD)


def _trimmed(words: Column) -> Column:
    first = (F.get(words, F.lit(0)) == "").cast("int")
    last = ((F.size(words) > 1) & (F.element_at(words, -1) == "")).cast("int")
    return F.slice(words, first + 1, F.greatest(F.size(words) - first - last, F.lit(0)))


def document_frequency(docs: DataFrame, vocabulary: list[str], text_col: str) -> tuple[int, dict[str, int]]:
    """Files, and files that hold each word: counts over all files, as many rows as the templates have words."""
    known = F.array(*map(F.lit, vocabulary))
    held = docs.select(F.explode(F.concat(F.array_intersect(words_of(docs[text_col]), known), F.array(F.lit("")))).alias("word"))
    counts = dict(held.groupBy("word").count().collect())
    return counts.pop("", 0), counts


def _phrase(phrase: str, rarity: dict[str, float]) -> tuple[list[str], list[int]]:
    words = phrase.split()
    order = sorted(range(len(words)), key=lambda j: (-rarity[words[j]], j))
    return words, order


def _shifted(word: str, place: int) -> Column:
    return F.transform(F.filter("hits", lambda h: h["word"] == word), lambda h: h["at"] - place)


def _starts(words: list[str], order: list[int]) -> Column:
    """Starts of a phrase in the row's ``words``, from its two rarest words' positions in ``hits``."""
    found = None
    for j in order[:2]:
        at = _shifted(words[j], j)
        found = at if found is None else F.array_intersect(found, at)
    rest = order[2:]

    def whole(start: Column) -> Column:
        out = F.lit(True)
        for j in rest:
            out = out & F.coalesce(F.get("words", start + j) == words[j], F.lit(False))
        return out

    return F.filter(found, whole) if rest else found


def _aligned(words: list[str], order: list[int], rarity: dict[str, float]) -> Column:
    """Largest IDF of the phrase in place, over the starts that its rarest word gives."""
    j0 = order[0]

    def in_place(h: Column) -> Column:
        out = F.lit(rarity[words[j0]])
        for j in order[1:]:
            out = out + F.when(F.get("words", h["at"] - j0 + j) == words[j], rarity[words[j]]).otherwise(0.0)
        return out

    return F.coalesce(F.array_max(F.transform(F.filter("hits", lambda h: h["word"] == words[j0]), in_place)), F.lit(0.0))


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, places array of (label, start) of the base phrases, base_labels, labels, score)."""
    phrases = sorted({p for t in templates for p in t.phrases})
    vocabulary = sorted({w for p in phrases for w in p.split()})
    files, held = document_frequency(docs, vocabulary, text_col)
    rarity = {w: math.log((files + 1) / (held.get(w, 0) + 0.5)) + 1e-9 for w in vocabulary}
    rarity = {w: max(x, 1e-9) for w, x in rarity.items()}
    parsed = {p: _phrase(p, rarity) for p in phrases}
    rare = sorted({words[j] for words, order in parsed.values() for j in order[:2]})

    cut = docs.select(docs[id_col].alias("id"), words_of(docs[text_col]).alias("cut"))
    worded = cut.select("id", _trimmed(F.col("cut")).alias("words"))
    at = F.filter(F.sequence(F.lit(0), F.size("words")), lambda i: F.coalesce(F.get("words", i).isin(rare), F.lit(False)))
    hits = worded.select("id", "words", F.transform(at, lambda i: F.struct(i.alias("at"), F.get("words", i).alias("word"))).alias("hits"))
    names = {p: f"s{i}" for i, p in enumerate(phrases)}
    aligned = {p: f"a{i}" for i, p in enumerate(phrases)}
    found = hits.select(
        "id",
        F.size("words").cast("long").alias("n_words"),
        *[_starts(*parsed[p]).alias(names[p]) for p in phrases],
        *[_aligned(*parsed[p], rarity).alias(aligned[p]) for p in phrases],
    )

    def has(t: Template) -> Column:
        out = F.lit(True)
        for p in t.phrases:
            out = out & (F.size(names[p]) > 0)
        return out

    def share(t: Template) -> Column:
        total = sum(rarity[w] for p in t.phrases for w in p.split())
        return F.when(has(t), 1.0).otherwise(reduce(operator.add, (F.col(aligned[p]) for p in t.phrases)) / total)

    def labels(chosen: list[Template]) -> Column:
        marked = F.array(*[F.when(has(t), t.label) for t in chosen]) if chosen else F.array().cast("array<string>")
        return F.array_sort(F.array_distinct(F.filter(marked, lambda x: x.isNotNull())))

    base = [t for t in templates if t.base]
    places = [_places(names[t.phrases[0]], t.label) for t in base]
    return found.select(
        F.col("id").alias(id_col),
        "n_words",
        (F.concat(*places) if places else F.array().cast("array<struct<label:string,start:bigint>>")).alias("places"),
        labels(base).alias("base_labels"),
        labels(list(templates)).alias("labels"),
        F.least(F.greatest(*[share(t) for t in templates], F.lit(0.0), F.lit(0.0)), F.lit(1.0)).alias("score"),
    )


def _places(starts: str, label: str) -> Column:
    return F.transform(starts, lambda s: F.struct(F.lit(label).alias("label"), s.cast("long").alias("start")))
