"""The pipeline, and the queries without SQL, against plain Python versions on a small input."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tallybrook.llm import bpe, langid, license_scan, repetition, token_counts, toxicity
from tallybrook.llm.catalog import PIECES, QUERIES, RANKS

SF = "/root/testdata/sf0.001"
SPACE = "\x20\x09-\x0D"


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def held_out(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """(folder, rows of documents, rows of the benchmark)"""
    folder = str(tmp_path_factory.mktemp("small"))
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("size(split(text, ' ')) < 900")
    rows = [tuple(r) for r in docs.orderBy("doc_id").collect()]
    long = [r for r in rows if 60 < len((r[1] or "").split()) < 300]
    more = [rows[3], rows[3], (None, *long[0][1:]), (None, *long[0][1:])]
    for i, r in enumerate(long[:12]):  # near copies, some of them of each other
        words = r[1].split()
        words[len(words) // 2 : len(words) // 2 + i % 4] = [f"changed{i}"] * (i % 4)
        more.append((9000 - i, " ".join(words), *r[2:]))
    benchmark = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    passage = next(t for _, t in benchmark if len(t.split()) > 20)
    more += [(9100 + i, t, "en", "s", 0) for i, t in enumerate([None, "", "one two", "One  two", "the MIT License, cc by; apache license", passage, "\n".join(["the same line again"] * 9)])]
    rows += more
    spark.createDataFrame(rows, docs.schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return folder, rows, benchmark


def plain_language(text, model):
    """(label, score): forward-backward word by word in double precision."""
    words = langid.words_of(text or "")
    if not words or not any(c.isalpha() for c in text):
        return langid.UND, 0.0
    scores = []
    for w in words:
        flat, _ = langid.features([w], model.lexicon, model.languages)
        own = model.weights[flat].astype(float).sum(axis=0)
        scores.append(np.exp(own - own.max()) + 1e-12)
    move, ahead, back = np.exp(model.transitions), [np.exp(model.first) * scores[0]], [np.ones(len(model.labels))]
    for e in scores[1:]:
        ahead.append(ahead[-1] / ahead[-1].sum() @ move * e)
    for e in scores[:0:-1]:
        back.append(move @ (e * back[-1] / back[-1].sum()))
    each = np.array([a * b / (a * b).sum() for a, b in zip(ahead, back[::-1])])
    mean = each.mean(axis=0)
    return model.labels[int(mean.argmax())], float(mean.max())


def plain_repetition(text):
    text = text or ""
    words = re.findall(f"[^{SPACE}]+", text)
    out = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text))}
    for n in (5, 8, 10):
        grams = [tuple(words[k : k + n]) for k in range(len(words) - n + 1)]
        times = Counter(grams)
        inside = {k + j for k, g in enumerate(grams) if times[g] > 1 for j in range(n)}
        out |= {f"repeat_words_{n}": len(inside), f"repeat_chars_{n}": sum(len(words[k]) for k in inside)}
    lines = [x for x in text.split("\n") if re.search(f"[^{SPACE}]", x)]
    again = [x for i, x in enumerate(lines) if x in lines[:i]]
    out |= {"n_dup_lines": len(again), "dup_line_chars": sum(len(x.strip(" \t\n\v\f\r")) for x in again)}
    out["base_failed"] = len(words) < 10 or 100 * out["repeat_words_5"] > 20 * len(words)
    limits = {5: 0.25, 8: 0.20, 10: 0.15}
    over = any(out[f"repeat_chars_{n}"] > x * out["word_chars"] for n, x in limits.items()) or out["dup_line_chars"] > 0.30 * out["word_chars"]
    return out | {"kept": not out["base_failed"] and not over}


def plain_components(rows, n, percent):
    """Per row (shingles, component) of (id, text) rows; equal ids have equal texts."""

    def shingles(text):
        words = re.findall(f"[^{SPACE}]+", lowered(text))
        return frozenset([tuple(words)]) if 0 < len(words) < n else frozenset(zip(*(words[k:] for k in range(n))))

    sets = [shingles(text) for _, text in rows]
    top = {i: i for i, _ in rows if i is not None}
    for (a, x), (b, y) in itertools.combinations([(i, s) for (i, _), s in zip(rows, sets) if i is not None and s], 2):
        both = len(x & y)
        if both and 100 * both >= percent * len(x | y):
            low, high = sorted((top[a], top[b]))
            top = {k: low if v == high else v for k, v in top.items()}
    return [(len(s), None if i is None else top[i]) for (i, _), s in zip(rows, sets)]


def plain_contaminated(text, benchmark):
    words, hit = alnum_words(text), set()
    places = {}
    for n in range(1, 14):
        for k in range(len(words) - n + 1):
            places.setdefault(tuple(words[k : k + n]), []).append(k)
    for _, phrase in benchmark:
        own = alnum_words(phrase)
        n = min(13, len(own))
        for k in range(len(own) - n + 1) if own else ():
            for at in places.get(tuple(own[k : k + n]), ()):
                hit.update(range(at, at + n))
    return len(hit) > 0 and 20 * len(hit) >= len(words)


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def plain_tokens(text):
    """(n_tokens, ids, ids_sha256, decoded_sha256)"""
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    ids = library.encode_ordinary(text or "")
    packed = np.array(ids, "<u4").tobytes()
    return len(ids), packed, hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_pipeline_keeps_the_documents_that_plain_stages_keep(spark, small):
    folder, rows, benchmark = small
    model = langid.train(spark.read.parquet(f"{folder}/documents.parquet"))
    sizes = [len(rows)]
    judged = {text: plain_language(text, model) for text in {r[1] for r in rows}}
    assert all(abs(score - 0.3) > 1e-3 for _, score in judged.values())
    rows = [r for r in rows if judged[r[1]][0] != "und" and judged[r[1]][1] >= 0.3]
    sizes.append(len(rows))
    rows = [r for r in rows if plain_repetition(r[1])["kept"]]
    sizes.append(len(rows))
    found = plain_components([r[:2] for r in rows], 5, 80)
    named = {r for r, (_, component) in zip(rows, found) if r[0] is not None and r[0] == component}
    rows = [*named, *(r for r in rows if r[0] is None)]
    sizes.append(len(rows))
    rows = [r for r in rows if not plain_contaminated(r[1], benchmark)]
    sizes.append(len(rows))
    assert all(a > b > 20 for a, b in zip(sizes, sizes[1:])), sizes  # every stage has something to drop
    got = Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, folder).collect())
    assert got == Counter((r[0], *plain_tokens(r[1])) for r in rows)


def test_op1_and_op5(spark, small):
    folder, rows, _ = small
    want = Counter((r[0], *(plain_tokens(r[1])[i] for i in (0, 2, 3))) for r in rows)
    assert Counter(map(tuple, QUERIES["op1_bpe"](spark, folder).collect())) == want
    got = QUERIES["op5_repetition"](spark, folder)
    assert sorted(repetition.LIMITS) == [5, 8, 10]
    want = Counter((r[0], *((plain := plain_repetition(r[1]))["repeat_words_5" if c == "n_repeat_words" else c] for c in got.columns[1:])) for r in rows)
    assert Counter(map(tuple, got.collect())) == want


def test_op3_and_op8(spark, small):
    folder, rows, _ = small
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = Counter((r[0], r[1]) for r in rows)
    by_id = {i: text for i, text in texts}
    model = langid.train(docs)
    got = QUERIES["op3_language"](spark, folder).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    for r in got:
        label, score = plain_language(by_id[r.doc_id], model)
        assert (r.held_out, r.lang_pred, r.score) == (held_out(r.doc_id), label, pytest.approx(score, abs=1e-3))

    model = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    kinds = toxicity.kinds()

    def toxic(text):
        """Clause by clause, by looking around each match."""
        sums = dict.fromkeys(kinds, 0.0)
        for clause in re.split(r"[.!?;:\n]", (text or "").lower()):
            entries = [model.entry(w) for w in re.findall(r"[^\W\d_]+", clause)]
            classes = [kind for kind, _ in entries]
            for i, (kind, weight) in enumerate(entries):
                if kind not in (toxicity.INSULT, toxicity.THREAT):
                    continue
                before, after = classes[:i], classes[i + 1 :]
                subject = before.index(toxicity.SUBJECT) if toxicity.SUBJECT in before else i
                pledged = toxicity.PLEDGE in before or toxicity.MODAL in before[subject:]
                base = "insult" if kind == toxicity.INSULT else "threat" if pledged else "harm"
                negated = {toxicity.NEGATION, toxicity.AFTER} & set(before[-3:]) or toxicity.AFTER in after[:3]
                marks = [("aimed", toxicity.TARGET in before + after), ("negated", negated), ("reported", toxicity.REPORT in before + after)]
                sums[base, *(m for m, there in marks if there)] += weight
        return 1 / (1 + math.exp(-model.bias - sum(math.log1p(sums[k]) * w for k, w in zip(kinds, model.weights))))

    got = QUERIES["op8_toxicity"](spark, folder).collect()
    assert model and Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert len({round(r.score, 6) for r in got}) > 1
    for r in got:
        score = toxic(by_id[r.doc_id])
        assert (r.held_out, r.score, r.predicted) == (held_out(r.doc_id), pytest.approx(score, abs=1e-9), int(score >= 0.5))


def test_op4(spark, small):
    folder, rows, _ = small
    pieces, by_bytes = token_counts.read_vocabulary(PIECES)
    scores, longest = dict(pieces), max(len(p) for p, _ in pieces)
    unknown, known = min(scores.values()) - 10, {}

    def best(unit):
        """(pieces, score) of a word with its mark: the longest of equal last pieces."""
        if unit not in known:
            paths = [(0, 0.0)]
            for end in range(1, len(unit) + 1):
                ways = [(paths[end - n][0] + 1, paths[end - n][1] + scores[unit[end - n : end]]) for n in range(min(end, longest), 0, -1) if unit[end - n : end] in scores]
                if unit[end - 1] not in scores:
                    ways.append((paths[-1][0] + len(unit[end - 1].encode()), paths[-1][1] + unknown))
                paths.append(max(ways, key=lambda way: way[1]))
            known[unit] = paths[-1]
        return known[unit]

    assert by_bytes and not any(re.search("[^▁]▁", p) for p in scores)
    got = {(r.doc_id, r.n_tokens, round(r.score, 3)) for r in QUERIES["op4_token_counts"](spark, folder).collect()}
    want = set()
    for r in rows:
        found = [best(u) for u in re.findall("▁+[^▁]*", "▁" + r[1].replace(" ", "▁") if r[1] else "")]
        want.add((r[0], sum(n for n, _ in found), round(sum(s for _, s in found), 3)))
    assert got == want


def test_op6(spark, small):
    folder, rows, _ = small
    want = Counter((r[0], *found) for r, found in zip(rows, plain_components([r[:2] for r in rows], 4, 85)))
    assert Counter(map(tuple, QUERIES["op6_jaccard"](spark, folder).collect())) == want


def test_op10(spark, small):
    folder, rows, _ = small
    split = [alnum_words(r[1]) for r in rows]
    base = {"gpl": "gnu general public license", "apache": "apache license", "cc-by": "cc by", "mit": "mit license"}
    held = Counter(w for words in split for w in set(words))
    idf = lambda w: math.log((len(rows) + 1) / (held[w] + 0.5)) + 1e-9

    def starts(words, phrase):
        p = phrase.split()
        return [k for k in range(len(words) - len(p) + 1) if words[k : k + len(p)] == p]

    def share(words, template):
        got = 0
        for phrase in template.phrases:
            p = phrase.split()
            rare = max(range(len(p)), key=lambda j: (idf(p[j]), -j))
            at = [i - rare for i, w in enumerate(words) if w == p[rare]]
            got += max((sum(idf(w) for j, w in enumerate(p) if 0 <= i + j < len(words) and words[i + j] == w) for i in at), default=0)
        return got / sum(idf(w) for phrase in template.phrases for w in phrase.split())

    want = Counter()
    for r, words in zip(rows, split):
        at = [k for p in base.values() for k in starts(words, p)]
        named = ",".join(sorted(label for label, p in base.items() if starts(words, p)))
        labels = ",".join(sorted({t.label for t in license_scan.TEMPLATES if all(starts(words, p) for p in t.phrases)}))
        score = max(share(words, t) for t in license_scan.TEMPLATES)
        want[(r[0], len(words), len(at), min(at, default=None), max(at, default=None), named, labels, round(score, 6))] += 1
    assert sum(1 for key in want if key[5]) > 1
    got = QUERIES["op10_license"](spark, folder).withColumn("score", F.round("score", 6)).collect()
    assert Counter(map(tuple, got)) == want
