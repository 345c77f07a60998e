import hashlib
import itertools
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from tallybrook.llm import bpe, decontaminate, jaccard, langid, license_scan, repetition, token_counts, toxicity, url_filter, warc
from tallybrook.llm.common import run_folder
from tallybrook.llm.fm_index import FmIndex

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture
def docs_of(spark):
    """Documents with the given texts, null ids and a column whose name clashes with results."""

    def make(texts, first=0):
        rows = [(first + i, t, "en", "s", 0, 1.5, "x") for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, n_words string")

    return make


ODD = [None, "", " \n\t ", "a", "ab ab ab", "ab ab ab", "Zoë's  naïve ²½ \u2003x\x1c\x85y", "漢字 кириллица 1234 __ --", "w " * 3000, "x" * 5000, "\n\n", "the\nthe\nthe line\nthe line"]


@pytest.fixture
def odd():
    return list(ODD)


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def test_bpe_equals_the_library_and_comes_back(spark, docs_of, odd):
    rng = random.Random(5)
    pool = ["a", "B", " ", "  ", "\n", "'s", "1", "²", "_", "é", "\x1c", "\x85", "\u3000", "語", ".", "-"]
    texts = odd + ["".join(rng.choice(pool) for _ in range(30)) for _ in range(150)]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    encoded = bpe.encode(docs_of(texts), RANKS, public_tokenizers.PATTERN)
    rows = {r.doc_id: r for r in bpe.decode(encoded, RANKS).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        assert np.frombuffer(bytes(rows[i].ids), "<u4").tolist() == library.encode_ordinary(text or "")
        assert bytes(rows[i].decoded) == (text or "").encode()


def test_bpe_of_an_empty_table(spark, docs_of):
    assert bpe.encode(docs_of(["a"]).limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_warc_round_trip(spark):
    long = "é" * 80
    rows = [(1, "http://a/\r\nx", "short"), (2, None, "short"), (3, "http://b/", long), (4, "http://c/", long), (4, "http://c/", long), (None, "http://d/", long), (6, "", None), (7, "http://e/", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    archive = warc.write(pages, run_folder(spark))
    read = sorted(tuple(r) for r in warc.read(spark, archive).select(F.coalesce("page_id", F.lit(-1)), "record_type", "refers_to", "payload_bytes", "payload_digest").collect())
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    want = []
    for page, _, html in rows:
        kind = ("revisit", 3) if page == 4 else ("response", None)
        want.append((-1 if page is None else page, *kind, len((html or "").encode()), digest(html)))
    assert read == sorted(want)
    assert archive.payloads(spark).count() == 3
    for r in warc.restore(spark, archive).collect():
        head = bytes(r.headers)
        assert head.startswith(b"WARC/1.1\r\n") and head.endswith(b"\r\n\r\n") and b"\r\nx" not in head
        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert bytes(r.record) == head + (bytes(r.payload) if size else b"") + b"\r\n\r\n" and size in (0, len(r.payload))


def test_warc_reads_the_records_themselves(spark):
    pages = spark.createDataFrame([(1, "http://a/", "x" * 200), (2, "http://b/", "x" * 200), (3, "http://c/", "short")], "page_id long, url string, html string")
    archive = warc.write(pages, run_folder(spark))
    assert warc.read(spark, warc.Archive(archive.folder)).count() == 3  # another session has no table of the buckets
    # one record says another length than its payload has; digest and payload are as they should be
    wrong = archive.records(spark).withColumn("headers", F.regexp_replace(F.col("headers").cast("string"), "Content-Length: (200|5)\r", "Content-Length: 4\r").cast("binary"))
    folder = run_folder(spark)
    archive.payloads(spark).write.parquet(f"{folder}/payloads")
    wrong.write.parquet(f"{folder}/records")
    with pytest.raises(Exception, match="missing or damaged"):
        warc.read(spark, warc.Archive(folder)).collect()


def test_forward_backward_equals_all_paths():
    rng = np.random.default_rng(1)
    lengths, n = np.array([3, 1, 5]), 3
    scores, moves, first = rng.random((9, n)), rng.normal(size=(n, n)), rng.normal(size=n)
    got, at = langid.posteriors(scores, lengths, moves, first), 0
    for size in lengths:
        want = np.zeros((size, n))
        for path in itertools.product(range(n), repeat=size):
            weight = np.exp(first[path[0]] + sum(moves[a, b] for a, b in zip(path, path[1:]))) * np.prod([scores[at + i, c] for i, c in enumerate(path)])
            want[range(size), path] += weight
        assert np.allclose(want / want.sum(axis=1, keepdims=True), got[at : at + size])
        at += size


def test_language_accuracy_and_odd_texts(spark, docs_of, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs)
    judged = langid.predict(docs, model, keep=["doc_id", "lang"]).withColumn("h", F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    rows = judged.filter("h and lang is not null").collect()
    assert sum(r.lang == r.lang_pred for r in rows) > 0.95 * len(rows) > 50
    found = langid.predict(docs_of(odd), model, keep=["doc_id", "score"]).toDF("doc_id", "own", "lang", "s").collect()
    for r in found:
        letters = any(c.isalpha() for c in odd[r.doc_id] or "")
        assert (r.lang == "und") == (not letters) and 0 <= r.s <= 1
    assert {r.lang_pred for r in langid.predict(docs_of(["abc"]), None).collect()} == {"und"}
    one, two = (next(r.text for r in docs.filter(docs.lang == x).orderBy("doc_id").collect() if len(r.text) > 400)[:400] for x in ("en", "de"))
    labels = [label for _, label, _ in langid.word_labels(one + " " + two, model)]
    assert labels[:20].count("en") > 15 and labels[-20:].count("de") > 15


def test_token_counts_equal_the_library(spark, docs_of):
    rng = random.Random(2)
    pieces = [("▁", -3.0), ("a", -2.0), ("b", -2.0), ("ab", -4.0), ("▁a", -5.0), ("ba", -3.0), ("aba", -6.0), ("▁▁", -5.0), ("é", -1.0)]
    library = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], 0, False))
    texts = ["".join(rng.choice("aab b é z漢 ") for _ in range(rng.randrange(0, 25))) for _ in range(200)] + [None, "", " ", "z" * 50]
    rows = {r.doc_id: r for r in token_counts.token_counts(docs_of(texts), pieces, False).collect()}
    for i, text in enumerate(texts):
        want = len(library.encode("▁" + text.replace(" ", "▁")).ids) if text else 0
        assert rows[i].n_tokens == want, text


def test_repetition_equals_brute_force(spark, docs_of, odd):
    rng = random.Random(3)
    texts = odd + [" ".join(rng.choice("abc") + rng.choice(["", "\n", "#", "é"]) for _ in range(rng.randrange(0, 60))) for _ in range(100)]
    rows = {r.doc_id: r for r in repetition.judge(docs_of(texts)).collect()}
    for i, text in enumerate(texts):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)))
        for n in (5, 8, 10):
            grams = [tuple(words[k : k + n]) for k in range(len(words) - n + 1)]
            inside = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(n)} if len(words) < 200 else {*range(len(words))}
            assert (r[f"repeat_words_{n}"], r[f"repeat_chars_{n}"]) == (len(inside), sum(len(words[k]) for k in inside))
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.base_failed == (len(words) < 10 or 100 * r.repeat_words_5 > 20 * len(words)) and not (r.base_failed and r.kept)


def near_texts(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([6, 9, 15, 30]))] for _ in range(10)]
    passage = [rng.choice(vocabulary) for _ in range(20)]
    out = []
    for i in range(150):
        words = list(rng.choice(bases)) + (passage if i % 3 == 0 else [])
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize(("full", "n", "percent"), [(24, 4, 85), (2, 5, 80)])
def test_jaccard_equals_brute_force(spark, docs_of, odd, monkeypatch, full, n, percent):
    monkeypatch.setattr(jaccard, "FULL", full)
    texts = near_texts(full) + odd + ["one two", "One  two"]
    docs = docs_of(texts).unionAll(docs_of(["one two"]).withColumn("doc_id", F.lit(None).cast("long"))).unionAll(docs_of(texts[:1]))
    rows = jaccard.link(docs, n, percent).collect()
    assert len(rows) == len(texts) + 2

    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
        return frozenset([tuple(words)]) if 0 < len(words) < n else frozenset(zip(*(words[k:] for k in range(n))))

    sets, top = [shingles(t) for t in texts], list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            low, high = sorted((top[a], top[b]))
            top = [low if x == high else x for x in top]
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), top[r.doc_id])


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://EXAMPLE.org/es/1", "http://m.example.org/en/1x?y", "https://x.org", "http://notexample.org/es/", "http://a.com/de/?q", "http://com/fr/#a", "http://b.net/", "http://x.org/a://b/", "http://e.org#f"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    rules = spark.createDataFrame(list(url_filter.RULES), "verdict string, host string, path string")
    rows = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, rules).collect()}
    for i, url in enumerate(urls):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
        host = lowered(host)
        fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, "allow"))
        assert rows[i] == (host, path, *best[1:])
    assert {r.verdict for r in url_filter.judge(pages, rules.limit(0), "block").collect()} == {"block"}


def test_cascade_has_no_error(spark):
    listed = spark.range(0, 3000, 7).selectExpr("concat('k', id) as key")
    universe = spark.range(0, 3000).selectExpr("concat('k', id) as key")
    cascade = url_filter.build(listed, universe, 3000)
    assert len(cascade.levels) > 2
    judged = universe.select("key", cascade.holds(F.col("key")).alias("yes")).collect()
    assert all(r.yes == (int(r.key[1:]) % 7 == 0) for r in judged)


def test_toxicity(spark, docs_of, odd):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.train(docs, labels)
    judged = toxicity.score(docs, model).join(labels.dropna(), "doc_id").filter(F.crc32(F.col("doc_id").cast("string")) % 5 == 0).collect()
    toxic = [r.predicted for r in judged if r.toxic == 1]
    clean = [r.predicted for r in judged if r.toxic == 0]
    assert sum(toxic) > 0.85 * len(toxic) and sum(clean) < 0.02 * len(clean)
    assert all(0 <= r.s <= 1 for r in toxicity.score(docs_of(odd), model, keep=["doc_id", "score"]).toDF("doc_id", "own", "s", "p").collect())
    assert {r.score for r in toxicity.score(docs_of(odd), None).collect()} == {0.0}


def test_grammar_marks_clauses():
    model = toxicity.Model({"moron": 2.0}, {})
    kinds = toxicity.kinds()
    marks = lambda text: {kinds[i] for i in np.flatnonzero(toxicity.Reader(model).matches(text))}
    assert marks("What a moron") == {("insult",)}
    assert marks("You are a moron") == {("insult", "aimed")}
    assert marks("You are not a moron") == {("insult", "aimed", "negated")}
    assert marks("not at all about a moron") == {("insult",)}
    assert marks("She said moron. moron") == {("insult", "aimed", "reported"), ("insult",)}
    assert marks("I will kill you") == {("threat", "aimed")}
    assert marks("moron, that is what you are") == {("insult", "aimed")}
    assert marks("Kill the process") == marks("this will beat the cake batter") == {("harm",)}
    assert marks("Moron, she said") == {("insult", "aimed", "reported")}


@pytest.mark.parametrize(
    "text, kind",
    [
        ("We are going to destroy them all", ("threat", "aimed")),
        ("I will never hurt you", ("threat", "aimed", "negated")),
        ("He said that someone should burn you", ("threat", "aimed", "reported")),
        ("Ich werde dich töten", ("threat", "aimed")),
        ("Wir werden euch nicht schlagen", ("threat", "aimed", "negated")),
        ("Ich töten nicht", ("harm", "negated")),
        ("Je vais te frapper", ("threat", "aimed")),
        ("Je vais détruire jamais ce mur", ("threat", "negated")),
        ("Il dit : nous devons tuer le temps", ("threat",)),
        ("Voy a matar a ustedes", ("threat", "aimed")),
        ("Nunca golpear", ("harm", "negated")),
        ("du bist ein moron", ("insult", "aimed")),
        ("vous n'êtes pas un moron", ("insult", "aimed", "negated")),
        ("not far from here lives a moron", ("insult",)),
        ("You know the way. A moron does not", ("insult",)),
    ],
)
def test_clauses_in_four_languages(text, kind):
    kinds = toxicity.kinds()
    assert [kinds[i] for i in np.flatnonzero(toxicity.Reader(toxicity.Model({"moron": 2.0}, {})).matches(text))] == [kind]


def test_words_behind_modals_are_learned_as_threats():
    odd = lambda n: " ".join(f"{a}{chr(97 + n % 26)}{chr(97 + n // 26)}" for a in ("bo", "ka", "ri", "tu"))
    rows = [(f"I will squash you, {odd(n)} you blockhead", 1) for n in range(60)] + [(f"the weather will stay fine {odd(n)}", 0) for n in range(60)]
    model = toxicity.fit(rows)
    assert "squash" in model.threats and "blockhead" not in model.threats and "blockhead" in model.words
    reader = toxicity.Reader(model)
    assert reader.score("we will squash them") > 0.5 > reader.score("the weather is fine")


def test_fm_index_equals_a_scan():
    rng = random.Random(4)
    for _ in range(60):
        top = rng.choice([1, 2, 9])
        text = np.array([rng.choice([0, *list(range(1, top + 1)) * 3]) for _ in range(rng.randrange(1, 90))] + [0], np.int32)
        index = FmIndex(text, top, rng.choice([1, 3, 16]))
        phrases = [[rng.randrange(1, top + 1) for _ in range(rng.randrange(1, 5))] for _ in range(10)]
        rows = np.zeros((10, 4), np.int64)
        for row, p in zip(rows, phrases):
            row[4 - len(p) :] = p
        low, high = index.ranges(rows, np.array([len(p) for p in phrases]))
        for p, a, b in zip(phrases, low, high):
            assert sorted(index.locate(np.arange(a, b)).tolist()) == [i for i in range(len(text)) if text[i : i + len(p)].tolist() == p]


@pytest.mark.parametrize("block", [8 << 20, 150])
def test_decontamination_equals_brute_force(spark, docs_of, odd, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    rng = random.Random(6)
    text = lambda n: " ".join(rng.choice(["a", "B", "c1", "é"]) for _ in range(n))
    items = [(1, text(20)), (2, text(13)), (3, "a b"), (4, ""), (5, None), (6, "a b"), (None, text(14)), (10, text(15))]
    texts = odd + [text(15) + " " + (rng.choice(items)[1] or "") + " x-" + text(rng.randrange(0, 40)) for _ in range(60)]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("n_words", F.lit(1))
    rows = {r.doc_id: r for r in decontaminate.report(docs_of(texts), benchmark).collect()}
    for i, body in enumerate(texts):
        words, hit, found = alnum_words(body), set(), set()
        for item, phrase in items:
            own = alnum_words(phrase)
            size = min(13, len(own))
            for k in range(len(own) - size + 1) if own else ():
                for at in range(len(words) - size + 1):
                    if words[at : at + size] == own[k : k + size]:
                        hit.update(range(at, at + size))
                        found |= {item} - {None}
        r = rows[i]
        assert (r.n_words, r.n_hit, r["items"]) == (len(words), len(hit), sorted(found))
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(words))
    assert decontaminate.report(docs_of(odd), benchmark.limit(0)).filter("n_hit > 0").count() == 0


def test_license_places(spark, docs_of, odd):
    texts = odd + ["CC-BY, cc by; CC by by", "the MIT License mit license gnu general public  license version 3", "gnu general license", "apache license version 2.0 mit apache  license", "cc", "permission is hereby granted free of charge to any person obtaining a copy"]
    rows = {r.doc_id: r for r in license_scan.scan(docs_of(texts)).collect()}
    phrases = {"gpl": "gnu general public license", "apache": "apache license", "cc-by": "cc by", "mit": "mit license"}
    for i, text in enumerate(texts):
        words = alnum_words(text)
        want = sorted((label, k) for label, p in phrases.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split())
        r = rows[i]
        assert (r.n_words, sorted((p.label, p.start) for p in r.places)) == (len(words), want)
        assert r.base_labels == sorted({label for label, _ in want}) and set(r.base_labels) <= set(r.labels) and 0 <= r.score <= 1
    assert license_scan.scan(docs_of(["a"]).limit(0)).count() == 0
