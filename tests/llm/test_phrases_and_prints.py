"""Phrases, fingerprints and fill-in-middle against plain versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybrook.llm import collocation, fill_middle, winnow

DOCS = "doc_id long, text string, lang string, n long, form string, out string, rank int, id string"


def table_of(spark, texts, langs=None, ids=None):
    """Documents whose further columns are named like columns that the operators make."""
    rows = [(ids[i] if ids else i, t, langs[i] if langs else "en", 5, "f", "o", 1, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


# --- phrases ----------------------------------------------------------------


def plain_phrases(texts, langs, least, top):
    counts, totals = {}, Counter()
    for text, lang in zip(texts, langs):
        lang, low = lang or "und", "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        wanted = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        rows = []
        for g, a in wanted.items():
            if len(g) == 2 and any(2 * b >= a for h, b in wanted.items() if len(h) == 3 and g in (h[:2], h[1:])):
                continue
            score, k = min((10**6 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            rows.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, totals[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def random_texts(seed, n):
    rng = random.Random(seed)
    words = ["a", "A", "b", "é", "c\x00d", "語", "e", "ff"]
    passage = " ".join(f"w{i}" for i in range(40))
    texts = [" ".join(rng.choice(words) + rng.choice(["", "", "", ".", ",\n", "\t", "  "]) for _ in range(rng.randrange(60))) for _ in range(n)]
    texts += [passage] * 12 + [f"x{i} {passage} y{i}." for i in range(5)] + ["a a a a a a"] * 3 + [None, "", " \t", "...", "one"]
    return texts, [rng.choice(["en", "de", None, "und"]) for _ in texts]


def test_phrases_equal_a_plain_count(spark):
    texts, langs = random_texts(3, 60)
    for least, top in ((3, 2000), (10, 5)):
        found = collocation.collocations(table_of(spark, texts, langs), least, top)
        assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, found.collect())) == plain_phrases(texts, langs, least, top)


def test_edges_of_full_nodes_are_dealt_apart(spark, monkeypatch):
    """A node that is full in some groups of texts and not in others."""
    rng = random.Random(5)
    texts = [" ".join("x y " + f"w{rng.randrange(40)}" for _ in range(rng.choice([2, 150]))) for _ in range(40)]
    for name, value in (("FULL", 0.001), ("LEAST_FULL", 5), ("GROUP_BYTES", 700)):
        monkeypatch.setattr(collocation, name, value)
    made = collocation._blocks(3, 4)(iter(table_of(spark, texts).select("lang", "text").toArrow().to_batches()))
    apart = [sum(s[4] for s in b.column("sizes").to_pylist()) for b in made]
    assert any(apart) and not all(apart)
    found = collocation.collocations(table_of(spark, texts), 3, 2000)
    assert sorted(map(tuple, found.collect())) == plain_phrases(texts, ["en"] * len(texts), 3, 2000)


def test_phrases_of_an_empty_table(spark):
    assert collocation.collocations(table_of(spark, [])).count() == 0
    assert collocation.collocations(table_of(spark, [None, ""])).count() == 0


def test_edge_counts_of_groups_add_up():
    texts, _ = random_texts(9, 40)
    pieces = [p for t in texts for p in collocation.pieces_of((t or "").encode())]
    for size in (3, 4):
        vocabulary, found = collocation.count_grams(pieces, size)
        for k, (numbers, counts) in enumerate(found, 1):
            mine = {tuple(vocabulary[i] for i in row): c for row, c in zip(numbers.tolist(), counts.tolist())}
            every = [tuple(p[i : i + k]) for p in pieces for i in range(len(p) - k + 1)]
            assert mine == Counter(every if k == size else [tuple(p[-k:]) for p in pieces if len(p) >= k])


def test_paths_hold_every_frequent_edge_once_with_its_weight(spark):
    texts, langs = random_texts(4, 50)
    counts = collocation.graph(table_of(spark, texts, langs), least=3).cache()
    edges = {(r.lang, r.gram): r.n for r in counts.filter("size = 3").collect()}
    windows = []
    rows = collocation.paths(counts).collect()
    for r in rows:
        words = r.phrase.split(" ")
        windows += [((r.lang, " ".join(words[i : i + 3])), r.n) for i in range(len(words) - 2)]
    assert len(windows) == len(edges) and dict(windows) == edges
    # a passage of forty words in twelve texts and inside five others is one path over its unary nodes
    assert max(len(r.phrase.split(" ")) for r in rows) == 40


def test_scores_beyond_64_bits(spark):
    a, left, right = 999_999_999_999_999, 999_999_999_999_999, 999_999_999_999_998
    row = spark.range(1).select(collocation._cut(F.lit(a), F.lit(left), F.lit(right)).alias("x")).first()
    assert row.x == 10**6 * a * a // (left * right)


# --- fingerprints -----------------------------------------------------------


def plain_winnow(text, k=winnow.GRAM, w=winnow.WINDOW):
    points = np.array([ord(c) for c in text], np.uint32)
    if not len(points):
        return []
    k = min(k, len(points))
    one = [int(winnow.gram_hashes(points[i : i + k], k)[0]) for i in range(len(points) - k + 1)]
    w = min(w, len(one))
    chosen = {min(range(i, i + w), key=lambda j: (one[j], -j)) for i in range(len(one) - w + 1)}
    return [(one[j], j) for j in sorted(chosen)]


@settings(max_examples=60, deadline=None)
@given(st.text("ab\U0001F600é", max_size=120), st.integers(1, 6), st.integers(1, 9))
def test_windows_equal_a_plain_choice(text, k, w):
    hashes, places = winnow.winnow(np.array([ord(c) for c in text], np.uint32), k, w)
    assert list(zip(hashes.tolist(), places.tolist())) == plain_winnow(text, k, w)
    assert [x.tolist() for x in winnow.unpack(winnow.pack(hashes, places))] == [hashes.tolist(), places.tolist()]


def test_chunks_of_a_long_text_meet(monkeypatch):
    points = np.random.default_rng(1).integers(97, 101, 5000).astype(np.uint32)
    whole = winnow.winnow(points)
    monkeypatch.setattr(winnow, "CHUNK", 37)
    assert [x.tolist() for x in winnow.winnow(points)] == [x.tolist() for x in whole]


def test_shared_passages_share_a_hash_at_their_offset():
    rng = random.Random(2)
    for _ in range(200):
        passage = "".join(rng.choice("abcde ") for _ in range(winnow.GRAM + winnow.WINDOW - 1))
        texts = ["".join(rng.choice("abcde ") for _ in range(rng.randrange(50))) + passage + "".join(rng.choice("abcde ") for _ in range(rng.randrange(50))) for _ in range(2)]
        one, two = (dict(map(reversed, zip(*[x.tolist() for x in winnow.winnow(np.array([ord(c) for c in t], np.uint32))]))) for t in texts)
        offset = texts[1].index(passage) - texts[0].index(passage)
        assert any(two.get(p + offset) == h for p, h in one.items())


def plain_edits(rows):
    """By id: the least text; then every row with its next text."""
    least = {}
    for i, t in rows:
        if i is not None:
            least[i] = min(least.get(i, t or ""), t or "")
    order = sorted(least)
    following = {i: least[order[(n + 1) % len(order)]] for n, i in enumerate(order)}
    out = []
    for i, t in rows:
        text, donor = t or "", following.get(i, least[order[0]] if order else "")
        n = len(text) // 4
        edited = text[: len(text) - n] + donor[:n]
        sets = [{h for h, _ in plain_winnow(x)} for x in (text, edited, donor)]
        near = [1.0 if not sets[0] | s else len(sets[0] & s) / len(sets[0] | s) for s in sets[1:]]
        out.append((-1 if i is None else i, len(text), hashlib.sha256(edited.encode()).hexdigest(), *near))
    return sorted(out)


@pytest.mark.parametrize("case", ["plain", "hot", "nulls", "one", "no ids"])
def test_edits_equal_a_plain_version(spark, case):
    rng = random.Random(6)
    texts = ["".join(rng.choice("ab é語 ") for _ in range(rng.randrange(120))) for _ in range(90)] + [None, "", "a", "abc"]
    ids = list(range(0, 3 * len(texts), 3))
    rng.shuffle(ids)
    if case == "hot":
        ids = [30 if n % 2 else i for n, i in enumerate(ids)]
    elif case == "nulls":
        ids = [None if n % 3 == 0 else i // 2 for n, i in enumerate(ids)]
    elif case == "one":
        ids = [7] * len(ids)
    elif case == "no ids":
        ids = [None] * len(ids)
    found = winnow.with_edits(table_of(spark, texts, ids=ids).repartition(5))
    rows = found.collect()
    mine = sorted((-1 if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in rows)
    assert mine == plain_edits(list(zip(ids, texts)))
    by_text = {}
    for r in winnow.fingerprints(table_of(spark, texts, ids=ids)).collect():
        by_text.setdefault(r.n_chars, set()).add(r.fingerprint)
    assert all(r.fingerprint in by_text[r.n_chars] for r in rows)


def test_edits_of_an_empty_table(spark):
    assert winnow.with_edits(table_of(spark, [])).count() == 0


# --- fill in middle ---------------------------------------------------------

PATTERN = {"line": r"[^\n]*\n|[^\n]+", "sentence": r"[^.!?\n]*[.!?\n]|[^.!?\n]+", "word": r"[^ \t\n]*[ \t\n]|[^ \t\n]+"}


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("a \n.!é\U0001F600", max_size=40), max_size=6), st.sampled_from(sorted(PATTERN)), st.integers(0, 2**32 - 1))
def test_cuts_equal_a_plain_list_of_units(texts, unit, seed):
    drawn = np.random.default_rng(seed).integers(0, 2**32, (len(texts), 4))
    n, first, second = fill_middle.cuts(texts, drawn, unit)
    for i, text in enumerate(texts):
        units = re.findall(PATTERN[unit], text)
        a, b = sorted(int(x) % (len(units) + 1) for x in drawn[i, :2])
        assert (n[i], first[i], second[i]) == (len(units), len("".join(units[:a])), len("".join(units[:b])))


def test_outputs_come_back_and_marked_texts_stay(spark):
    texts = [None, "", "\n", "a", "a\nb", "one\ntwo\nthree", "has <P> in it\nx", "é\n語\n" * 50, "<P", "S>\nx<", "x" * 200_000 + "\n" + "y\n" * 1000] * 3
    docs = table_of(spark, texts)
    rows = fill_middle.restored(fill_middle.transform(docs, keep=["doc_id", "text", "n", "form"])).collect()
    assert len(rows) == len(texts)
    for row in rows:
        doc_id, text, n, kept, units, form, prefix, middle, output, back = row
        assert back == (text or "") and (n, kept) == (5, "f")
        assert (form == "plain") == (not text or "<P>" in text) == (prefix is None)
    assert {r[5] for r in rows} == {"plain", "psm", "spm"}
    assert fill_middle.transform(docs.limit(0)).count() == 0
    some = fill_middle.transform(docs, rate=0).collect()
    assert {r.form for r in some} == {"plain"} and all(r.output == (texts[r.doc_id] or "") for r in some)
