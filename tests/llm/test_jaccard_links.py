import random

import pyarrow as pa
import pytest

from tallybrook.llm import jaccard
from tallybrook.llm.jaccard import _KEYS_ARROW, _NOTE, _NOTED, _OWN, _PAIR, _WHOLE, Bands, allocate, keys_of_set, shingle_sets


def pairs_at_threshold(n, percent, count, seed=1):
    """(text, longer text) that link with as many differing shingles as may be."""
    rng = random.Random(seed)
    for i in range(count):
        size = rng.randrange(6, 16)
        more = (100 - percent) * size // percent
        if more:
            words = [f"p{i}w{j}" for j in range(size + n - 1)]
            yield " ".join(words), " ".join(words + [f"p{i}e{j}" for j in range(more)])


def judged(n, percent, left, right):
    """(slack, worth of shared segments, missing of left, missing of right) in the pair's scheme."""
    bands = Bands(percent)
    x, y = shingle_sets([left.encode(), right.encode()], n)
    k = bands.of(len(x))
    scheme = allocate(bands.most_differences(k), (bands.first[k] + bands.first[k + 1] - 1) / 2, 20)
    keys, metas, missing = keys_of_set(x, k, scheme, True)
    others, other_metas, other_missing = keys_of_set(y, k, scheme, bands.of(len(y)) == k)
    whole = dict(zip(others.tolist(), other_metas.tolist()))
    segments = {(m & ((1 << 48) - 1)) >> 3 for key, m in zip(keys.tolist(), metas.tolist()) if key in whole and (m | whole[key]) & _WHOLE}
    return scheme.slack, sum(2 if s < scheme.ones else 1 for s in segments), missing, other_missing


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80)])
def test_short_pairs_at_the_threshold_pass_whichever_side_is_asked(n, percent):
    tried = 0
    for left, right in pairs_at_threshold(n, percent, 20_000):
        slack, shared, missing, other = judged(n, percent, left, right)
        tried += 1
        assert shared + missing > slack and shared + other > slack, (left, right)
        assert shared or min(missing, other) > slack, (left, right)
    assert tried > 10_000


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80)])
def test_short_pairs_link(spark, n, percent):
    # pairs of a set that shows its empty segments and one that does not, and that share little else
    texts = []
    for left, right in pairs_at_threshold(n, percent, 20_000):
        slack, shared, missing, other = judged(n, percent, left, right)
        shows_all = [m == 0 or m > slack for m in (missing, other)]
        if shows_all[0] != shows_all[1] and shared <= slack and len(texts) < 40:
            texts += [left, right]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r.component_id for r in jaccard.link(docs, n, percent).collect()}
    assert len(texts) >= 10 and rows == {i: i - i % 2 for i in range(len(texts))}


def test_a_full_key_is_noted_for_all_of_its_sets():
    # two tasks hold set 1: for one of them the key is full, and only its row says so
    flags = _OWN | _WHOLE
    rows = [(9, 1, flags, None), (9, 1, flags | _NOTED, None), (9, 2, flags, None), (9, 3, flags | _NOTED, 1)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=_KEYS_ARROW)
    found = [tuple(r.values()) for b in jaccard._read_keys(iter([batch]), {0: 0}) for r in b.to_pylist()]
    assert {a for kind, a, _, _ in found if kind == _NOTE} == {1, 2, 3}
    assert {(a, b) for kind, a, b, _ in found if kind == _PAIR} == {(1, 2), (1, 3)}
