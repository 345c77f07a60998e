"""What the language model learns from: exact expectations, whole texts, any number of languages."""

import itertools

import numpy as np

from tallybrook.llm import langid


def log_sum(scores, moves, first, lengths):
    """Log of the sum over all paths, by listing them."""
    total, begin = 0.0, 0
    for n in lengths:
        own = scores[begin : begin + n]
        paths = itertools.product(range(scores.shape[1]), repeat=n)
        total += np.log(sum(np.exp(first[p[0]] + sum(own[i, y] for i, y in enumerate(p)) + sum(moves[a, b] for a, b in zip(p, p[1:]))) for p in paths))
        begin += n
    return total


def test_expected_pairs_are_the_gradient_of_the_sum_over_paths():
    rng = np.random.default_rng(3)
    lengths = np.array([4, 1, 3, 2])
    scores, moves, first = rng.normal(0, 2, (10, 3)), rng.normal(0, 2, (3, 3)), rng.normal(0, 1, 3)
    p, pairs = langid.expectations(np.exp(scores), lengths, moves, first)
    step = 1e-5
    for a, b in itertools.product(range(3), repeat=2):
        up, down = moves.copy(), moves.copy()
        up[a, b] += step
        down[a, b] -= step
        slope = (log_sum(scores, up, first, lengths) - log_sum(scores, down, first, lengths)) / (2 * step)
        assert abs(slope - pairs[a, b]) < 1e-6
    assert abs(pairs.sum() - (lengths - 1).sum()) < 1e-9
    assert np.allclose(p, langid.posteriors(np.exp(scores), lengths, moves, first))


def test_seventy_languages():
    rows = [(f"l{n:02d}", f"wort{chr(97 + n % 26)}{chr(97 + n // 26)} gemein " * 8) for n in range(70)] * 2
    model = langid.fit(rows, rounds=2)
    assert len(model.labels) == 70
    word = langid.word_labels("wortab gemein", model)
    assert len(word) == 2


def test_long_texts_are_left_out_of_the_sample_whole(spark):
    rows = [(i, "der hund und die katze " * 5, "de") for i in range(8)] + [(i + 10, "the dog and the cat " * 5, "en") for i in range(8)] + [(i + 30, "zzz " * 500, "xx") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert langid.train(docs, chars=200).labels == ["de", "en"]
    assert langid.train(docs).labels == ["de", "en", "xx"]
