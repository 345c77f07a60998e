"""Empty tables, very long texts and clashing columns for each operator."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybrook.llm import bpe, decontaminate, jaccard, langid, license_scan, repetition, token_counts, toxicity, url_filter, warc
from tallybrook.llm.catalog import PIECES, RANKS
from tallybrook.llm.common import groups, run_folder

import public_tokenizers

SHAPE = "doc_id long, text string, lang string, source string, n_chars long, k0 string, keys string, id string, n_words string"
MODEL = langid.fit([("the dog and the cat are in the house " * 3, "en"), ("der hund und die katze sind in dem haus " * 3, "de")], rounds=3)
TOXIC = toxicity.fit([(f"you are such a blockhead number{n}", 1) for n in range(30)] + [(f"the weather is fine today number{n}", 0) for n in range(30)])


def rows_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 1, "k", "x", "y", "z") for i, t in enumerate(texts)], SHAPE)


OPERATORS = {
    "op1": lambda docs: bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS),
    "op3": lambda docs: langid.predict(docs, MODEL),
    "op4": lambda docs: token_counts.token_counts(docs, *token_counts.read_vocabulary(PIECES)),
    "op5": repetition.judge,
    "op6": jaccard.link,
    "op8": lambda docs: toxicity.score(docs, TOXIC),
    "op9": lambda docs: decontaminate.report(docs, docs.select(F.lit(1).alias("item_id"), F.lit("one two three").alias("text")).limit(1)),
    "op10": license_scan.scan,
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_empty_and_odd_tables(spark, name):
    assert OPERATORS[name](rows_of(spark, [])).count() == 0
    texts = [None, "", "a", "same text here", "same text here", "\n\n \t"]
    assert OPERATORS[name](rows_of(spark, texts)).count() == len(texts)


@pytest.mark.parametrize("name", [n for n in OPERATORS if n not in ("op4", "op6")])
def test_a_text_of_megabytes(spark, name):
    rng = random.Random(1)
    words = ["the", "dog", "haus", "mit", "license", "one", "two", "three", "blockhead"]
    long = " ".join(rng.choice(words) for _ in range(450_000))
    found = OPERATORS[name](rows_of(spark, ["short", long])).collect()
    assert len(found) == 2
    if name == "op5":
        assert found[1].n_words == 450_000
    if name == "op9":
        assert found[1].n_words == 450_000 and found[1].n_hit > 0
    if name == "op10":
        assert found[1].n_words == 450_000 and "mit" in found[1].base_labels


def test_pages_without_rows_or_with_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x", None, 1, 2, "h")], "page_id long, url string, html string, _keys int, _best int, host string")
    rules = spark.createDataFrame([("block", "org", "/x")], "verdict string, host string, path string")
    row = url_filter.judge(pages, rules).first()
    assert (row["_keys"], row["_best"], row.host, row.rule, row.verdict) == (1, 2, "a.org", "org/x", "block")
    assert url_filter.judge(pages.limit(0), rules).count() == 0
    assert warc.read(spark, warc.write(pages.limit(0).select("page_id", "url", "html"), run_folder(spark))).count() == 0


def test_groups_turn_no_more_than_a_run_of_rows_into_objects(spark):
    docs = rows_of(spark, ["x" * n for n in (10, 0, 5, 100, 7)] + [None])
    (batch,) = docs.select("text", "doc_id").coalesce(1).toArrow().combine_chunks().to_batches()
    runs = list(groups(iter([batch]), limit=20))
    assert [b.column("doc_id").to_pylist() for b, _ in runs] == [[0, 1, 2], [3], [4, 5]]
    assert [len(t) for _, ts in runs for t in ts] == [10, 0, 5, 100, 7, 0]
    assert np.all([b.num_rows == len(t) for b, t in runs])


@pytest.mark.parametrize("most", [1 << 28, 1 << 15])
def test_likely_rows_hold_all_wanted_ones(spark, monkeypatch, most):
    from tallybrook.llm import common

    monkeypatch.setattr(common, "MOST_BITS", most)
    rows = spark.range(-50_000, 50_000).select("id", F.lit("t").alias("text")).unionAll(spark.createDataFrame([(None, "t")], "id long, text string"))
    keys = spark.range(-20_000, 20_000, 7).select("id")
    found = common.likely_among(rows, "id", keys)
    assert found.join(keys, "id", "left_semi").count() == keys.count()
    assert found.count() < (keys.count() * 2.5 if most > 1 << 15 else 100_000)
    assert common.likely_among(rows, "id", keys.limit(0)).count() == 0
