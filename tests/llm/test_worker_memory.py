import re
import subprocess
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallybrook.llm import common, jaccard


def test_rows_among_the_keys_take_one_worker_a_task(spark):
    rows = spark.range(1000).select(F.when(F.col("id") != 7, F.col("id")).alias("id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    keys = spark.createDataFrame([(3,), (7,), (900,), (5000,)], "id long")
    passed = common.likely_among(rows, "id", keys, jaccard._zipped, "id long, zipped binary")
    plan = passed._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("MapInArrow|ArrowEvalPython", plan)) == 1
    found = {r.id for r in passed.collect()}
    assert {3, 900} <= found and len(found) < 100 and None not in found
    plain = common.likely_among(rows, "id", keys)
    assert plain.columns == ["id", "text"] and {r.id: r.text for r in plain.collect()}[900] == "text 900"
    assert {r.id for r in plain.collect()} == found


def test_workers_of_the_operators_do_not_load_pandas():
    code = "import sys; from tallybrook.llm import bpe, decontaminate, jaccard, langid, repetition; sys.exit('pandas' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], cwd=common.__file__.split("/tallybrook/")[0]).returncode == 0


def test_near_copies_take_little_text_at_once(monkeypatch):
    sizes, real = [], jaccard.shingle_sets
    monkeypatch.setattr(jaccard, "shingle_sets", lambda texts, n: sizes.append(sum(map(len, texts))) or real(texts, n))
    texts = [" ".join(f"w{i}x{j}" for j in range(500)) for i in range(1200)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    bands = jaccard.Bands(85)
    schemes = {k: jaccard.allocate(bands.most_differences(k), 497, 1200) for k in (bands.of(497) - 1, bands.of(497))}
    made = list(jaccard._key_rows(4, bands, schemes)(iter([batch])))
    assert sum(sizes) == sum(map(len, texts)) > 3 << 20 and max(sizes) <= 1 << 20
    assert len({x for b in made for x in b.column("node").to_pylist()}) == 1200


def test_pairs_of_one_batch_are_handed_on_in_parts():
    keys, sets = 1000, jaccard.FULL
    key, node = np.repeat(np.arange(1, keys + 1), sets), np.tile(np.arange(sets), keys) + np.repeat(np.arange(keys) % 500, sets) * sets
    meta = jaccard.meta_of(3, np.zeros(len(key), np.int64), jaccard._OWN | jaccard._WHOLE)
    batch = pa.RecordBatch.from_arrays([pa.array(key), pa.array(node), pa.array(meta), pa.nulls(len(key), pa.int64())], schema=jaccard._KEYS_ARROW)
    found = list(jaccard._read_keys(iter([batch]), {3: 0}))
    assert max(b.num_rows for b in found) <= 101_000
    worth: dict[tuple[int, int], int] = {}
    for kind, a, b, m in (r for x in found for r in zip(*(c.to_pylist() for c in x.columns))):
        assert kind == jaccard._PAIR and m >> 48 == 3
        worth[a, b] = worth.get((a, b), 0) + (m & 0xFFFF)
    # every key is held by 24 sets, and each such group of sets by two keys
    assert worth == {(g * sets + i, g * sets + j): 2 for g in range(500) for i in range(sets) for j in range(i + 1, sets)}
