import random

from tallybrook.llm import decontaminate


def test_a_task_holds_one_block_of_bounded_size(spark, monkeypatch):
    rng = random.Random(8)
    text = lambda n: " ".join(f"v{rng.randrange(3000)}" for _ in range(n))
    same, long = text(40), text(5000)
    items = [(1, same)] * 400 + [(2, long), (3, "a b"), (None, text(30))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    words = long.split()
    texts = [same, "x " + " ".join(words[995:1015]), " ".join(words[-13:]), " ".join(words[-12:]), "a b c", None, items[-1][1]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(decontaminate, "PIECE", 100, raising=False)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 8000)
    held, context = [], spark.sparkContext
    send = context.broadcast
    monkeypatch.setattr(context, "broadcast", lambda value: (held.append(sum(len(text or "") for _, text in value)), send(value))[1])
    found = decontaminate.find(docs, benchmark)
    assert len(held) > 2 and max(held) < 2 * 8000
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    rows = {r.doc_id: ([tuple(s) for s in r.spans], r["items"]) for r in found.collect()}
    assert rows == {0: ([(0, 40)], [1]), 1: ([(1, 21)], [2]), 2: ([(0, 13)], [2]), 3: ([], []), 4: ([(0, 2)], [3]), 5: ([], []), 6: ([(0, 30)], [])}
