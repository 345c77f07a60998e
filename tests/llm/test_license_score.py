import pytest

from tallybrook.llm import license_scan


def test_score_is_one_only_for_all_phrases_of_a_template(spark):
    whole = [" x ".join(t.phrases) for t in license_scan.TEMPLATES]
    opening = [t.phrases[0] for t in license_scan.TEMPLATES if len(t.phrases) > 1]
    texts = whole + opening + ["nothing of it"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    scores = [rows[i].score for i in range(len(texts))]
    assert scores[: len(whole)] == [1.0] * len(whole)
    assert len(opening) == 3 and all(0 < x < 1 for x in scores[len(whole) : -1]), scores
    assert all(not rows[i].labels for i in range(len(whole), len(texts)))


def test_score_is_the_idf_share_of_the_best_template(spark):
    templates = (license_scan.Template("two", ("a b", "c d")), license_scan.Template("one", ("e f g",)))
    docs = spark.createDataFrame(list(enumerate(["a b", "c d x a b", "e x g", "h", "a x"])), "doc_id long, text string")
    files, held = license_scan.document_frequency(docs, list("abcdefg"), "text")
    idf = {w: license_scan.math.log((files + 1) / (held.get(w, 0) + 0.5)) + 1e-9 for w in "abcdefg"}

    def best(words):
        def phrase(p):
            p = p.split()
            rare = max(range(len(p)), key=lambda j: (idf[p[j]], -j))
            starts = [i - rare for i, w in enumerate(words) if w == p[rare]]
            return max((sum(idf[w] for j, w in enumerate(p) if 0 <= i + j < len(words) and words[i + j] == w) for i in starts), default=0)

        return max(sum(map(phrase, t.phrases)) / sum(idf[w] for p in t.phrases for w in p.split()) for t in templates)

    for r in license_scan.scan(docs, templates).join(docs, "doc_id").collect():
        assert r.score == pytest.approx(best(r.text.split()))
