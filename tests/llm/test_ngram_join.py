import math
from collections import Counter

import pytest

from slicewright.llm import hot, lm_score, ngram_join


def brute(texts, order, least):
    docs = [(t or "").lower().encode().split() for t in texts]
    counts = Counter(tuple(d[i - k + 1:i + 1]) for d in docs for i in range(len(d)) for k in range(1, min(order, i + 1) + 1))
    total = sum(map(len, docs))

    def log_s(gram):
        if len(gram) == 1:
            return math.log(counts[gram] / total)
        return math.log(counts[gram] / counts[gram[:-1]]) if counts[gram] >= least else math.log(0.4) + log_s(gram[1:])

    return [(len(d), sum(log_s(tuple(d[max(0, i - order + 1):i + 1])) for i in range(len(d)))) for d in docs]


@pytest.mark.parametrize("order,least", [(1, 1), (2, 2), (3, 1), (3, 2), (4, 3)])
def test_any_order_matches_brute_force(spark, edge_docs, edge_rows, order, least):
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["log_score"]) for r in ngram_join.score(edge_docs, order=order, least_count=least).collect())
    want = sorted((r[0] is None, r[0] or 0, n, s) for r, (n, s) in zip(edge_rows, brute([r[1] for r in edge_rows], order, least)))
    assert [g[:3] for g in got] == [w[:3] for w in want] and all(abs(g[3] - w[3]) < 1e-6 for g, w in zip(got, want))


def test_hot_ngrams_and_no_rows(spark, no_docs, monkeypatch):
    monkeypatch.setattr(hot, "LEAST_HOT", 5)
    texts = [f"the the the cat{k % 7} the" for k in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = sorted((r["doc_id"], r["n_tokens"], round(r["log_score"], 6)) for r in ngram_join.score(docs).collect())
    assert got == [(k, n, round(s, 6)) for k, (n, s) in enumerate(brute(texts, 3, 1))]
    assert ngram_join.score(no_docs).count() == 0


def test_the_packed_form_gives_the_same_scores(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a = {r["doc_id"]: r for r in lm_score.score(docs).collect()}
    b = {r["doc_id"]: r for r in ngram_join.score(docs, order=2, least_count=2).collect()}
    assert a.keys() == b.keys() and all(a[k]["n_tokens"] == b[k]["n_tokens"] and abs(a[k]["log_score"] - b[k]["log_score"]) < 1e-6 * max(1, abs(a[k]["log_score"])) for k in a)
