import math
from collections import Counter

import duckdb
import pytest

from slicewright.llm import lm_score, queries


def brute(texts):
    docs = [[w for w in (t or "").lower().encode().split()] for t in texts]
    one = Counter(w for d in docs for w in d)
    two = Counter(p for d in docs for p in zip(d, d[1:]))
    total = sum(one.values())
    out = []
    for d in docs:
        s = math.log(one[d[0]] / total) if d else 0.0
        for v, w in zip(d, d[1:]):
            s += math.log(two[v, w] / one[v]) if two[v, w] >= 2 else math.log(0.4 * one[w] / total)
        out.append((len(d), s))
    return out


@pytest.mark.parametrize("coded,paired", [(65536, 1024), (3, 2), (40, 5), (1, 1)])
def test_edges(spark, edge_docs, edge_rows, no_docs, coded, paired):
    """The same scores whatever the sizes of the bounded tables."""
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], round(r["log_score"], 6)) for r in lm_score.score(edge_docs, coded=coded, paired=paired).collect())
    want = sorted((r[0] is None, r[0] or 0, n, round(s, 6)) for r, (n, s) in zip(edge_rows, brute([r[1] for r in edge_rows])))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) < 1e-5 for g, w in zip(got, want))


def test_no_rows(spark, no_docs):
    assert lm_score.score(no_docs).count() == 0


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = sorted(con.execute(queries.ORACLES["op5_lm_score"]).fetchall())
    got = sorted(tuple(r) for r in queries.op5_lm_score(spark, sf).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(abs(g[2] - w[2]) < 0.002 and abs(g[3] - w[3]) < 1e-4 for g, w in zip(got, want))
