import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from slicewright.llm import fingerprint as fp


def test_edges(spark, edge_docs, edge_rows, no_docs):
    rows = sorted(((r[0], r[1] or "") for r in edge_rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for parts in (1, 4, 30):
        got = fp.with_next(edge_docs, parts=parts).collect()
        want = []
        for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
            cut = len(text) // 4
            new = text[:len(text) - cut] + after[:cut]
            a, b, c = (fp.sketch(t) for t in (text, new, after))
            want.append((i is not None, i or 0, len(text), hashlib.sha256(new.encode()).hexdigest(), fp.encode(a), fp.encode(b), fp.likeness(a, b), fp.likeness(a, c)))
        assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], r["near_edited"], r["near_next"]) for r in got) == sorted(want), parts
    assert fp.with_next(no_docs).count() == 0


def test_documents_have_their_next(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect()]
    got = {r["doc_id"]: r for r in fp.with_next(docs.repartition(5)).collect()}
    assert len(got) == len(rows)
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        assert got[i]["edited_sha256"] == hashlib.sha256(fp.edited(text, after).encode()).hexdigest()
    near = [(r["near_edited"], r["near_next"]) for r in got.values() if r["n_chars"] > 600]
    assert np.mean([a for a, _ in near]) > 0.5 > 0.1 > np.mean([b for _, b in near])


texts = st.lists(st.sampled_from([f"w{k}" for k in range(30)]), max_size=200).map(" ".join)


@settings(max_examples=60, deadline=None)
@given(texts, texts)
def test_sketches_merge(a, b):
    both = np.union1d(fp.shingle_hashes(a), fp.shingle_hashes(b))
    assert fp.merged(fp.sketch(a), fp.sketch(b)).tolist() == fp.scaled(both).tolist()
    assert fp.decode(fp.encode(fp.sketch(a))).tolist() == fp.sketch(a).tolist()
    assert fp.likeness(fp.sketch(a), fp.sketch(a)) == 1 == fp.containment(fp.sketch(a), fp.sketch(a))


def test_containment_of_unequal_texts():
    words = [f"word{k}" for k in range(20_000)]
    small, large = " ".join(words[:2000]), " ".join(words)
    assert fp.containment(fp.sketch(small), fp.sketch(large)) > 0.95
    assert abs(fp.containment(fp.sketch(large), fp.sketch(small)) - 0.1) < 0.03


def real_likeness(a, b):
    """Jaccard of the texts' five-word shingles, without hashes."""
    sets = []
    for text in (a, b):
        w = text.lower().encode().split()
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    both = len(sets[0] | sets[1])
    return len(sets[0] & sets[1]) / both if both else 1.0


def test_error_by_length(spark):
    """Against real likeness of real documents and their edits, by the number of words."""
    docs = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()]
    off = {}
    for text, after in zip(docs, docs[1:] + docs[:1]):
        new = fp.edited(text, after)
        n = len(text.split())
        band = 20 if n < 24 else 60 if n < 64 else 120 if n < 124 else 500 if n < 504 else 20_000
        off.setdefault(band, []).append(abs(fp.likeness(fp.sketch(text), fp.sketch(new)) - real_likeness(text, new)))
    share = {band: np.mean(np.array(x) > 0.2) for band, x in off.items()}
    assert share[20] < 0.3 and share[60] < 0.06 and share[120] < 0.02 and share[500] == share[20_000] == 0, share


def test_repeated_words_and_case():
    assert fp.sketch("A b C d E").tolist() == fp.sketch("a B c D e").tolist()
    assert len(fp.shingle_hashes("x " * 1000)) == 1 and len(fp.sketch("")) == 0
