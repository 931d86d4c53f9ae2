import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from slicewright.llm import sharding


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 5000), st.integers(0, 2**40))
def test_permutation_and_inverse(n, seed):
    numbers = np.arange(n)
    image = sharding.permute(numbers, n, seed)
    assert sorted(image.tolist()) == numbers.tolist()
    assert sharding.permute(image, n, seed, inverse=True).tolist() == numbers.tolist()


def test_edges(spark, edge_docs, edge_rows, no_docs):
    rows = sharding.shard(edge_docs).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in edge_rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    assert sorted(r["row_number"] for r in rows) == list(range(len(edge_rows)))
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(k, [])) for k in range(24)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(edge_rows)
    ids = [r["doc_id"] for r in sorted(rows, key=lambda r: r["row_number"])]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    assert sharding.shard(no_docs).count() == 0


def test_same_whatever_the_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard(docs).collect()}
    b = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard(docs.repartition(7)).collect()}
    assert a == b and len(set(a.values())) == len(a)
    straight = sorted(a, key=lambda i: a[i][::-1])
    assert straight != sorted(straight)


def test_clustered_ids_are_cut_into_even_slices(spark, monkeypatch):
    from slicewright.llm import order

    monkeypatch.setattr(order, "MANY", 20)
    monkeypatch.setattr(order, "GRAIN", 64)
    ids = [None, -(2**62), 2**62] + list(range(1000, 3000)) + [5000] * 300
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    slices = order.IdSlices(df, "doc_id")
    assert slices.rows == len(ids) and slices.starts
    assert max(n for f, n in zip(slices.firsts, slices.counts) if f != 5000) <= 16 * len(ids) // 64
    got = slices.numbered(df, "doc_id", [], "n").orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(len(ids)))
    assert [r["doc_id"] for r in got] == sorted(ids, key=lambda i: (i is not None, i))
    of_slice, heads = slices.parts(8)
    assert len(of_slice) == len(slices.counts) and heads == sorted(heads) and len(heads) >= 6


def test_rows_of_one_id_are_numbered_in_pieces(spark, monkeypatch):
    """Many rows without an id, many of one id, with repeated rows: the numbers of a plain sort."""
    from slicewright.llm import order

    docs = [(None, f"t{k % 90}") for k in range(200)] + [(7, f"u{k}") for k in range(150)] + [(k, None) for k in range(100)] + [(7, None), (None, "")]
    plain = {(r["doc_id"], r["text_crc32"], r["row_number"]) for r in sharding.shard(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    monkeypatch.setattr(order, "MANY", 20)
    asked = []
    element = order.element
    monkeypatch.setattr(order, "element", lambda values, index: asked.append(len(values)) or element(values, index))
    got = {(r["doc_id"], r["text_crc32"], r["row_number"]) for r in sharding.shard(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()}
    want = sorted(((i, zlib.crc32((t or "").encode())) for i, t in docs), key=lambda r: (r[0] is not None, r[0], r[1]) if r[0] is not None else (False, 0, r[1]))
    assert got == plain == {(i, c, k) for k, (i, c) in enumerate(want)}
    assert 2 * order.PIECES in asked  # NULL and 7
