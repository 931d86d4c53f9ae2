import random
import re
import time
from itertools import combinations

import pytest

from slicewright.llm import decontaminate as dec


def tokens(text):
    return [w for w in re.split(r"[\x00-/:-@\[-`{-\x7F]+", (text or "").lower()) if w]


def brute(docs, items):
    """The longest agreeing stretch of every diagonal, by trying all pairs of ends; no seed is asked for."""
    out = set()
    for i, text in docs:
        d = tokens(text)
        for item, item_text in items:
            b = tokens(item_text)
            if not b:
                continue
            for diagonal in range(-len(b) + 1, len(d)):
                low, high = max(0, -diagonal), min(len(b), len(d) - diagonal)
                same = [d[q + diagonal] == b[q] for q in range(low, high)]
                if sum(same) * 5 >= 4 * len(b):
                    out.add((i, item, low + diagonal, high + diagonal, sum(same)))
                elif sum(same) * 5 >= 4 * dec.LEAST_TOKENS and len(b) >= dec.LEAST_TOKENS:
                    sums = [0]
                    for x in same:
                        sums.append(sums[-1] + x)
                    size, a = max((e - a, -a) for a in range(len(same)) for e in range(a + 1, len(same) + 1) if (sums[e] - sums[a]) * 5 >= 4 * (e - a))
                    if size >= dec.LEAST_TOKENS:
                        out.add((i, item, low - a + diagonal, low - a + size + diagonal, sums[size - a] - sums[-a]))
    return out


def found(docs, benchmark):
    rows = [(r["doc_id"], r["item_id"], r["doc_start"], r["doc_end"], r["matching"]) for r in dec.overlaps(docs, benchmark).collect()]
    return sorted(rows, key=str)


@pytest.fixture(scope="module")
def items():
    rng = random.Random(11)
    make = lambda n: " ".join(f"b{rng.randrange(400)}" for _ in range(n))
    return [(0, make(20)), (1, make(40)), (2, make(15)), (3, make(7)), (4, make(3)), (5, ""), (6, None), (None, make(18)), (7, make(1)), (10, make(5)), (11, make(10)),
            (8, "x y z " + make(9)), (8, "x y z " + make(9)), (9, "The Naïve, ÉCLAIR: was not eaten by any of them at 9 o'clock!")]


def test_matches_brute_force(spark, items, edge_rows, edge_docs):
    """Every diagonal that a seed can find, with the stretch that trying all ends gives."""
    rng = random.Random(12)
    noise = lambda n: " ".join(f"b{rng.randrange(400)}" for _ in range(n))
    rows = [(r[0], r[1]) for r in edge_rows]
    for item, text in items:
        words = (text or "").split()
        for changes in (0, 1, 2, 4, 6):
            w = list(words)
            for k in rng.sample(range(len(w)), min(changes, len(w))):
                w[k] = "changed"
            rows.append((len(rows) + 200, f"{noise(30)} {' '.join(w)}, {noise(9)}"))
        rows.append((len(rows) + 200, " ".join(words[:14]).upper() + "! " + noise(40)))  # a part only
        rows.append((len(rows) + 200, " ".join(words[3:]) + " x " + " ".join(words)))
    docs = spark.createDataFrame([(*r, 1, "h") for r in rows], "doc_id long, text string, n int, hash string").repartition(3)
    benchmark = spark.createDataFrame([(*r, "x") for r in [*items, items[0]]], "item_id long, text string, tokens string")
    every = brute(rows, items)
    got = found(docs, benchmark)
    assert set(got) <= every and len(got) == len(set(got))
    assert len(got) >= 0.97 * len(every) and len(got) > 40  # what is missed holds no untouched seed
    kept = dec.clean(docs, benchmark)
    bad = {w[0] for w in got}
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == sorted((r[0] is None, r[0] or 0) for r in rows if r[0] not in bad)


def test_empty_tables(spark, edge_docs, no_docs, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert found(no_docs, benchmark) == [] == found(edge_docs, benchmark.limit(0))
    assert dec.clean(edge_docs, benchmark.limit(0)).count() == edge_docs.count()


def test_full_bit_table_changes_nothing(spark, items, monkeypatch):
    docs = spark.createDataFrame([(k, f"before {t} after") for k, (_, t) in enumerate(items)], "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = found(docs, benchmark)
    monkeypatch.setattr(dec, "TABLE_BITS", 64)
    assert found(docs, benchmark) == want and want


def test_documents_and_planted_items(spark):
    sf = "/root/testdata/sf0.001"
    docs, benchmark = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    rows, items = [(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in benchmark.collect()]
    got = found(docs, benchmark)
    exact = {(i, b) for i, t in rows for b, x in items if x in t}
    assert exact <= {(g[0], g[1]) for g in got}
    assert set(got) == brute([r for r in rows if r[0] in {g[0] for g in got} | set(range(15))], items)


def seeds_find(changed, n):
    """Whether a seed of an overlap of n tokens with these replaced is untouched."""
    return any(all(p + k * dec.MASK[0] not in changed for k in range(dec.MASK[1])) for p in range(n - (dec.MASK[1] - 1) * dec.MASK[0]))


def test_recall_of_every_choice_of_replaced_tokens():
    """All ways to replace 2 of 13 are found; of the longest shortest overlaps, more than 0.9."""
    for n, changes, least in [(13, 1, 1), (13, 2, 1), (14, 2, 1), (15, 3, 0.9), (16, 3, 0.9), (18, 3, 0.9), (20, 4, 0.9)]:
        ways = list(combinations(range(n), changes))
        assert sum(seeds_find(set(w), n) for w in ways) >= least * len(ways), (n, changes)
    rng = random.Random(3)
    for n in (25, 30, 40, 60):
        assert sum(seeds_find(set(rng.sample(range(n), n // 5)), n) for _ in range(2000)) >= 0.9 * 2000, n
    for n in range(1, dec.LEAST_TOKENS):  # whole short items, all ways
        for w in combinations(range(n), n // 5):
            assert any(all(p + k * step not in w for k in range(weight)) for p, step, weight in dec.short_masks(n))


def test_recall_on_tables(spark):
    """Parts of items with words replaced: overlaps that trying every diagonal finds, without seeds."""
    rng = random.Random(13)
    words = [[f"i{k}x{q}" for q in range(40 + 20 * k)] for k in range(4)] + [[f"s{n}x{q}" for q in range(n)] for n in range(1, 13)]
    rows = []
    for n, changes in [(13, 1), (13, 2), (15, 3), (16, 2), (16, 3), (20, 3), (20, 4), (30, 6), (30, 9)] * 6:
        item = words[rng.randrange(4)]
        start = rng.randrange(len(item) - n)
        part = item[start:start + n]
        for k in rng.sample(range(n), changes):
            part[k] = f"changed{k}"
        rows.append((len(rows), " ".join([f"n{k}" for k in range(rng.randrange(9))] + part + ["end"] * rng.randrange(9))))
    for item in words[4:]:
        for _ in range(3):
            part = list(item)
            for k in rng.sample(range(len(item)), len(item) // 5):
                part[k] = "changed"
            rows.append((len(rows), "before " + " ".join(part) + " after"))
    every_fifth = [w if k % 5 else "changed" for k, w in enumerate(words[0])]
    rows.append((len(rows), "before " + " ".join(every_fifth[:30]) + " after"))
    items = [(k, " ".join(w)) for k, w in enumerate(words)]
    docs, benchmark = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want, got = brute(rows, items), set(found(docs, benchmark))
    assert got <= want and len(got) >= 0.97 * len(want) and len(want) > 75
    assert {r["doc_id"] for r in dec.clean(docs, benchmark).collect()} == {r[0] for r in rows} - {g[0] for g in got}


def test_long_item_takes_linear_work(spark):
    """A document equal to an item of 20,000 tokens, and one with half of its words replaced in places."""
    rng = random.Random(4)
    item = [f"t{rng.randrange(30_000)}" for _ in range(20_000)]
    part = [w if k < 9000 or rng.random() < 0.5 else "x" for k, w in enumerate(item)]
    docs = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(part))], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    started = time.time()
    got = found(docs, benchmark)
    assert time.time() - started < 60
    assert got[0] == (1, 1, 0, 20_000, 20_000) and len(got) == 2
    i, _, start, end, matching = got[1]
    assert i == 2 and start == 0 and end > 9000 and matching * 5 >= 4 * end
    sums = [0]
    for a, b in zip(part, item):
        sums.append(sums[-1] + (1 if a == b else -4))
    assert end == max(k for k, s in enumerate(sums) if s >= 0) and matching == sum(a == b for a, b in zip(part[:end], item[:end]))
