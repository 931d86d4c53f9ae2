import random

import xxhash

from slicewright.llm import hot, simhash


def brute_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate({k: " " for k in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def brute_components(ids, fps, most=2):
    root = list(range(len(fps)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= most:
                root[find(a)] = find(b)
    groups = {}
    for k in range(len(fps)):
        groups.setdefault(find(k), []).append(ids[k])
    least = {r: min((i for i in g if i is not None), default=None) for r, g in groups.items()}
    return [least[find(k)] for k in range(len(fps))]


def test_matches_brute_force(spark, edge_docs, edge_rows, no_docs):
    want = [brute_fingerprint(r[1]) for r in edge_rows]
    comps = brute_components([r[0] for r in edge_rows], want)
    rows = simhash.near_duplicates(edge_docs).collect()
    order = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in rows), key=order) == sorted(((r[0], f, c) for r, f, c in zip(edge_rows, want, comps)), key=order)
    assert simhash.near_duplicates(no_docs).count() == 0


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    fps = [brute_fingerprint(r["text"]) for r in rows]
    comps = dict(zip([r["doc_id"] for r in rows], brute_components([r["doc_id"] for r in rows], fps)))
    got = simhash.near_duplicates(docs).collect()
    assert {r["doc_id"]: r["fp"] % 2**64 for r in got} == dict(zip([r["doc_id"] for r in rows], fps))
    assert {r["doc_id"]: r["component_id"] for r in got} == comps and len(set(comps.values())) < len(comps)


def test_links_through_long_lists(spark, monkeypatch):
    """A cluster that fills posting lists takes the exact way round; components stay the same."""
    rng = random.Random(3)
    core = rng.getrandbits(64)
    fps = {core}
    for _ in range(600):  # chains of small steps around one fingerprint, and strangers
        f = rng.choice(sorted(fps)) ^ 1 << rng.randrange(64) ^ (1 << rng.randrange(64) if rng.random() < 0.7 else 0)
        fps.add(f)
    fps |= {rng.getrandbits(64) for _ in range(50)} | {0, 2**64 - 1, 1 << 63, 3 << 62}
    fps = sorted(fps)
    for bits in (2, 1):
        want = brute_components(fps, fps, bits)
        nodes = spark.createDataFrame([(f - (f >> 63 << 64),) for f in fps], "fp long")
        for most in (64, 4):
            monkeypatch.setattr(simhash, "LIST_MOST", most)
            found = simhash.components(simhash.links(nodes, bits)).collect()
            root = {r["node"] % 2**64: r["root"] % 2**64 for r in found}
            groups = {}
            for f in fps:
                groups.setdefault(root.get(f, f), []).append(f)
            assert {f: min(g) for g in groups.values() for f in g} == dict(zip(fps, want)), (bits, most)


def test_hot_keys_are_dealt_over_salts(spark, monkeypatch):
    """Copies of one text, one long posting list and the hub of a star, all counted as hot: the same components."""
    monkeypatch.setattr(hot, "LEAST_HOT", 3)
    monkeypatch.setattr(hot, "HOT", 10)
    rng = random.Random(5)
    words = [f"w{k}" for k in range(40)]
    many = " ".join(words)
    texts = [many] * 120 + [None] * 60 + [" ".join(rng.sample(words, 12)) for _ in range(60)]
    ids = list(range(200)) + [None] * 5 + [7] * 35
    fps = [brute_fingerprint(t) for t in texts]
    rows = simhash.near_duplicates(spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(4)).collect()
    order = lambda x: tuple((v is not None, v) for v in x)
    got = sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in rows), key=order)
    assert got == sorted(zip(ids, fps, brute_components(ids, fps)), key=order)
    core = rng.getrandbits(63)
    star = sorted({core} | {core ^ 1 << a ^ 1 << b for a in range(16) for b in range(a)})
    nodes = spark.createDataFrame([(f,) for f in star], "fp long")
    found = simhash.components(simhash.links(nodes)).collect()
    assert {r["node"] for r in found} | {min(star)} == set(star) and {r["root"] for r in found} == {min(star)}
