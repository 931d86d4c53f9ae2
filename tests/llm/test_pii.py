import hashlib
import math
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from slicewright.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_luhn(d):
    doubled = [int(c) * 2 if k % 2 else int(c) for k, c in enumerate(d[::-1])]
    return sum(x // 10 + x % 10 for x in doubled) % 10 == 0


def brute(text):
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255 or kind == "card" and not (12 <= len(d) <= 19 and brute_luhn(d)) or kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((m.start(), order, kind, m.end()))
    return [(k, a, b) for a, _, k, b in sorted(out)]


pieces = st.sampled_from(["a@b.c", "@", "x.y+z@mail-1.example.com", ".", "-", " ", "1", "255", "256", "0.0.0.0", "1.2.3.4.5", "007.1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (319) 555-5132", "+", "(", "é", "\n", "٣", "a" * 5, "+12", "  "])


@settings(max_examples=400, deadline=None)
@given(st.lists(pieces, max_size=14).map("".join))
def test_base_spans_match_the_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_long_texts_take_linear_time():
    for text in ("a" * 400_000, "1" * 400_000, "1 " * 200_000, "+1" * 200_000, "a." * 200_000 + "@", "@" * 400_000):
        assert isinstance(pii.base_spans(text), list)


def test_edges(spark, edge_docs, edge_rows, no_docs):
    got = pii.find(edge_docs).collect()
    want = [(r[0] or 0, hashlib.sha256(pii.span_text(brute(r[1] or "")).encode()).hexdigest()) for r in edge_rows]
    assert sorted((r["doc_id"] or 0, r["base_sha256"]) for r in got) == sorted(want)
    assert pii.find(no_docs).count() == 0


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r["doc_id"]: r for r in pii.find(docs).collect()}
    for r in docs.select("doc_id", "text").collect():
        spans = brute(r["text"])
        row = got[r["doc_id"]]
        assert row["base_sha256"] == hashlib.sha256(pii.span_text(spans).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in spans) for k in PATTERNS]
        assert [s for s in row["spans"].split(",") if s and not s.startswith("term")] == [pii.span_text([s]) for s in spans]


def told(rows, disclosed=pii.DISCLOSED, chance=pii.CHANCE):
    """{unit: share} of the disclosing words and shapes, counted in plain Python."""
    parsed = []
    for _, text in rows:
        text = text or ""
        spans = brute(text)
        parsed.append((text, {pii._entity(k, text[a:b]) for k, a, b in spans}, {w.lower() for w in re.findall(r"\w+", text)},
                       {m[0].lower() for m in re.finditer(r"\w+", text) if not any(a < m.end() and m.start() < b for _, a, b in spans)}))
    total, n_word = len(parsed), {}
    for _, _, words, _ in parsed:
        for u in words | {pii.shape(w) for w in words}:
            n_word[u] = n_word.get(u, 0) + 1
    holders = {}
    for text, entities, _, _ in parsed:
        for e in entities:
            holders.setdefault(e, set()).add(text)
    targets = {}  # name: texts
    for text, entities, _, _ in parsed:
        for name in {e.split(":")[0] for e in entities} | ({"any"} if entities else set()):
            targets.setdefault(name, set()).add(text)
    for e, held in holders.items():
        if len(held) >= pii.LEAST_TEXTS:
            targets[tuple(sorted(held))] = held
    rows_of = lambda texts: sum(t in texts for t, *_ in parsed)
    units = sum(n >= pii.RARE or u[0] == "#" for u, n in n_word.items())
    out = {}
    for held in targets.values():
        n_target, pair = rows_of(held), {}
        for text, _, _, outside in parsed:
            if text in held:
                for u in {w if n_word[w] >= pii.RARE else pii.shape(w) for w in outside}:
                    pair.setdefault(u, []).append(text)
        for u, found in pair.items():
            x, expected = len(set(found)), n_word[u] * n_target / total
            accident = x - expected - x * math.log(x / expected) if x > expected else 0.0
            information = math.log2(total / n_target)
            share = math.log2(len(found) / n_word[u] * total / n_target) / information if information > 0 else 0.0
            if share >= disclosed and accident + math.log(units * len(targets)) <= math.log(chance):
                out[u] = max(out.get(u, 0), share)
    return out


def check_shares(spark, rows, **limits):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["unit"]: r["share"] for r in pii.disclosures(pii.scan(docs).checkpoint(), pii.term_counts(docs).checkpoint(), **limits).collect()}
    want = told(rows, **limits)
    assert got.keys() == want.keys() and all(abs(got[u] - want[u]) < 1e-9 for u in want)
    return got


def corpus(seed=1):
    """Prose; an entity with its codename; phones after the word "call"; keys beside cards; copies and single oddities."""
    rng = random.Random(seed)
    prose = lambda n: " ".join(f"w{rng.randrange(40)}" for _ in range(n))
    rows = [(k, prose(30)) for k in range(300)]
    rows += [(400 + k, f"{prose(8)} Falcon {prose(5)} boss@corp.example.com {prose(3)} {k}") for k in range(8)]
    rows += [(500 + k, f"{prose(9)} hotline {prose(6)} +1 (319) 555-{5000 + k} {prose(4)}") for k in range(25)]
    rows += [(600 + k, f"{prose(4)} key{k}z{rng.randrange(10**30):030d} {prose(4)} 10.0.{k}.7") for k in range(25)]
    rows += [(700 + k, f"a copied text with Quagmire and x@copies.example {prose(0)}") for k in range(30)]  # one text many times
    rows += [(800, "Zanzibar jane.roe@one.example"), (801, None), (802, "")]
    return rows


def test_shares_match_brute_force(spark):
    got = check_shares(spark, corpus())
    assert {"falcon", "hotline"} <= got.keys() and not {"quagmire", "zanzibar", "copied"} & got.keys()
    assert any(u.startswith("#M3") for u in got)  # the keys, each seen once
    check_shares(spark, corpus(2), disclosed=0.5, chance=0.5)
    check_shares(spark, corpus(3)[:20])
    assert check_shares(spark, [(1, "no entity here")] * 9) == {}


def test_disclosing_terms_are_found_everywhere_and_replaced(spark):
    rows = [*corpus(), (900, "w1 w2 FALCON w3, far from any mention"), (901, "w5 zanzibar quagmire w6")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.find(docs).collect()}
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert got[900]["spans"] == "term:6:12" and clean[900] == "w1 w2 [TERM] w3, far from any mention"
    assert got[901]["spans"] == "" and clean[901] == rows[-1][1]
    assert all("Falcon" not in clean[k] and "[EMAIL]" in clean[k] for k in range(400, 408))
    assert all("hotline" not in clean[k] and "key" not in clean[k + 100] for k in range(500, 525))
    assert sum(got[k]["n_term"] for k in range(300)) == 0 and all(got[k]["n_spans"] == 0 for k in range(300))
    assert all(got[r[0]]["n_spans"] == len([x for x in got[r[0]]["spans"].split(",") if x]) for r in rows)


def test_a_page_of_shared_addresses(spark):
    """Pages with the same thousands of addresses: one target, not one for each."""
    addresses = " ".join(f"p{k}@dir.example" for k in range(3000))
    rows = [(k, f"directory page{k} {addresses} " + " ".join(f"v{k}x{j}" for j in range(500))) for k in range(4)] + [(10 + k, "the usual prose") for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.scan(docs).checkpoint()
    texts = found.where("size(entities) > 0").groupBy("text_hash").agg(F.count("*").alias("n"), F.any_value("entities").alias("entities"), F.any_value("words").alias("words"))
    assert pii._targets(texts, 3).count() == 3 * 4  # any, email and the one group, in four texts
    check_shares(spark, rows)


def test_shapes_agree(spark):
    words = ["abc", "é", "123", "a1", "_", "x" * 90, "٣٣", "ß9", "日本"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", pii._shape(F.col("w")).alias("s")).collect()
    assert {r["w"]: r["s"] for r in got} == {w: pii.shape(w) for w in words}


def test_words_outside_spans():
    for text in ("call +1 (319) 555-5132 now, a@b.c or 1.2.3.4", "x a@b.c", "no spans here", ""):
        spans = pii.base_spans(text)
        want = [m.span() for m in re.finditer(r"\w+", text) if not any(a < m.end() and m.start() < b for _, a, b in spans)]
        assert [m.span() for m in pii.words_outside(text, spans)] == want
