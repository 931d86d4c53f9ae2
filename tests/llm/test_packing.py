import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from slicewright.llm import packing
from slicewright.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def ids():
    return packing.Ids(tokenizer_path())


def pad(n, window):
    return 0 if n & (n - 1) == 0 else window - n


def least_cost(positions, costs, window):
    best = {0: 0}
    for j, c in zip(positions, costs):
        best[j] = c + min(best[i] + pad(j - i, window) for i in best if j - window <= i < j)
    return best[positions[-1]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=60), st.integers(0, 10**6))
def test_cuts_are_optimal(gaps, seed):
    window, rng = 48, random.Random(seed)
    positions = np.cumsum(gaps)
    costs = np.array([rng.choice([0, 2, 24]) for _ in gaps])
    chosen = packing.cuts(positions, costs, window)
    edges = [0, *chosen]
    cost = sum(pad(b - a, window) for a, b in zip(edges, edges[1:])) + sum(int(c) for p, c in zip(positions, costs) if p in set(chosen))
    assert chosen[-1] == positions[-1] and max(b - a for a, b in zip(edges, edges[1:])) <= window
    assert cost == least_cost(positions.tolist(), costs.tolist(), window)


TRICKY = ["", " ", "a", " a", "a  b", "a \n b", "\n\nA", "it's we'll 'tis", "x y 　z", "1 2  3", "don't!!  ...", "tab\tand\r\nline", "<|endoftext|> b", "émigré naïve ß", "\x1c\x1d a", "a   b\x85c", "   lead", "trail   "]


@pytest.fixture(scope="module")
def plain():
    """The tokenizer as its file has it, without any switch."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_ids_are_the_tokenizer_s(ids, plain):
    assert ids.ranked is not None
    rng = random.Random(1)
    texts = TRICKY + ["".join(rng.choice([*" \n\tab'sé1. !", "<|endoftext|>", "<|endof", "\u3000", "\x85", "中文", "🙂"]) for _ in range(rng.randint(1, 60))) for _ in range(2000)]
    for text, got in zip(texts, ids(texts)):
        assert got.tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)
    assert ids(["a<|endoftext|>b"])[0].tolist()[1] == 50256


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=80))
def test_ids_of_any_text(text):
    got = packing.ids_of(tokenizer_path())
    assert got([text])[0].tolist() == got.tokenizer.encode(text, add_special_tokens=False).ids


def test_long_runs_and_other_files(ids, plain, monkeypatch):
    texts = ["a" * 9000, "x " + " " * 9000 + "y", "ab<|endoftext|>" * 900, "word " * 3000]
    assert [x.tolist() for x in ids(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(ids, "ranked", None)  # as with a file that is no table of ranks
    assert [x.tolist() for x in ids(TRICKY)] == [plain.encode(t, add_special_tokens=False).ids for t in TRICKY]


def test_files_that_are_no_table_of_ranks():
    import json

    with open(tokenizer_path(), encoding="utf-8") as f:
        data = json.load(f)
    assert packing._ranked(data) is not None
    data["model"]["merges"][:2] = data["model"]["merges"][1::-1]
    assert packing._ranked(data) is None


def test_every_sentence_end_may_be_cut(ids):
    """Also after ``!``, whose id is that of the end, and where sentences are short."""
    text = ids(["No! Yes. Why? Go!\nOn"])[0]
    whole = np.append(text, np.uint16(packing.END_ID))
    ends = (np.flatnonzero(ids.ends[whole]) + 1).tolist()
    spelt = [ids.tokenizer.decode([k]) for k in text.tolist()]
    assert ends == [k + 1 for k, x in enumerate(spelt) if x[-1] in ".!?\n"] + [len(whole)]
    positions, costs = packing.candidates(np.array(ends), np.array([len(whole)]), len(whole))
    assert positions.tolist() == ends and costs.tolist() == [packing.SENTENCE_CUT] * (len(ends) - 1) + [0]


def test_long_texts_are_cut_where_ids_do_not_change(ids):
    text = " ".join(["word's", "naïve", "3.14", "a"] * 200)
    parts = list(packing.slices(text, 100))
    assert len(parts) > 10 and "".join(parts) == text
    assert np.concatenate(ids(parts)).tolist() == ids([text])[0].tolist()


def check(rows, texts, ids, window):
    """Every id in one piece, sequences gapless and at most a window."""
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        by_doc.setdefault(r["doc_id"], []).append(r)
    padding = total = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= window
        padding, total = padding + pad(at, window), total + at
    for doc_id, wanted in texts.items():
        whole = [np.append(t, 0).astype("<u4") for t in ids([x or "" for x in wanted])]
        got = sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in by_doc.get(doc_id, []))
        if len(wanted) == 1:
            at = 0
            for start, length, crc, tokens in got:
                assert start == at and tokens == len(whole[0]) and crc == zlib.crc32(whole[0][start:start + length].tobytes())
                at += length
            assert at == len(whole[0])
        else:
            assert sum(g[1] for g in got) == sum(map(len, whole))
    return padding / max(total, 1)


def test_edges(spark, edge_docs, edge_rows, no_docs, ids):
    texts = {}
    for r in edge_rows:
        texts.setdefault(r[0], []).append(r[1])
    for window, block in ((1024, packing.BLOCK), (64, 500)):
        rows = packing.pack(edge_docs, tokenizer_path(), window=window, block=block).collect()
        check(rows, texts, ids, window)
    assert packing.pack(no_docs, tokenizer_path()).count() == 0


def test_documents(spark, ids):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: [r["text"]] for r in docs.collect()}
    assert check(packing.pack(docs, tokenizer_path()).collect(), texts, ids, 1024) < 0.02
