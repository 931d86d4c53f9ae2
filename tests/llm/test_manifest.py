import hashlib
import zlib

import pytest

from slicewright.llm import manifest, queries
from slicewright.llm.scratch import written

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    """Root, and each leaf's siblings by level, of the plain level-by-level rule."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][k:k + 8]) for k in range(0, len(levels[-1]), 8)])
    proofs = []
    for i in range(len(nodes)):
        path = []
        for level in levels[:-1]:
            first = i // 8 * 8
            path.append((level[first:i], level[i + 1:first + 8]))
            i //= 8
        proofs.append(path)
    return levels[-1][0], proofs


def brute(rows):
    """Expected rows of the contract, by doc_id and leaf."""
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append((r, leaf_of(*r)))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    roots, of = [], {}
    for lang in langs:
        members = sorted(by_lang[lang], key=lambda m: (m[0][0] is not None, m[0][0] or 0, m[1]))
        subroot, proofs = tree([leaf for _, leaf in members])
        roots.append(subroot)
        of[lang] = members, proofs
    root, upper = tree(roots) if roots else (None, [])
    out = []
    for lang, subroot, up in zip(langs, roots, upper):
        for (row, leaf), path in zip(*of[lang]):
            whole = path + up
            node = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                node = leaf_of(*row[:4], row[4].translate(LOWER))
            for before, after in whole:
                node = H(*before, node, *after)
            out.append((row[0], leaf, subroot, root, H(*(x for b, a in whole for x in b + a)), node, node == root))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"]) for r in df.collect()), key=str)


def source_rows(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_edge_rows(spark, edge_docs, no_docs):
    from pyspark.sql import functions as F

    docs = edge_docs.withColumn("lang", F.when(F.col("part") % 9 == 4, None).when(F.col("part") % 9 == 5, "").when(F.col("part") == 2, "zz").otherwise(F.col("lang"))).withColumn("a.b", F.lit(1)).withColumn("tree", F.lit("x")).withColumn("slice", F.lit(1))
    assert got(manifest.manifest(docs)) == brute(source_rows(docs))
    assert manifest.manifest(no_docs).count() == 0


def test_documents(spark):
    sf = "/root/testdata/sf0.01"
    assert got(queries.op13_manifest(spark, sf)) == brute(source_rows(spark.read.parquet(f"{sf}/documents.parquet")))


@pytest.mark.parametrize("levels", [1, 2])
def test_many_rounds(spark, levels):
    """Small blocks, so that trees take several rounds and most blocks are full."""
    rows = [(k, "s", "en" if k % 7 else "fr", k, f"Text {k}") for k in range(700)] + [(5000, "s", None, 1, "Alone")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert got(manifest.manifest(docs, at_once=levels)) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 100, 513])
def test_positions_and_logs(n):
    """Positions of all nodes are the log's places, and every proof folds to the root."""
    leaves, levels = [H(str(k)) for k in range(n)], manifest.height(n)
    log = manifest.append(leaves, levels)
    root, proofs = tree(leaves)
    places = [manifest.position(t, j, n, levels) for t in range(levels + 1) for j in range(-(-n // 8**t))]
    assert sorted(places) == list(range(len(log))) and log[-1] == root
    for leaf, path, want in zip(leaves, manifest.paths(log, n, levels), proofs, strict=True):
        assert path == [("".join(a), "".join(b)) for a, b in want]
        assert manifest.fold(leaf, path) == root


def test_log_rows_are_one_postorder_log_a_tree(spark):
    n = 300
    leaves = [H(str(k)) for k in range(n)]
    table = spark.createDataFrame([("t", k, n, d) for k, d in enumerate(leaves)] + [("u", 0, 1, H("u"))], "tree string, idx long, n long, digest string")
    rounds, roots = manifest.build(table, 1)
    rows = written(manifest.log_rows(rounds, 1)).orderBy("tree", "position").collect()
    assert [r["digest"] for r in rows if r["tree"] == "t"] == manifest.append(leaves, manifest.height(n))
    assert [r["position"] for r in rows if r["tree"] == "t"] == list(range(len(rows) - 1))
    assert {r["tree"]: r["root"] for r in roots.collect()} == {"t": rows[-2]["digest"], "u": H("u")}


def test_ids_that_hold_much_of_the_table(spark, monkeypatch):
    """Many rows without an id, many of one id, over two trees: the rows of the plain rule."""
    from slicewright.llm import order

    rows = [(None, "s", "de", k % 40, f"t{k % 40}") for k in range(90)] + [(7, "s", "en" if k % 3 else "de", k, f"U{k}") for k in range(80)] + [(k, None, "en", 1, None) for k in range(60)]
    docs = spark.createDataFrame([(i, s, lang, n, t) for i, s, lang, n, t in rows], "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    monkeypatch.setattr(order, "MANY", 20)
    assert len(order.IdSlices(docs, "doc_id").hot()) == 2
    assert got(manifest.manifest(docs)) == brute(rows)
