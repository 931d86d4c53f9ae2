import numpy as np
from pyspark.sql import functions as F

from slicewright.llm import language, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "n_chars")
    rows = queries.op11_language(spark, SF).join(docs, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == docs.count() and 0.2 < len(held) / len(rows) < 0.3
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edges(spark, edge_docs, no_docs):
    teaches = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    docs = edge_docs.withColumn("lang", F.when(F.col("part") % 3 == 0, "fr").otherwise(F.col("lang"))).withColumn("a.b", F.lit(1)).withColumn("rank", F.lit(1)).withColumn("h", F.lit(1)).withColumn("e", F.lit(1))
    got = language.identify(docs, language.train(docs, teaches)).collect()
    assert len(got) == docs.count()
    by_id = {r["doc_id"]: r for r in got}
    assert all(by_id[k]["lang_pred"] == "und" and by_id[k]["score"] == 0 for k in (0, 1, 3))
    assert by_id[5]["lang_pred"] == by_id[6]["lang_pred"] in ("en", "fr") and by_id[5]["score"] == by_id[6]["score"]
    nothing = language.train(no_docs, teaches)
    assert {r["lang_pred"] for r in language.identify(docs, nothing).collect()} == {"und"}
    assert language.identify(no_docs, nothing).count() == 0


def test_prediction_knows_only_the_text(spark):
    """Other ids, sources and languages at prediction change nothing."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.train(docs, F.lit(True))
    a = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(docs, model).collect()}
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")).withColumn("doc_id", F.col("doc_id") + 1_000_000)
    assert {r["doc_id"] - 1_000_000: (r["lang_pred"], r["score"]) for r in language.identify(other, model).collect()} == a


def test_counts_do_not_depend_on_pieces(monkeypatch):
    plain = language.letters("Ein Wort, zwei Wörter; " * 40)
    whole = language.counts(plain)
    monkeypatch.setattr(language, "PIECE", 17)
    assert (language.counts(plain) == whole).all() and whole.sum() == sum(len(plain) - n for n in range(language.GRAMS))


def test_families_and_pairs():
    words = {"en": "the and of with", "de": "und der die nicht", "nl": "het een van niet", "fr": "les une dans pour", "xx": "zqa zqe zqi zqo"}
    langs, rows, rng = [], [], np.random.default_rng(1)
    for lang, text in words.items():
        for _ in range(30):
            langs.append(lang)
            rows.append(language.vector(language.letters(" ".join(rng.choice(text.split(), 5)))))
    model = language.fit(np.stack(rows), langs)
    assert model.families == [["de", "en", "nl"], ["fr"], ["xx"]] and model.pairs == [("de", "en"), ("de", "nl"), ("en", "nl")]
    for lang, text in words.items():
        got, score = model.predict(language.letters(text))
        assert got == lang and 0.3 < score <= 1
    assert model.predict(language.letters("1234 %&!")) == ("und", 0.0)


def test_separable_machine():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 12)).astype(np.float32)
    y = np.where(x[:, 0] + 2 * x[:, 1] > 0.2, 1.0, -1.0)
    x += np.outer(y, np.eye(12)[1] * 0.5).astype(np.float32)
    w = language.svm(x, y, epochs=200)
    assert np.mean(np.sign(x @ w[:-1] + w[-1]) == y) > 0.98
