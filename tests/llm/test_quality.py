import random

import numpy as np

from slicewright.llm import quality


def graded(rng, grade):
    words = [f"w{rng.randrange(200)}" for _ in range(rng.randint(20, 90))]
    if grade == 0:
        words[rng.randrange(len(words))] = rng.choice(["vile", "Awful", "nasty!"])
    if grade == 1:
        words = [w + rng.choice(["%%%", "###"]) for w in words]
    return " ".join(words)


def test_held_out_accuracy_and_order():
    rng = random.Random(5)
    grades = np.array([rng.choice([0, 1, 2, 2, 2]) for _ in range(1500)])
    rows = [quality.features(graded(rng, g)).astype(np.int64) for g in grades]
    model = quality.fit(rows[:1000], grades[:1000])
    assert model.thresholds[0] <= model.thresholds[1]
    tails = model.tails(rows[1000:])
    assert (tails[:, 0] >= tails[:, 1]).all()
    keep = tails[:, 1] >= quality.SELECTED
    held = grades[1000:]
    assert keep[held == 2].mean() > 0.95 and keep[held < 2].mean() < 0.05
    expected = tails.sum(1)
    assert expected[held == 2].mean() > expected[held == 1].mean()


def test_gradient_fits_thresholds_without_features():
    grades = np.array([0] * 10 + [1] * 30 + [2] * 60)
    tails = quality.fit([np.zeros(0, np.int64)] * 100, grades).tails([np.zeros(0, np.int64)])[0]
    assert abs(tails[0] - 0.9) < 0.02 and abs(tails[1] - 0.6) < 0.02


def test_documents_held_out(spark):
    path = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    trained = labels.where("doc_id % 4 != 0")
    kept = {r["doc_id"] for r in quality.select(docs, trained).select("doc_id").collect()}
    rows = labels.join(docs.select("doc_id"), "doc_id").where("doc_id % 4 = 0").collect()
    toxic = [r["doc_id"] in kept for r in rows if r["toxic"]]
    good = [r["doc_id"] in kept for r in rows if not r["toxic"] and r["quality"]]
    poor = [r["doc_id"] in kept for r in rows if not r["toxic"] and not r["quality"]]
    assert np.mean(toxic) < 0.1 and np.mean(good) > 0.97 and np.mean(poor) < 0.25


def test_edges(spark, edge_docs, edge_rows, no_docs):
    labels = spark.createDataFrame([(100, 1, 0), (101, 0, 0), (101, 0, 0), (102, None, 0), (103, 1, None), (None, 1, 0), (999, 1, 0), (7, 1, 1), (8, 0, 0)], "doc_id long, quality int, toxic int")
    scored = quality.score(edge_docs, quality.train(edge_docs, labels)).select("doc_id", "__rated.*").collect()
    assert len(scored) == len(edge_rows) and all(0 <= r["tail_probability"] <= r["not_toxic"] <= 1 for r in scored)
    again = quality.score(edge_docs, quality.train(edge_docs, labels)).select("doc_id", "__rated.*").collect()
    assert sorted(map(str, scored)) == sorted(map(str, again))
    assert quality.select(edge_docs, labels.limit(0)).count() == len(edge_rows)  # no label: all stay
    assert quality.select(no_docs, labels).count() == 0


def test_sample_is_bounded(spark):
    docs = spark.range(50).selectExpr("id as doc_id", "concat('t', id) as text")
    labels = spark.range(50).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    assert isinstance(quality.train(docs, labels, sample=5), quality.Model)


def likelihood(weights, thresholds, rows, grades):
    """Mean log-likelihood less the ridge, one row at a time."""
    out = 0.0
    for row, g in zip(rows, grades):
        s = sum(float(weights[b]) for b in row)
        at_least = [1.0, *(1 / (1 + np.exp(-(s - t))) for t in thresholds), 0.0]
        out += np.log(max(at_least[g] - at_least[g + 1], 1e-12))
    return out / len(rows) - quality.RIDGE / 2 * float((weights.astype(float) ** 2).sum())


def test_scores_match_a_plain_sum_for_every_document(spark):
    """The query's grades from the model's weights, counted word by word in plain Python."""
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.train(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in quality.score(docs, model).select("doc_id", "__rated.*").collect():
        tokens = (texts[r["doc_id"]] or "").split()
        names = {f"repeated {10 - 10 * len(set(tokens)) // len(tokens)}" if len(tokens) >= 20 else "short"}
        for t in set(tokens):
            core = t.strip(quality._MARKS)
            names.add("w " + core.lower() if core else "m " + t)
            tail = t[len(t.rstrip(quality._MARKS)):] if core else t
            if len(tail) > 1:
                names.add("t " + tail)
            if len(core) > 1 and core.isupper():
                names.add("capitals")
        s = sum(float(model.weights[b]) for b in {quality._bucket(n) for n in names})
        tails = [1 / (1 + np.exp(-np.clip(s - t, -40, 40))) for t in model.thresholds]
        assert abs(r["tail_probability"] - tails[1]) < 1e-5 and abs(r["not_toxic"] - tails[0]) < 1e-5 and abs(r["expected_grade"] - sum(tails)) < 1e-5


def test_fit_is_near_the_best_likelihood():
    """No step of a weight or threshold, either way, improves the plain likelihood by much."""
    rng = random.Random(9)
    grades = np.array([rng.choice([0, 1, 2]) for _ in range(600)])
    rows = [quality.features(graded(rng, g)).astype(np.int64) for g in grades]
    model = quality.fit(rows, grades)
    best = likelihood(model.weights, model.thresholds, rows, grades)
    assert best > likelihood(np.zeros_like(model.weights), model.thresholds, rows, grades)
    used = np.flatnonzero(model.weights).tolist()
    for b in rng.sample(used, min(5, len(used))):
        for step in (-0.3, 0.3):
            w = model.weights.copy()
            w[b] += step
            assert likelihood(w, model.thresholds, rows, grades) < best + 2e-3
    for k in range(2):
        for step in (-0.2, 0.2):
            t = model.thresholds.copy()
            t[k] += step
            assert t[0] > t[1] or likelihood(model.weights, t, rows, grades) < best + 2e-3
