"""Ordinal quality classifier: cumulative-link regression on graded ratings.

Ratings are graded 0 (toxic), 1 (poor) and 2 (good).  One weight vector over
hashed text features gives a score s, and ordered thresholds turn it into
P(grade >= k) = sigmoid(s - t_k) for k = 1, 2.  Selection uses the tail
probability of the top grade; the expected grade is the sum of both.

Features are the distinct words of the whole text, the shapes of its tokens
(runs of trailing marks, capitals, bare marks) and how much it repeats itself,
hashed to ``BUCKETS``.
The model is fitted on at most ``SAMPLE`` labelled rows, the first by a hash
of their id; buckets whose rows' mean grade does not tell them from all rows
(``TELLING`` standard errors, ``LEAST_SEEN`` rows) have no weight.
Scoring covers every row in one pass without a shuffle.

Defined results: NULL text is the empty text; labels with a NULL rating, or
of documents that are not there, are not used; repeated labels count
once each, repeated rows of an id lend the text with the smallest hash; without
any usable label every document is kept with probability 1; an empty table
gives no rows; very long texts are read whole, as one set of distinct words;
extra columns are passed through by ``score``.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import free

GRADES = 3
BUCKETS = 1 << 18
#: Labelled rows the model is fitted on, at most.
SAMPLE = 12_000
LEAST_SEEN, RIDGE, STEPS, RATE = 4, 1e-4, 200, 0.1
#: Standard errors by which the mean grade of a bucket's rows must differ from all rows' to earn a weight.
TELLING = 2.5
#: Documents are kept when the top grade is at least this likely.
SELECTED = 0.5
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Tokens whose buckets a worker remembers; its memory outlives the stage.
REMEMBERED = 200_000
_KNOWN: dict[str, tuple[int, ...]] = {}


def _bucket(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % BUCKETS


def _token(token: str) -> tuple[int, ...]:
    core = token.strip(_MARKS)
    tail = token[len(token.rstrip(_MARKS)):] if core else token
    out = [_bucket("w " + core.lower())] if core else [_bucket("m " + token)]
    if len(tail) > 1:
        out.append(_bucket("t " + tail))
    if len(core) > 1 and core.isupper():
        out.append(_bucket("capitals"))
    return tuple(out)


def features(text: str | None) -> np.ndarray:
    """Distinct buckets of a whole text, ascending."""
    if len(_KNOWN) > REMEMBERED:
        _KNOWN.clear()
    found: set[int] = set()
    tokens = (text or "").split()
    distinct = set(tokens)
    found.add(_bucket(f"repeated {10 - 10 * len(distinct) // len(tokens)}" if len(tokens) >= 20 else "short"))
    for token in distinct:
        got = _KNOWN.get(token)
        if got is None:
            got = _KNOWN[token] = _token(token)
        found.update(got)
    out = np.fromiter(found, np.int32, len(found))
    out.sort()
    return out


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # t_1 <= t_2

    def tails(self, rows: list[np.ndarray]) -> np.ndarray:
        """P(grade >= 1) and P(grade >= 2) of each row of features."""
        scores = np.array([self.weights[r].sum() for r in rows], float)
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds[None, :], -40, 40)))


def fit(rows: list[np.ndarray], grades: np.ndarray) -> Model:
    """Maximise the cumulative-link likelihood with a ridge, by Adam on all rows; thresholds stay ordered."""
    n = len(rows)
    if not n:
        return Model(np.zeros(BUCKETS, np.float32), np.full(GRADES - 1, -40.0))
    every, lengths = np.concatenate(rows), [len(r) for r in rows]
    count, total = np.bincount(every, minlength=BUCKETS), np.bincount(every, np.repeat(grades.astype(float), lengths), BUCKETS)
    off = np.abs(total - count * grades.mean()) / np.maximum(np.sqrt(count) * max(grades.std(), 1e-9), 1e-9)
    telling = (count >= LEAST_SEEN) & (off >= TELLING)
    rows = [r[telling[r]] for r in rows]
    owner, index = np.repeat(np.arange(n), [len(r) for r in rows]), np.concatenate(rows)
    used, index = np.unique(index, return_inverse=True)
    at_least = np.stack([grades >= k for k in range(1, GRADES)], 1).astype(float)
    # parameters: weights, first threshold, log gaps between thresholds
    p = np.zeros(len(used) + GRADES - 1)
    share = np.clip(at_least.mean(0), 1e-3, 1 - 1e-3)
    start = -np.log(share / (1 - share))
    p[len(used)], p[len(used) + 1:] = start[0], np.log(np.maximum(np.diff(start), 0.1))
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, STEPS + 1):
        w, gaps = p[:len(used)], np.exp(p[len(used) + 1:])
        t = p[len(used)] + np.concatenate(([0], np.cumsum(gaps)))
        s = np.bincount(owner, w[index], n)
        tail = 1 / (1 + np.exp(-np.clip(s[:, None] - t, -40, 40)))
        upper = np.concatenate((np.ones((n, 1)), tail), 1)
        lower = np.concatenate((tail, np.zeros((n, 1))), 1)
        slope_u, slope_l = upper * (1 - upper), lower * (1 - lower)
        rank = grades.astype(int)
        k = np.arange(n)
        chance = np.maximum(upper[k, rank] - lower[k, rank], 1e-9)
        up, low = slope_u[k, rank] / chance, slope_l[k, rank] / chance  # d log-likelihood: +up, -low on the score
        by_score = -(up - low) / n
        by_t = np.zeros(GRADES - 1)
        for j in range(GRADES - 1):  # threshold j bounds grade j from above and grade j + 1 from below
            by_t[j] = (np.sum(up[rank == j + 1]) - np.sum(low[rank == j])) / n
        g = np.concatenate((np.bincount(index, by_score[owner], len(used)) + RIDGE * w, [by_t.sum()], [gaps[j] * by_t[j + 1:].sum() for j in range(GRADES - 2)]))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(BUCKETS, np.float32)
    weights[used] = p[:len(used)]
    return Model(weights, p[len(used)] + np.concatenate(([0], np.cumsum(np.exp(p[len(used) + 1:])))))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    """A model of the first ``sample`` usable labels by the hash of their id."""
    grade = F.when(F.col("toxic") != 0, 0).when(F.col("quality") == 0, 1).when((F.col("quality") != 0) & (F.col("toxic") == 0), 2)
    graded = labels.select(F.col(id_col).cast("long").alias("label_id"), grade.alias("grade")).where("label_id is not null and grade is not null")
    chosen = F.broadcast(graded.orderBy(F.xxhash64("label_id"), "label_id", "grade").limit(sample))  # at most `sample` rows

    @F.pandas_udf("array<int>")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts])

    met = docs.select(F.col(id_col).cast("long").alias("label_id"), F.col(text_col).cast("string").alias("text")).join(chosen, "label_id")
    one = met.select("label_id", "grade", F.xxhash64("text").alias("h"), found("text").alias("f")).groupBy("label_id", "grade").agg(F.min_by("f", "h").alias("f"))
    got = one.orderBy(F.xxhash64("label_id"), "label_id", "grade").limit(sample).toPandas()
    return fit([np.asarray(x, np.int64) for x in got["f"]], got["grade"].to_numpy())


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` and a last column, struct ``__rated``: expected_grade, tail_probability (top grade) and not_toxic (grade >= 1)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))

    @F.pandas_udf("expected_grade double, tail_probability double, not_toxic double")
    def rate(texts: pd.Series) -> pd.DataFrame:
        tails = Model(*shared.value).tails([features(t) for t in texts])
        return pd.DataFrame({"expected_grade": tails.sum(1), "tail_probability": tails[:, -1], "not_toxic": tails[:, 0]})

    # called non-deterministic so that a filter on the result does not score every text twice
    return docs.withColumn(free(docs, "__rated"), rate.asNondeterministic()(F.col(text_col).cast("string")))


def select(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", selected: float = SELECTED) -> DataFrame:
    """The rows that the classifier keeps, with their ``__rated``."""
    scored = score(docs, train(docs, labels, id_col, text_col), text_col)
    return scored.where(F.col(scored.columns[-1])["tail_probability"] >= selected)


__all__ = ["BUCKETS", "GRADES", "Model", "SAMPLE", "SELECTED", "features", "fit", "score", "select", "train"]
