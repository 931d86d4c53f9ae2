"""Language identification: first the family, then pairwise linear SVMs within it.

Texts are reduced to their words of letters, in lower case, and to the counts
of their character 1- to 4-grams (words keep a space on both sides), hashed to
``BUCKETS``, square-rooted and scaled to length one.  One linear support vector
machine a family (one against the rest) predicts the language family; within
it, one machine for each pair of languages votes, and equal votes go to the
larger sum of margins.  Families are those of ``FAMILIES``; a language that is
not listed is a family of its own.

The machines are fitted on at most ``SAMPLE`` different texts, in equal shares
of at most ``LANGUAGES`` languages (the most frequent ones), drawn by text
hash; each also lends a short run of its words, so that short texts are
learnt as well.  Scoring covers every whole text in one pass without a shuffle.

Defined results: a NULL text, one without letters, and any text where nothing
could be learnt is ``und`` with score 0; rows whose language is NULL, and
those held out, teach nothing; repeated texts count once; equal texts get
equal predictions; ties go to the language that is first in order; very long
texts are counted in pieces; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS, GRAMS = 1 << 13, 4
#: Texts the machines are fitted on, and languages they tell apart, at most.
SAMPLE, LANGUAGES = 1_500, 64
#: Words of the short run that each sampled text lends as a second example.
RUN = 6
PENALTY, EPOCHS = 1.0, 20
#: Code points counted at once.
PIECE = 1 << 18
_WORD = re.compile(r"[^\W\d_]+")

# Language families by ISO 639-1 code.
FAMILIES = {
    "germanic": "en de nl af sv da no nb nn is fy lb yi".split(),
    "romance": "fr es it pt ro ca gl oc".split(),
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk".split(),
    "baltic": "lt lv".split(),
    "celtic": "ga gd cy br".split(),
    "uralic": "fi et hu".split(),
    "turkic": "tr az kk uz ky tk tt".split(),
    "indo-aryan": "hi ur bn pa gu mr ne".split(),
    "iranian": "fa ku ps tg".split(),
    "semitic": "ar he am mt".split(),
    "dravidian": "ta te kn ml".split(),
    "austronesian": "id ms tl jv".split(),
    "sinitic": "zh yue".split(),
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}


def family(lang: str) -> str:
    """Family of a language tag; its own where it is not listed."""
    return _FAMILY.get(lang.replace("_", "-").split("-")[0].lower(), lang)


def letters(text: str | None) -> str:
    """The text's words of letters, in lower case, one space around each; empty where it has none."""
    words = _WORD.findall((text or "").lower())
    return f" {' '.join(words)} " if words else ""


def counts(plain: str) -> np.ndarray:
    """Hashed 1- to ``GRAMS``-gram counts of ``letters``."""
    total = np.zeros(BUCKETS, np.int64)
    for k in range(0, len(plain), PIECE):  # a piece ends with the grams that begin in it
        codes = np.frombuffer(plain[k:k + PIECE + GRAMS - 1].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        begins = min(PIECE, len(plain) - k)
        h = np.zeros(len(codes), np.uint64)
        for n in range(GRAMS):
            h = h[:len(codes) - n] * np.uint64(0x9E3779B97F4A7C15) + codes[n:] + np.uint64(n + 1)
            mixed = (h[:begins] ^ (h[:begins] >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(51)
            total += np.bincount(mixed.astype(np.int64), minlength=BUCKETS)
    return total


def vector(plain: str) -> np.ndarray:
    """Square roots of the counts, of length one."""
    v = np.sqrt(counts(plain)).astype(np.float32)
    return v / max(float(np.linalg.norm(v)), 1e-9)


def short_run(plain: str) -> str:
    """A few words from the middle of a text."""
    words = plain.split()
    first = max(0, len(words) // 2 - RUN // 2)
    return f" {' '.join(words[first:first + RUN])} "


def svm(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY, epochs: int = EPOCHS) -> np.ndarray:
    """Weights and, last, bias of a linear machine with squared hinge loss, by dual coordinate ascent."""
    w, bias = np.zeros(x.shape[1], np.float32), 0.0
    alpha, order = np.zeros(len(x)), np.random.default_rng(7)
    diagonal = np.einsum("ij,ij->i", x, x) + 1 + 0.5 / penalty
    for _ in range(epochs):
        worst = 0.0
        for i in order.permutation(len(x)):
            g = y[i] * (float(x[i] @ w) + bias) - 1 + 0.5 / penalty * alpha[i]
            new = max(0.0, alpha[i] - g / diagonal[i])
            if (step := (new - alpha[i]) * y[i]) != 0:
                alpha[i] = new
                w += np.float32(step) * x[i]
                bias += step
                worst = max(worst, abs(step))
        if worst < 1e-3:
            break
    return np.append(w, np.float32(bias))


@dataclass
class Model:
    families: list[list[str]] = field(default_factory=list)
    by_family: np.ndarray = field(default_factory=lambda: np.zeros((0, BUCKETS + 1), np.float32))
    pairs: list[tuple[str, str]] = field(default_factory=list)
    by_pair: np.ndarray = field(default_factory=lambda: np.zeros((0, BUCKETS + 1), np.float32))

    def predict(self, plain: str) -> tuple[str, float]:
        """Language and score of the ``letters`` of a text."""
        if not plain or not self.families:
            return "und", 0.0
        v = vector(plain)
        score, k = 1.0, 0
        if len(self.families) > 1:
            margins = self.by_family[:, :-1] @ v + self.by_family[:, -1]
            k = int(np.argmax(margins))
            chance = np.exp(2 * (margins - margins[k]).astype(float))
            score = float(1 / chance.sum())
        langs = self.families[k]
        if len(langs) == 1:
            return langs[0], score
        votes, margin, sure = dict.fromkeys(langs, 0), dict.fromkeys(langs, 0.0), {}
        for (a, b), w in zip(self.pairs, self.by_pair):
            if a in votes and b in votes:
                m = float(w[:-1] @ v + w[-1])
                votes[a if m >= 0 else b] += 1
                margin[a], margin[b] = margin[a] + m, margin[b] - m
                sure[a, b] = 1 / (1 + np.exp(-2 * min(max(m, -20.0), 20.0)))
        won = max(langs, key=lambda x: (votes[x], margin[x]))  # the first of equals
        return won, score * float(np.mean([p if a == won else 1 - p for (a, b), p in sure.items() if won in (a, b)]))


def fit(x: np.ndarray, langs: list[str]) -> Model:
    """A model of example vectors and their languages."""
    named = np.array(langs, object)
    groups: dict[str, list[str]] = {}
    for lang in sorted(set(langs)):
        groups.setdefault(family(lang), []).append(lang)
    families = list(groups.values())
    model = Model(families)
    if len(families) > 1:
        model.by_family = np.stack([svm(x, np.where(np.isin(named, langs_), 1.0, -1.0)) for langs_ in families])
    model.pairs = [pair for langs_ in families for pair in combinations(langs_, 2)]
    machines = []
    for a, b in model.pairs:
        of = np.isin(named, [a, b])
        machines.append(svm(x[of], np.where(named[of] == a, 1.0, -1.0)))
    if machines:
        model.by_pair = np.stack(machines)
    return model


def train(docs: DataFrame, teaches: Column, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """A model of the rows where ``teaches`` holds and the language is known."""
    text = F.col(text_col).cast("string")
    usable = docs.where(teaches & F.col(lang_col).isNotNull() & text.rlike(r"\p{L}")).select(F.col(lang_col).cast("string").alias("lang"), F.xxhash64(text).alias("h"), text.alias("text"))
    sizes = usable.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    if not sizes:
        return Model()
    share = max(1, sample // len(sizes))
    # about three times the share by hash first, so that no language is ranked whole; then one row a text
    least = F.lit(None).cast("double")
    for r in sizes:
        least = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, 3.0 * share / max(1, r["n"])))).otherwise(least)
    place = F.pmod(F.xxhash64("h", F.lit(11)), F.lit(1 << 40)) / float(1 << 40)
    few = usable.where(place < least).dropDuplicates(["lang", "h"])

    @F.pandas_udf("at array<int>, value array<float>, run string")
    def example(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            plain = letters(t)
            v = vector(plain)
            at = np.flatnonzero(v)
            out.append((at.astype(np.int32), v[at], short_run(plain)))
        return pd.DataFrame(out, columns=["at", "value", "run"])

    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("h", F.lit(11)), "h")))
    got = ranked.where(F.col("rank") <= share).select("lang", "rank", example("text").alias("e")).select("lang", "rank", "e.*").toPandas().sort_values(["lang", "rank"])
    x = np.zeros((2 * len(got), BUCKETS), np.float32)
    for k, (at, value, run) in enumerate(zip(got["at"], got["value"], got["run"])):
        x[2 * k, np.asarray(at, np.int64)] = value
        x[2 * k + 1] = vector(run)
    return fit(x, [lang for lang in got["lang"] for _ in range(2)])


def identify(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Id, language and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most LANGUAGES families and their pairs, 32 KB each

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(letters(t)) for t in texts], columns=["lang_pred", "score"])

    return docs.select(F.col(id_col).alias("doc_id"), predict(F.col(text_col).cast("string")).alias("p")).select("doc_id", "p.lang_pred", "p.score")


__all__ = ["BUCKETS", "FAMILIES", "LANGUAGES", "SAMPLE", "Model", "counts", "family", "fit", "identify", "letters", "svm", "train", "vector"]
