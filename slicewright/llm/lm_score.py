"""Stupid-backoff scores from corpus-wide n-gram counts.

    S(w | v) = c(v w) / c(v)   if c(v w) >= LEAST_COUNT
             = 0.4 * c(w) / N  otherwise;   S(w) = c(w) / N for a first word

and a document's score is the sum of log S over its words.  All counts cover
the whole corpus.

Word counts are combined per task and summed by hash.  Bigrams are exploded
once, sent to count partitions, counted there, and answered there with their
part of each document's sum.  A pair whose second word is rarer than the
``CODED`` most frequent ones goes to the partition of that word's hash, as does
such a word at the start of a document: so all its occurrences meet, and its
own count is known there too.  Other pairs go by the hash of both words.  The
one thing a count partition cannot know, log c of a rarer first word of a pair
that is seen often enough, leaves as a (word, document) row that is joined
to the word table.  Two bounded tables keep common n-grams out of the shuffle:
log counts of the ``CODED`` most frequent words, which also stand for
themselves as short codes, and the counts of all pairs of the ``PAIRED`` most
frequent words.  Every other pair holds a word outside ``PAIRED``, so no
count partition is swamped by one pair.  Both tables only shorten the way;
any other size gives the same scores.

Exploded n-grams travel packed, one row per batch and count partition, with
the documents as offsets from the batch's first row; a long document is one run of
a batch, whatever its length.

Defined results: words are runs between ASCII blanks of the lower-cased text;
NULL or empty text has no words and the score 0 (mean NULL); repeated rows
count as documents of their own; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import written

LEAST_COUNT, BACKOFF = 2, 0.4
#: Most frequent words (at most 65,536) that have a code and a broadcast count, and those whose pairs have one.
CODED, PAIRED = 1 << 16, 1 << 10
#: Words that are packed together, and distinct hashes that a task counts before it passes them on.
BATCH, COUNTED = 400_000, 800_000
#: Count partitions for each of the session's shuffle partitions: one is held in a task's memory, unpacked.
FINER = 4
#: Set in the hash of a word without a code, so that no hash equals a code.
_RARE = np.uint64(1 << 63)
#: Stands before the first word of a document; neither a code nor a hash.
_BEGIN = np.uint64(1 << 62)


def word_hashes(text: str | None) -> np.ndarray:
    words = (text or "").lower().encode("utf-8", "surrogatepass").split()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)) | _RARE


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def _combined(batches: Iterator[np.ndarray], name: str) -> Iterator[pd.DataFrame]:
    """(name, n) of the values in ``batches``, combined as long as few are distinct."""
    values, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for new in batches:
        v, c = np.unique(new, return_counts=True)
        merged, at = np.unique(np.concatenate((values, v)), return_inverse=True)
        values, counts = merged, np.bincount(at, np.concatenate((counts, c)), len(merged)).astype(np.int64)
        if len(values) > COUNTED:
            yield pd.DataFrame({name: values.view(np.int64), "n": counts})
            values, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    yield pd.DataFrame({name: values.view(np.int64), "n": counts})


def _packs(pdf: pd.DataFrame) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Rows of a batch in runs of about ``BATCH`` words: (first row, hashes of each row)."""
    run, first, size = [], 0, 0
    for k, text in enumerate(pdf["text"]):
        run.append(word_hashes(text))
        size += len(run[-1])
        if size >= BATCH or len(run) > 60_000:
            yield first, run
            run, first, size = [], k + 1, 0
    if run:
        yield first, run


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n): the count of every word hash."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _combined((np.concatenate(run) for pdf in batches for _, run in _packs(pdf)), "word")

    return _texts(docs, text_col).mapInPandas(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """The most frequent words: ``hashes`` ascending, their codes (rank) and log counts by code."""

    hashes: np.ndarray
    codes: np.ndarray
    logs: np.ndarray
    total: int

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """The code of a word, or its hash."""
        if not len(self.hashes):
            return hashes
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.codes[at], hashes)


def vocabulary(counts: DataFrame, coded: int = CODED) -> Vocabulary:
    total = counts.agg(F.sum("n")).first()[0] or 0
    top = counts.orderBy(F.desc("n"), "word").limit(coded).toPandas()  # at most `coded` rows
    hashes = top["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Vocabulary(hashes[order], order.astype(np.uint64), np.log(top["n"].to_numpy(float)), int(total))


def pair_counts(docs: DataFrame, words: Vocabulary, text_col: str = "text", paired: int = PAIRED) -> np.ndarray:
    """Counts of all pairs of the ``paired`` most frequent words, as a matrix by code."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def frequent(run: list[np.ndarray]) -> np.ndarray:
        ids = shared.value.ids(np.concatenate(run))
        inside = np.ones(len(ids), bool)
        inside[_starts(run)] = False
        a, b = ids[:-1], ids[1:]
        keep = (a < paired) & (b < paired) & inside[1:]
        return a[keep] * np.uint64(paired) + b[keep]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _combined((frequent(run) for pdf in batches for _, run in _packs(pdf)), "pair")

    found = _texts(docs, text_col).mapInPandas(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()  # at most paired ** 2 rows
    out = np.zeros(paired * paired, np.int64)
    out[found["pair"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return out


def _starts(run: list[np.ndarray]) -> np.ndarray:
    """Positions of first words in the concatenated run."""
    at = np.cumsum([0, *(len(r) for r in run[:-1])])
    return at[[k for k, r in enumerate(run) if len(r)]]


#: Rows of the exploded n-grams: a document's own part, a packed run of pairs, or a rarer word to look up.
_EXPLODED = "part int, row long, doc_id string, n_tokens long, score double, word long, weight long, coded binary, coded_rows binary, first binary, second binary, mixed_rows binary"
_ANSWERED = "row long, doc_id string, n_tokens long, score double, word long, weight long"


def _frame(schema: str, **columns) -> pd.DataFrame:
    """Columns of a schema; absent numbers are 0, as pandas would turn 64-bit hashes beside a NULL into floats."""
    n = len(next(iter(columns.values())))
    none = {"int": 0, "long": 0, "double": 0.0}
    return pd.DataFrame({name: columns.get(name, [none.get(kind)] * n) for name, kind in (c.split() for c in schema.split(", "))})


def exploded(docs: DataFrame, words: Vocabulary, pairs: np.ndarray, parts: int, id_col: str = "doc_id", text_col: str = "text", paired: int = PAIRED) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((words, pairs))

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab, matrix = shared.value
        for pdf in batches:
            rows, names = pdf["row"].to_numpy(np.int64), pdf["doc_id"].to_numpy()
            for begin, run in _packs(pdf):
                lengths = np.array([len(r) for r in run])
                ids = vocab.ids(np.concatenate(run))
                doc = np.repeat(np.arange(len(run), dtype=np.uint16), lengths)
                starts = _starts(run)
                base = int(rows[begin])
                if int(rows[begin + len(run) - 1]) != base + len(run) - 1:
                    raise ValueError("row numbers of a batch have gaps")
                score = np.zeros(len(run))
                # first words
                first, coded = ids[starts], ids[starts] < _RARE
                np.add.at(score, doc[starts[coded]], vocab.logs[first[coded].astype(np.int64)])
                np.add.at(score, doc[starts], -np.log(max(vocab.total, 1)))
                inner = np.ones(len(ids), bool)
                inner[starts] = False
                b_at = np.flatnonzero(inner)
                a, b, d = ids[b_at - 1], ids[b_at], doc[b_at]
                # pairs of the most frequent words
                both = (a < paired) & (b < paired)
                x, y = a[both].astype(np.int64), b[both].astype(np.int64)
                n = matrix[x * paired + y]
                value = np.where(n >= LEAST_COUNT, np.log(np.maximum(n, 1)) - vocab.logs[x], np.log(BACKOFF) + vocab.logs[y] - np.log(max(vocab.total, 1)))
                score += np.bincount(d[both], value, len(run))
                spread = np.arange(begin, begin + len(run)) % parts
                yield _frame(_EXPLODED, part=spread, row=rows[begin:begin + len(run)], doc_id=names[begin:begin + len(run)], n_tokens=lengths, score=score)
                # the other pairs, and rarer first words, packed by count partition
                rare = starts[~coded]
                a, b, d = (np.concatenate(x) for x in ((a[~both], np.full(len(rare), _BEGIN)), (b[~both], ids[rare]), (d[~both], doc[rare])))
                of = (np.where(b < _RARE, _mixed(a, b), _mixed(b, b)) >> np.uint64(33)) % np.uint64(parts)
                short = (a < _RARE) & (b < _RARE)
                order = np.argsort(of.astype(np.uint32), kind="stable")
                a, b, d, of, short = a[order], b[order], d[order], of[order].astype(np.int64), short[order]
                edges = np.flatnonzero(np.diff(of, prepend=-1, append=-1)) if len(of) else []
                out = []
                for lo, hi in zip(edges[:-1], edges[1:]):
                    s, t = short[lo:hi], ~short[lo:hi]
                    key = (a[lo:hi][s] << np.uint64(16) | b[lo:hi][s]).astype("<u4")
                    out.append((int(of[lo]), key.tobytes(), d[lo:hi][s].tobytes(), a[lo:hi][t].tobytes(), b[lo:hi][t].tobytes(), d[lo:hi][t].tobytes()))
                if out:
                    part, *blobs = map(list, zip(*out))
                    yield _frame(_EXPLODED, part=part, row=[base] * len(part), **dict(zip(("coded", "coded_rows", "first", "second", "mixed_rows"), blobs)))

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("string").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInPandas(explode, _EXPLODED)


def answered(ngrams: DataFrame, words: Vocabulary, parts: int) -> DataFrame:
    """Each count partition's share of the documents' sums, and the rarer words it needs."""
    logs, total = words.logs, max(words.total, 1)
    shared = ngrams.sparkSession.sparkContext.broadcast(logs)

    def part_of(firsts: list, seconds: list, owners: list) -> Iterator[pd.DataFrame]:
        log = shared.value
        a, b, row = np.concatenate(firsts).astype(np.uint64), np.concatenate(seconds).astype(np.uint64), np.concatenate(owners)
        _, at, n = np.unique(_mixed(a, b), return_inverse=True, return_counts=True)
        n, first, rare = n[at], a == _BEGIN, b >= _RARE
        _, at, count = np.unique(b[rare], return_inverse=True, return_counts=True)
        second = np.zeros(len(b))  # log count of the second word, or of a document's first
        second[rare], second[~rare] = np.log(count)[at], log[b[~rare].astype(np.int64)]
        hit = ~first & (n >= LEAST_COUNT)
        value = np.where(first, second, np.log(BACKOFF) + second - np.log(total))
        value[hit] = np.log(n[hit])
        known = hit & (a < _RARE)
        value[known] -= log[a[known].astype(np.int64)]
        who, at = np.unique(row, return_inverse=True)
        yield _frame(_ANSWERED, row=who, score=np.bincount(at, value))
        asked = hit & ~known  # rarer words whose count is to be taken off, added up per document
        if asked.any():
            pairs = np.stack((row[asked].view(np.uint64), a[asked]))
            pairs, weight = np.unique(pairs, axis=1, return_counts=True)
            yield _frame(_ANSWERED, row=pairs[0].view(np.int64), word=pairs[1].view(np.int64), weight=-weight)

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, gathered = None, ([], [], [])
        for pdf in batches:
            plain = pdf["coded"].isna()
            if plain.any():
                yield pdf.loc[plain, ["row", "doc_id", "n_tokens", "score", "word", "weight"]]
            packed = pdf[~plain]
            for now, base, coded, coded_rows, first, second, mixed_rows in zip(*(packed[c] for c in ("part", "row", "coded", "coded_rows", "first", "second", "mixed_rows"))):
                if now != part and gathered[0]:  # a part is whole: rows come sorted by part
                    yield from part_of(*gathered)
                    gathered = ([], [], [])
                part, key = now, np.frombuffer(coded, "<u4")
                gathered[0].extend((key >> np.uint32(16), np.frombuffer(first, np.uint64)))
                gathered[1].extend((key & np.uint32(0xFFFF), np.frombuffer(second, np.uint64)))
                gathered[2].extend(int(base) + np.frombuffer(x, np.uint16).astype(np.int64) for x in (coded_rows, mixed_rows))
        if gathered[0]:
            yield from part_of(*gathered)

    return ngrams.repartition(parts, "part").sortWithinPartitions("part").mapInPandas(answer, _ANSWERED)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", coded: int = CODED, paired: int = PAIRED) -> DataFrame:
    """doc_id, n_tokens, log_score and mean_log_score of every row."""
    spark = docs.sparkSession
    counts = written(word_counts(docs, text_col))
    words = vocabulary(counts, coded)
    paired = min(paired, coded)
    pairs = pair_counts(docs, words, text_col, paired)
    parts = FINER * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = written(answered(exploded(docs, words, pairs, parts, id_col, text_col, paired), words, parts))
    # a word's hash has its top bit set and is never 0
    looked_up = shares.where("word != 0").select("row", "word", "weight").join(counts, "word").select("row", (F.col("weight") * F.log("n")).alias("score"))
    whole = shares.where("word = 0").select("row", "doc_id", "n_tokens", "score").unionByName(looked_up, allowMissingColumns=True)
    summed = whole.groupBy("row").agg(F.max("doc_id").cast("long").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.sum("score").alias("log_score"))
    return summed.select("doc_id", "n_tokens", "log_score", F.when(F.col("n_tokens") > 0, F.col("log_score") / F.col("n_tokens")).alias("mean_log_score"))


__all__ = ["BACKOFF", "LEAST_COUNT", "pair_counts", "score", "vocabulary", "word_counts", "word_hashes"]
