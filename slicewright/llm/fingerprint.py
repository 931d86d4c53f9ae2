"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every 32-bit shingle hash below 2**32 / ``SCALE``, the same
fraction for any document, so sketches of very unequal texts can be compared:
the share of a short text's hashes found in a long one estimates containment.
Sketches merge exactly: the sketch of two texts' shingles together is the
union of theirs.  Short texts have few hashes; with half of all kept, a
likeness of 0.6 is off by 0.2 or more for about one text in six of ten
shingles, and one in a hundred of forty.

``with_next`` pairs every document with the next one by id.  Rows go once to
range parts by id; a part's first row is also sent to the part before it, so
neighbours always meet, and each task streams its rows in order, holding two
documents at a time.

Defined results: NULL text is the empty text, whose sketch is empty, as may be
that of a few words; nothing tells two empty sketches apart (1.0), an empty
and another have nothing in common (0.0); a text of fewer than ``SHINGLE``
words has one shingle; very long texts are sketched whole, one at a time; rows that share an id are in the order
of their texts; NULL ids come first; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .order import NO_ID, IdSlices, element

SHINGLE, SCALE = 5, 2
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct 32-bit hashes of the lower-cased word shingles, ascending."""
    digest = xxhash.xxh64_intdigest
    words = np.fromiter(map(digest, text.lower().encode("utf-8", "surrogatepass").split()), np.uint64)
    if not len(words):
        return np.zeros(0, np.uint32)
    n = max(1, len(words) - shingle + 1)
    h = np.zeros(n, np.uint64)
    for k in range(min(shingle, len(words))):
        h = (h ^ words[k:k + n]) * _STEP
        h ^= h >> np.uint64(29)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(((h ^ (h >> np.uint64(31))) >> np.uint64(32)).astype(np.uint32))


def scaled(hashes: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sketch of distinct ascending hashes."""
    return hashes[hashes < 2**32 // scale] if scale > 1 else hashes


def sketch(text: str, shingle: int = SHINGLE, scale: int = SCALE) -> np.ndarray:
    return scaled(shingle_hashes(text, shingle), scale)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.union1d(a, b)


def encode(s: np.ndarray) -> str:
    return s.astype(">u4").tobytes().hex()


def decode(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of all shingles that both have."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / total if (total := len(a) + len(b) - both) else 1.0


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the shingles of a that b has too."""
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else 1.0


def edited(text: str, other: str) -> str:
    """The last quarter of the code points replaced by the first as many (or all) of ``other``."""
    cut = len(text) // 4
    return text[:len(text) - cut] + other[:cut]


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Fingerprint of every row and of its edited text, and their likeness to it and to the next row."""
    spark = docs.sparkSession
    slices = IdSlices(docs, id_col)
    of_slice, heads = slices.parts(parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions()))
    n = max(1, len(heads))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("part", element(of_slice, slices.of("doc_id")).cast("int"))
    is_head = F.coalesce("doc_id", F.lit(NO_ID)) == element(heads or [NO_ID], F.col("part"))
    at_home, before = F.struct("part", F.lit(0).alias("beyond")), F.struct(((F.col("part") + n - 1) % n).alias("part"), F.lit(1).alias("beyond"))
    sent = rows.withColumn("to", F.explode(F.when(is_head, F.array(at_home, before)).otherwise(F.array(at_home))))
    dealt = sent.select("doc_id", "text", "to.part", "to.beyond").repartition(n, "part")
    ordered = dealt.sortWithinPartitions("part", "beyond", F.col("doc_id").asc_nulls_first(), "text")

    def one(row: tuple, mine: np.ndarray, after: tuple, theirs: np.ndarray) -> tuple:
        text = edited(row[1], after[1])
        new = sketch(text)
        sha = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
        return row[0], len(row[1]), sha, encode(mine), encode(new), likeness(mine, new), likeness(mine, theirs), containment(mine, theirs)

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "held_by_next"]
        held = None  # (id, text, part, beyond) and its sketch
        for pdf in batches:
            out = []
            for row in zip(pdf["doc_id"], pdf["text"], pdf["part"], pdf["beyond"]):
                if held and held[0][2] == row[2] and held[0][3]:
                    continue  # a repeated row of the next part's first id
                s = sketch(row[1])
                if held and held[0][2] == row[2]:
                    out.append(one(*held, row, s))
                held = (row, s)
            if out:
                yield pd.DataFrame(out, columns=names)

    out = ordered.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(
        stream, "doc_id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, held_by_next double")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


__all__ = ["SCALE", "SHINGLE", "containment", "decode", "edited", "encode", "likeness", "merged", "sketch", "with_next"]
