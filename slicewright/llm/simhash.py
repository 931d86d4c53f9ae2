"""SimHash near-duplicates: 64-bit fingerprints linked at a small Hamming distance.

Candidates come from an inverted index on byte positions.  Two fingerprints at
most two bits apart share at least six of their eight positional bytes; with
the bytes in four pairs, at least two pairs are whole.  Every distinct
fingerprint is posted under the six choices of two byte pairs (a choice and
its four bytes are one posting key), the positional bytes that two fingerprints
of a list share are tallied, pairs with fewer than the guaranteed matches are
dropped and the rest are verified by their bit distance.

Equal fingerprints are one node from the start, so copies cost nothing.  A
list sends on a spanning forest of its links, never all pairs.  Lists longer
than ``LIST_MOST`` take an exact way whose groups are bounded by nature:
fingerprints at most two bits apart share a value at most one bit away from
both, and at most 65 distinct fingerprints lie around a value.

Links become components by alternating large-star and small-star steps, each
written to the checkpoint folder.

Keys that hold much of a table (copies of one text, a long posting list, the
hub of a large component) are counted first and their rows dealt over salts,
so no join sees them in one task.

Defined results: NULL text is the empty text (fingerprint zero, linked like
any other); NULL ids never name a component unless all its ids are NULL;
repeated rows keep their number; a very long text is hashed whole, in blocks of
shingles; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hot import at_every_salt, dealt, hot_keys

SHINGLE, MAX_BITS, SEED = 3, 2, 42
#: Posting lists up to this length are compared directly; longer ones take the exact way round.
LIST_MOST = 64
#: Positional bytes that fingerprints at most MAX_BITS bits apart are sure to share.
LEAST_BYTES = 8 - MAX_BITS


def text_fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Fingerprint of one text as a signed 64-bit integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[k:] for k in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 14):
        part = hashes[k:k + (1 << 14)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row's whole text as a signed long."""

    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([text_fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), fingerprint(text_col).alias("fp"))


def _bytes(fp: Column, positions: tuple[int, ...]) -> Column:
    mask = sum(0xFF << 8 * p for p in positions)
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def _forest(values: list[int], max_bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest over fingerprints of one posting list."""
    v = np.sort(np.asarray(values, np.int64)).view(np.uint64)
    apart = v[:, None] ^ v[None, :]
    shared = (apart.view(np.uint8).reshape(len(v), len(v), 8) == 0).sum(2)
    near = (shared >= 8 - max_bits) & (np.bitwise_count(apart) <= max_bits)
    links, left = [], np.ones(len(v), bool)
    while left.any():
        k = int(left.argmax())
        left[k] = False
        reached = [k]
        while reached:
            x = reached.pop()
            new = np.flatnonzero(near[x] & left)
            left[new] = False
            links += [(int(v[x].view(np.int64)), int(v[y].view(np.int64))) for y in new]
            reached += new.tolist()
    return links


def _met(rows: DataFrame, partners: DataFrame, key: str, by: list[str], total: int) -> DataFrame:
    """``rows`` with the partner of their ``key``; ``partners`` has one row a key, with the number ``n`` of its rows."""
    hot = hot_keys(partners, key, total)
    return dealt(rows, key, hot, by).join(at_every_salt(partners.drop("n"), key, hot), [key, "salt"]).drop("salt")


def links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links that connect exactly the distinct fingerprints ``fp`` within ``max_bits`` (at most 2)."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the index guarantees matches for at most 2 differing bits")
    pairs = list(combinations(range(4), 2))
    keys = F.array(*(F.struct(F.lit(k).alias("choice"), _bytes(F.col("fp"), (2 * a, 2 * a + 1, 2 * b, 2 * b + 1)).alias("key")) for k, (a, b) in enumerate(pairs)))
    posting = F.xxhash64("choice", "key")  # names a list where salts are dealt
    posted = nodes.select("fp", F.explode(keys).alias("p")).select("p.choice", "p.key", "fp").withColumn("posting", posting)
    sizes = posted.groupBy("choice", "key").agg(F.count("*").alias("n")).where("n > 1")
    hot = hot_keys(sizes.withColumn("posting", posting), "posting", nodes.count())
    at = at_every_salt(sizes.withColumn("posting", posting), "posting", hot)
    listed = dealt(posted, "posting", hot, ["fp"]).join(at.drop("posting"), ["choice", "key", "salt"])

    @F.pandas_udf("array<struct<a:long,b:long>>")
    def forest(lists: pd.Series) -> pd.Series:
        return pd.Series([_forest(x, max_bits) for x in lists])

    short = (
        listed.where(F.col("n") <= LIST_MOST).groupBy("choice", "key").agg(F.collect_list("fp").alias("fps"))
        .select(F.explode(forest("fps")).alias("l")).select("l.a", "l.b")
    )
    long = listed.where(F.col("n") > LIST_MOST).select("fp").distinct()
    flips = long.select("fp", F.explode(F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit(1 << k if k < 63 else -(1 << 63))) for k in range(64)))).alias("value"))
    if max_bits == 2:
        around = (
            flips.groupBy("value").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
            .select("a", F.explode("fps").alias("b")).where("a != b")
        )
    else:
        around = flips.join(nodes.select(F.col("fp").alias("value")), "value").select(F.col("fp").alias("a"), F.col("value").alias("b")).where(f"a < b and {max_bits} = 1")
    return short.union(around).distinct()


def components(edges: DataFrame, most_rounds: int = 64) -> DataFrame:
    """(node, root): for every node of ``edges`` (a, b) the smallest node that it reaches."""

    def star(e: DataFrame, large: bool, size: int) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        met = _met(both, least, "u", ["v"], size)
        out = met.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")) if large else met.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.where("a != b").distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = edges.where("a != b").checkpoint()
    before = mark(edges)
    for _ in range(most_rounds):
        if not before[0]:
            break
        edges = star(star(edges, True, 2 * before[0]), False, before[0]).checkpoint()
        now = mark(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable) of every row."""
    rows = fingerprints(docs, id_col, text_col, shingle).checkpoint()
    total = rows.count()
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("lowest"), F.count("*").alias("n"))
    found = components(links(nodes.select("fp"), max_bits))
    rooted = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("lowest").alias("component_id"), F.count("*").alias("n"))
    linked = _met(rooted.select("fp", "root", F.col("n").alias("rows")), named, "root", ["fp"], total).select("fp", "component_id", F.col("rows").alias("n"))
    # rows that share a fingerprint differ by nothing but their id: NULL ids are dealt by a number of their own
    numbered = rows.withColumn("dealt_by", F.monotonically_increasing_id())
    return _met(numbered, linked, "fp", ["dealt_by"], total).select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


__all__ = ["LEAST_BYTES", "LIST_MOST", "MAX_BITS", "SHINGLE", "components", "fingerprints", "hex_fingerprint", "links", "near_duplicates", "text_fingerprint"]
