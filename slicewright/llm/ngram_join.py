"""Stupid-backoff scores by joins: n-gram count tables joined to exploded n-grams, summed per document.

    S_k = c(k-gram) / c(its first k - 1 words)   if c(k-gram) >= least_count
        = 0.4 * S_(k-1)                          otherwise;   S_1 = c(word) / N

Every text is exploded into its n-grams of 1 to ``order`` words, each known by
a hash, the place of its last word and its length.  Their counts over the whole
corpus form one table partitioned by hash; joined back, they give every place
its counts, and the place before it those of the contexts.  DataFrame
functions only, for any order.

This is the plain form.  Every n-gram is shuffled with its place and comes back
with its count, so the disk it takes is a multiple of the text (the README has
figures); ``lm_score`` gives the same scores for ``order`` = 2 in less.

Defined results: words are runs between ASCII blanks of the lower-cased text;
NULL or empty text has no words and the score 0 (mean NULL); repeated rows
count as documents of their own; the first places of a document have as many
words before them as there are; an n-gram that holds a great part of all rows
is spread over salts in the join; a long document's places are sorted in one
task, on disk if need be; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .hot import at_every_salt, dealt, hot_keys
from .scratch import written

ORDER, LEAST_COUNT, BACKOFF = 3, 1, 0.4


def exploded(docs: DataFrame, order: int = ORDER, text_col: str = "text") -> DataFrame:
    """(row, pos, size, hash): the n-grams of each row that end at each place."""
    words = F.split(F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), r"[ \t\n\x0b\f\r]+")
    hashed = F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))
    rows = docs.select("row", hashed.alias("words")).select("row", F.posexplode("words").alias("pos", "last"), "words")
    grams = [F.struct(F.lit(k).alias("size"), F.expr(f"xxhash64({k}, slice(words, greatest(1, pos - {k} + 2), {k}))").alias("hash")) for k in range(1, order + 1)]
    sized = rows.select("row", "pos", F.explode(F.filter(F.array(*grams), lambda g: g["size"] <= F.col("pos") + 1)).alias("g"))
    return sized.select("row", "pos", F.col("g.size").alias("size"), F.col("g.hash").alias("hash"))


def count_table(ngrams: DataFrame) -> DataFrame:
    """(hash, n): combined on the map side, partitioned by hash."""
    return ngrams.groupBy("hash").agg(F.count("*").alias("n"))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, least_count: int = LEAST_COUNT) -> DataFrame:
    """doc_id, n_tokens, log_score and mean_log_score of every row."""
    # numbered once and written: a row keeps its number in every later pass
    rows = written(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    ngrams = exploded(rows, order)
    counts = written(count_table(ngrams))
    places = ngrams.where("size = 1").count()  # N
    hot = hot_keys(counts, "hash", places * order)
    met = dealt(ngrams, "hash", hot, ["row", "pos"]).join(at_every_salt(counts, "hash", hot), ["hash", "salt"])
    wide = met.groupBy("row", "pos").agg(*(F.max(F.when(F.col("size") == k, F.col("n"))).alias(f"c{k}") for k in range(1, order + 1)))
    before = Window.partitionBy("row").orderBy("pos")
    here = wide.select("*", *(F.lag(f"c{k}").over(before).alias(f"context{k + 1}") for k in range(1, order)))
    log = F.log(F.col("c1") / float(max(places, 1)))
    for k in range(2, order + 1):
        seen = F.col(f"c{k}") >= least_count
        log = F.when(F.col(f"c{k}").isNull(), log).when(seen, F.log(F.col(f"c{k}") / F.col(f"context{k}"))).otherwise(F.log(F.lit(BACKOFF)) + log)
    summed = here.groupBy("row").agg(F.count("*").alias("n_tokens"), F.sum(log).alias("log_score"))
    out = rows.select("row", "doc_id").join(summed, "row", "left")
    n, total = F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"), F.coalesce("log_score", F.lit(0.0)).alias("log_score")
    return out.select("doc_id", n, total, (F.col("log_score") / F.col("n_tokens")).alias("mean_log_score"))


__all__ = ["BACKOFF", "LEAST_COUNT", "ORDER", "count_table", "exploded", "score"]
