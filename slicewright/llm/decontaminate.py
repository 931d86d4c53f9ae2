"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

A mask selects some of a window's token positions and ignores the others, so a
window still matches when words at ignored positions were replaced.  Masked
windows of benchmark items and of documents are hashed and joined.  A hit
names a diagonal (document position minus item position); the tokens of both
are compared along it once, and the longest stretch of which 0.8 agree is
verified: it must hold ``LEAST_TOKENS`` tokens, unless 0.8 of the whole item
agree on the diagonal.

Masks select ``weight`` tokens, ``step`` apart.  ``MASK`` slides over items of
``LEAST_TOKENS`` and more: of any 13 tokens with 2 replaced, one of its four
places there is untouched, since three of them share no token.  A shorter item
of n tokens must agree as a whole, with n div 5 replaced; it has one mask for
each class of positions modulo (n div 5) + 1, of which one is untouched; items
of up to four tokens match exactly.  Longer overlaps have many windows; their
recall is measured in the tests.

A stretch agrees at 0.8 when its score (a match 1, a mismatch -4) is not
negative.  Scores are summed along the diagonal by one window function; a
second one, over the sums in ascending order, finds the first position whose
sum is not above a position's own.  Both are linear in the item's length but
for their sorts, and a task holds no more than one item at a time.

A bit table of the benchmark's window hashes, of fixed size, drops most
document windows before the join.  A table filled up by a huge benchmark drops
none and changes no result.  Only documents with a hit are tokenised again.

Defined results: tokens are lower-cased runs of letters and digits (ASCII
marks and blanks divide them); NULL or empty texts and items have none and
overlap with nothing; repeated rows (same id and text) are reported once, as
are repeated items; an empty table gives no rows; very long texts and items
are compared whole; extra columns are kept by ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import free, written

LEAST_TOKENS = 13
#: Step and weight of the mask for items of ``LEAST_TOKENS`` and more.
MASK = (3, 4)
#: Bits of the table that drops document windows early.
TABLE_BITS = 1 << 20


def _tokens(text: Column) -> Column:
    """64-bit hashes of a text's tokens."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-/:-@\[-`{-\x7F]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _hash(tokens: str, at: str, step: int, weight: int) -> str:
    return f"xxhash64({step}, {weight}, {', '.join(f'get({tokens}, {at} + {k * step})' for k in range(weight))})"


def _windows(tokens: str, size: str, step: int, weight: int) -> Column:
    """Array of (pos, hash) for one mask over the array column ``tokens`` of ``size`` elements."""
    span = (weight - 1) * step + 1
    return F.expr(f"case when {size} >= {span} then transform(sequence(0, {size} - {span}), i -> struct(i as pos, {_hash(tokens, 'i', step, weight)} as hash)) else array() end")


def short_masks(n: int) -> list[tuple[int, int, int]]:
    """(position, step, weight) of the masks of an item of fewer than ``LEAST_TOKENS`` tokens."""
    step = n // 5 + 1
    return [(r, step, -(-(n - r) // step)) for r in range(min(step, n))]


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Verified overlaps: document, text hash, item, token ranges in both and matching tokens."""
    item_text = F.col(item_text_col).cast("string")
    items = benchmark.select(F.col(item_col).alias("item_id"), F.xxhash64(item_text).alias("item_hash"), _tokens(item_text).alias("item"))
    items = written(items.withColumn("n_item", F.size("item")).where("n_item > 0").dropDuplicates(["item_id", "item_hash"]))
    lengths = [r["n_item"] for r in items.where(F.col("n_item") < LEAST_TOKENS).select("n_item").distinct().collect()]  # at most 12 numbers
    masks = sorted({MASK, *((step, weight) for n in lengths for _, step, weight in short_masks(n))})
    none = F.array().cast("array<struct<pos:int,hash:bigint>>")
    of_long = F.when(F.col("n_item") >= LEAST_TOKENS, _windows("item", "n_item", *MASK)).otherwise(none)
    of_short = [F.when(F.col("n_item") == n, F.expr(f"array({', '.join(f'struct({r} as pos, {_hash('item', str(r), step, weight)} as hash)' for r, step, weight in short_masks(n))})")).otherwise(none)
                for n in lengths]
    seeds = written(items.select("item_id", "item_hash", F.explode(F.concat(of_long, *of_short)).alias("s")).select("item_id", "item_hash", F.col("s.pos").alias("item_pos"), F.col("s.hash").alias("hash")))
    words = TABLE_BITS // 64
    word, bit = (lambda h: F.pmod(F.shiftright(h, 6), F.lit(words)).cast("int")), (lambda h: h.bitwiseAND(F.lit(63)).cast("int"))
    one = F.lit(1).cast("long")
    rows = seeds.groupBy(word(F.col("hash")).alias("w")).agg(F.bit_or(F.call_function("shiftleft", one, bit(F.col("hash")))).alias("bits")).collect()  # at most `words` numbers
    table = {r["w"]: r["bits"] for r in rows}
    held = F.split(F.lit(",".join(str(table.get(k, 0)) for k in range(words))), ",").cast("array<bigint>")
    likely = lambda x: F.call_function("shiftright", F.get(held, word(x["hash"])), bit(x["hash"])).bitwiseAND(one) == 1

    whole = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(whole).alias("text_hash"), whole.alias("text"))
    tokens = texts.select("doc_id", "text_hash", _tokens(F.col("text")).alias("tokens")).withColumn("n", F.size("tokens"))
    passed = F.concat(*(F.filter(_windows("tokens", "n", step, weight), likely) for step, weight in masks))
    windows = tokens.select("doc_id", "text_hash", F.explode(passed).alias("s")).select("doc_id", "text_hash", F.col("s.pos").alias("pos"), F.col("s.hash").alias("hash"))
    hits = written(windows.join(seeds, "hash").select("doc_id", "text_hash", "item_id", "item_hash", F.expr("pos - item_pos").alias("diagonal")).distinct())

    # only documents with a hit are read and tokenised again, and only the part beside the item goes on
    hit = hits.select(F.col("doc_id").alias("of_doc"), F.col("text_hash").alias("of_text"), "item_id", "item_hash", "diagonal")
    hit_texts = hit.select(F.col("of_doc").alias("hit_doc"), F.col("of_text").alias("hit_text")).distinct()
    held_by = texts.join(hit_texts, F.col("doc_id").eqNullSafe(F.col("hit_doc")) & (F.col("text_hash") == F.col("hit_text")), "left_semi").dropDuplicates(["doc_id", "text_hash"])
    read = held_by.select("doc_id", "text_hash", _tokens(F.col("text")).alias("tokens"))
    met = read.join(hit, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_hash") == F.col("of_text"))).drop("of_doc", "of_text")
    keyed = items.select(F.col("item_id").alias("of_item"), F.col("item_hash").alias("of_hash"), "item", "n_item")
    met = met.join(keyed, F.col("item_id").eqNullSafe(F.col("of_item")) & (F.col("item_hash") == F.col("of_hash")))
    same = F.expr("zip_with(slice(item, greatest(0, -diagonal) + 1, least(n_item, size(tokens) - diagonal) - greatest(0, -diagonal)), "
                  "slice(tokens, greatest(0, diagonal) + 1, least(n_item, size(tokens) - diagonal) - greatest(0, -diagonal)), (a, b) -> a = b)")
    compared = met.select("doc_id", "text_hash", "item_id", "item_hash", "diagonal", "n_item", F.expr("greatest(0, -diagonal)").alias("low"), same.alias("same"))
    compared = compared.withColumn("agreed", F.size(F.filter("same", lambda x: x)))
    item_whole = F.col("agreed") * 5 >= F.col("n_item") * 4
    enough = F.col("agreed") * 5 >= LEAST_TOKENS * 4
    compared = written(compared.where(item_whole | ((F.col("n_item") >= LEAST_TOKENS) & enough)))

    key = ["doc_id", "text_hash", "item_id", "item_hash", "diagonal"]
    as_whole = compared.where(item_whole).select(*key, "low", F.lit(0).alias("a"), F.size("same").alias("b"), "agreed")
    along = compared.where(~item_whole).select(*key, "low", F.posexplode(F.concat(F.array(F.lit(False)), F.col("same"))).alias("k", "match"))
    by_diagonal = Window.partitionBy(*key, "low")
    summed = along.withColumn("matches", F.sum(F.col("match").cast("int")).over(by_diagonal.orderBy("k"))).withColumn("score", 5 * F.col("matches") - 4 * F.col("k"))
    begun = summed.withColumn("begin", F.min(F.struct("k", "matches")).over(by_diagonal.orderBy("score")))
    longest = begun.groupBy(*key, "low").agg(F.max(F.struct((F.col("k") - F.col("begin.k")).alias("length"), (-F.col("begin.k")).alias("first"), (F.col("matches") - F.col("begin.matches")).alias("agreed"))).alias("s"))
    in_part = longest.where(F.col("s.length") >= LEAST_TOKENS).select(*key, "low", (-F.col("s.first")).alias("a"), (F.col("s.length") - F.col("s.first")).alias("b"), F.col("s.agreed").alias("agreed"))
    begin, end = F.col("low") + F.col("a"), F.col("low") + F.col("b")
    return as_whole.unionByName(in_part).select(
        "doc_id", "text_hash", "item_id", (begin + F.col("diagonal")).cast("int").alias("doc_start"), (end + F.col("diagonal")).cast("int").alias("doc_end"),
        begin.cast("int").alias("item_start"), end.cast("int").alias("item_end"), F.col("agreed").cast("int").alias("matching"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that overlap with the benchmark."""
    doc, text = free(docs, "__doc"), free(docs, "__text")
    found = written(overlaps(docs, benchmark, id_col, text_col, item_col, item_text_col).select(F.col("doc_id").alias(doc), F.col("text_hash").alias(text)).distinct())
    return docs.join(found, F.col(id_col).cast("long").eqNullSafe(F.col(doc)) & (F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))) == F.col(text)), "left_anti")


__all__ = ["LEAST_TOKENS", "MASK", "clean", "overlaps", "short_masks"]
