"""Cross-site line deduplication by distinct-site spread, in DataFrame operations only.

Every line is known by its hash.  A HyperLogLog sketch of the sites that show
a line is merged by partial aggregation, so a line that a third of all
documents share costs one sketch per task.  Lines whose estimate is clear of
the threshold are decided by it; lines near it (within ``BAND``) get an exact
distinct count.  Lines on at least ``MIN_SITES`` sites are boilerplate, and so
are lines of over ``LONG_WORDS`` words on ``LONG_SITES``, which no two sites
have by chance.  They are removed everywhere but in the document with the
smallest id, so that no text vanishes from the corpus.

Only hashes are shuffled until the end: a document's removed lines become a
bit mask, and the masks meet the texts once.

Defined results: blank lines (spaces, tabs and carriage returns only) are
never boilerplate and always stay; lines are compared without such characters
at their ends; NULL text is the empty text; a NULL source is no site; a NULL
id never is the smallest; repeated rows are each cleaned; a very long text is
read whole, its lines dealt like any others and its mask a bit a line; an empty
table gives no rows; extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hot import at_every_salt, dealt, hot_keys
from .scratch import free, quoted, written

MIN_SITES = 3
#: Passages: a line of so many words needs fewer sites.
LONG_WORDS, LONG_SITES = 50, 2
#: log2 of a sketch's registers: a standard error under 2 %.
LG_REGISTERS = 12
#: Estimates within this factor of the threshold are counted exactly (many standard errors).
BAND = 2.0


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _first_text(lines: DataFrame) -> list[Column]:
    """The text with the smallest id, if the lines name their texts."""
    return [F.min_by("text_hash", F.when(F.col("id").isNotNull(), F.struct("id", "text_hash"))).alias("first_text")] if "text_hash" in lines.columns else []


def _later_copies(docs: DataFrame, id_col: str, text: Column) -> DataFrame:
    """(of_id, of_text) of the rows whose whole text another row with a smaller id has."""
    keys = docs.select(F.col(id_col).alias("of_id"), F.xxhash64(text).alias("of_text"))
    firsts = written(keys.groupBy("of_text").agg(F.min("of_id").alias("first_id"), F.count("*").alias("n")).where("n > 1"))
    hot = hot_keys(firsts, "of_text", firsts.agg(F.sum("n")).first()[0] or 0)
    met = dealt(keys, "of_text", hot, ["of_id"]).join(at_every_salt(firsts.drop("n"), "of_text", hot), ["of_text", "salt"])
    return met.where(~F.col("of_id").eqNullSafe(F.col("first_id"))).select("of_id", "of_text").distinct()


def spread(lines: DataFrame) -> DataFrame:
    """(line_hash, first_id, n) of the lines on at least their ``least`` sites, from (line_hash, least, site, id); with text_hash, also the first_text.

    n counts the line's rows.
    """
    first = ["first_id", "n", *(["first_text"] if "text_hash" in lines.columns else [])]
    sketched = lines.groupBy("line_hash").agg(F.hll_sketch_agg("site", LG_REGISTERS).alias("sketch"), F.min("id").alias("first_id"), F.count("*").alias("n"), F.min("least").alias("least"), *_first_text(lines))
    # most lines are on clearly fewer sites and end here
    estimated = written(sketched.select("line_hash", *first, "least", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") * BAND > F.col("least")))
    clear = estimated.where(F.col("sites") > F.col("least") * BAND).select("line_hash", *first)
    near = estimated.where(F.col("sites") <= F.col("least") * BAND).select("line_hash", "least", *first)
    hot = hot_keys(near, "line_hash", lines.count())
    of_near = dealt(lines.where("site is not null").select("line_hash", "site", "id"), "line_hash", hot, ["id"]).join(
        at_every_salt(near.select("line_hash"), "line_hash", hot), ["line_hash", "salt"], "left_semi")
    pairs = of_near.select("line_hash", "site").distinct()
    exact = pairs.groupBy("line_hash").agg(F.count("*").alias("exact_sites"))
    return clear.union(near.join(exact, "line_hash").where("exact_sites >= least").select("line_hash", *first))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES, long_words: int = LONG_WORDS, long_sites: int = LONG_SITES, whole_copies: bool = False) -> DataFrame:
    """``docs`` with boilerplate lines removed from the text; a last column, ``__lines_removed``, counts them.

    With ``whole_copies``, copies of a whole text count as one document, which
    has the smallest id of them and its site, and all lose the same lines: they
    are still equal when a later stage looks for copies.
    """
    whole = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("id"), F.col(site_col).cast("string").alias("site"), F.xxhash64(whole).alias("text_hash"), F.posexplode(_lines(whole)).alias("pos", "line"))
    stripped = keyed.withColumn("line", F.btrim("line", F.lit(" \t\r"))).where("line != ''")
    least = F.when(F.size(F.split("line", "[ \t]+")) > long_words, min(long_sites, min_sites)).otherwise(min_sites)
    lines = written(stripped.select("id", "site", "text_hash", "pos", F.xxhash64("line").alias("line_hash"), least.alias("least")))  # the texts are split once
    if whole_copies:
        later = written(_later_copies(docs, id_col, whole))
        once = lines.join(later, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_text")), "left_anti")
        found = spread(once.select("line_hash", "least", "site", "id", "text_hash"))
        keeper = F.col("text_hash").eqNullSafe(F.col("first_text")) | (F.col("id").isNull() & F.col("first_id").isNull())
    else:
        found = spread(lines.select("line_hash", "least", "site", "id"))
        keeper = F.col("id").eqNullSafe(F.col("first_id"))
    found = written(found)
    hot = hot_keys(found, "line_hash", lines.count())
    removed = dealt(lines.select("id", "text_hash", "pos", "line_hash"), "line_hash", hot, ["id", "pos"]).join(
        at_every_salt(found, "line_hash", hot), ["line_hash", "salt"]).where(~keeper)
    words = removed.groupBy("id", "text_hash", F.expr("pos div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
    masks = words.groupBy("id", "text_hash").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("mask")).select(
        "id", "text_hash",
        # an array by word, so that each line looks its bit up at once
        F.expr("transform(sequence(0L, array_max(map_keys(mask))), w -> coalesce(mask[w], 0L))").alias("mask"))
    # the rows as one struct, so that their other columns may have any name
    rows = docs.select(F.struct(*quoted(docs.columns)).alias("row"), F.col(id_col).alias("row_id"), F.xxhash64(whole).alias("row_hash"))
    met = rows.join(masks, F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_hash") == F.col("text_hash")), "left")
    met = met.withColumn("lines", _lines(F.coalesce(F.col("row")[text_col], F.lit(""))))
    kept = F.expr("filter(lines, (x, i) -> (shiftright(coalesce(get(mask, cast(i div 64 as int)), 0L), i % 64) & 1L) = 0)")
    cleaned = met.withColumn("kept", F.when(F.col("mask").isNull(), F.col("lines")).otherwise(kept))
    text = F.when(F.col("mask").isNull(), F.col("row")[text_col]).otherwise(F.array_join("kept", "\n"))
    removed = (F.size("lines") - F.size("kept")).cast("long").alias(free(docs, "__lines_removed"))
    return cleaned.select(*((text if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns), removed)


__all__ = ["LONG_SITES", "LONG_WORDS", "MIN_SITES", "dedup_lines", "spread"]
