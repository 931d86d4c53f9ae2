"""The operators as queries over the shared tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, decontaminate, fingerprint, language, line_dedup, lm_score, manifest, oracles, packing, pii, quality, sharding, simhash, warc
from .scratch import prepared
from ..session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "text", F.col(cleaned.columns[-1]).alias("lines_removed"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probability of every document, and whether the classifier selects it."""
    docs = _table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.train(docs, _table(spark, sf_dir, "labels")))
    rated = scored.select("doc_id", *(F.col(scored.columns[-1])[c].alias(c) for c in ("expected_grade", "tail_probability")))
    return rated.withColumn("selected", F.col("tail_probability") >= quality.SELECTED)


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_score.score(_table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "n_tokens", F.round("log_score", 3).alias("log_score"), F.round("mean_log_score", 5).alias("mean_log_score"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return warc.round_trip(spark, pages, scratch_path(spark, "warc")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.with_next(_table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verified overlaps between documents and benchmark items."""
    return decontaminate.overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("text_hash")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_table(spark, sf_dir, "documents")).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_term", "n_spans")


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    found = language.identify(docs, language.train(docs, ~held_out))  # a NULL id teaches nothing
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations as op12 finds them: ``copies`` 0 where a turn is dropped, 2 where it is repeated."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind, text = F.crc32(name.cast("binary")) % 20, F.coalesce("text", F.lit(" "))
    return turns.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(_table(spark, sf_dir, "conversations"))
    return conversations.repair(conversations.turns(rows, copies=F.col("copies")))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = manifest.manifest(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "log_position")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_packing, op2_simhash, op3_line_dedup, op4_quality, op5_lm_score, op6_sharding, op7_warc, op8_fingerprint, op9_decontaminate, op10_pii,
                              op11_language, op12_conversations, op13_manifest)
}

ORACLES = {
    "op3_line_dedup": r"""
WITH l AS (
  SELECT doc_id, source, unnest(range(len(lines))) AS pos, unnest(lines) AS line
  FROM (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
), k AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS key FROM l),
b AS (SELECT key, min(doc_id) AS first_id FROM k WHERE key <> '' GROUP BY key
      HAVING count(DISTINCT source) >= CASE WHEN len(string_split_regex(key, '[ \t]+')) > 50 THEN 2 ELSE 3 END)
SELECT k.doc_id,
       coalesce(string_agg(k.line, chr(10) ORDER BY k.pos) FILTER (WHERE b.key IS NULL OR b.first_id = k.doc_id), '') AS text,
       count(*) FILTER (WHERE b.key IS NOT NULL AND b.first_id <> k.doc_id) AS lines_removed
FROM k LEFT JOIN b ON k.key = b.key
GROUP BY k.doc_id""",
    "op5_lm_score": r"""
WITH u AS (
  SELECT doc_id, unnest(range(len(words))) AS pos, unnest(words) AS word
  FROM (SELECT doc_id, string_split_regex(lower(coalesce(text, '')), '[ \t\n\x0b\f\r]+') AS words FROM documents)
), w AS (SELECT * FROM u WHERE word <> ''), c AS (SELECT word, count(*) AS n FROM w GROUP BY word),
p AS (SELECT doc_id, pos, word, lag(word) OVER (PARTITION BY doc_id ORDER BY pos) AS prev FROM w),
b AS (SELECT prev, word, count(*) AS n FROM p WHERE prev IS NOT NULL GROUP BY prev, word),
t AS (SELECT sum(n) AS total FROM c),
s AS (
  SELECT p.doc_id, CASE WHEN p.prev IS NULL THEN ln(cw.n / t.total) WHEN b.n >= 2 THEN ln(b.n / cp.n) ELSE ln(0.4 * cw.n / t.total) END AS score
  FROM p CROSS JOIN t JOIN c cw ON cw.word = p.word LEFT JOIN c cp ON cp.word = p.prev LEFT JOIN b ON b.prev = p.prev AND b.word = p.word
), g AS (SELECT doc_id, count(*) AS n_tokens, sum(score) AS log_score FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(g.n_tokens, 0) AS n_tokens, round(coalesce(g.log_score, 0.0), 3) AS log_score, round(g.log_score / g.n_tokens, 5) AS mean_log_score
FROM documents d LEFT JOIN g ON g.doc_id = d.doc_id""",
} | oracles.ORACLES

__all__ = ["ORACLES", "QUERIES", "tokenizer_path"]
