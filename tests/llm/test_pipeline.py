import duckdb

import corpus_pipeline
from slicewright.llm import queries


def test_stages_keep_columns_and_effects(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.written(stage(spark, docs, sf))
        assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes], name
        assert out.select("doc_id").distinct().count() == out.count() <= rows[-1]
        rows.append(out.count())
        docs = out
    assert rows[1] < rows[0] and rows[3] < rows[2]
    packed = corpus_pipeline.run(spark, sf)
    assert packed.select("doc_id").distinct().count() == rows[-1]


def test_stages_of_edge_tables(spark, edge_docs, no_docs):
    sf = "/root/testdata/sf0.001"
    dotted = edge_docs.withColumn("a.b", edge_docs["part"]).withColumn("back`tick", edge_docs["part"])
    for docs in (dotted, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            before, docs = docs.columns, corpus_pipeline.written(stage(spark, docs, sf))
            assert docs.columns == before or stage is corpus_pipeline.pack


def test_near_dedup_keeps_one_of_each_group(spark):
    rows = [(3, "a b c d e f g h"), (2, "a b c d e f g h"), (5, "q r s t u v"), (None, "x y z"), (None, "x y z"), (9, ""), (8, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_dedup(spark, docs, "").collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["2", "5", "8", "None"]


def test_line_dedup_oracle(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    assert sorted(con.execute(queries.ORACLES["op3_line_dedup"]).fetchall()) == sorted(tuple(r) for r in queries.op3_line_dedup(spark, sf).collect())


def test_entry_without_a_dependency():
    """What the corpus operators need may be missing; the other queries stay."""
    import subprocess
    import sys

    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and 'op8_fingerprint' not in q and 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=corpus_pipeline.__file__.rsplit("/", 1)[0])


def test_op4_rates_every_document(spark):
    sf = "/root/testdata/sf0.001"
    rows = queries.op4_quality(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r["selected"] == (r["tail_probability"] >= 0.5) for r in rows) and 0 < sum(r["selected"] for r in rows) < len(rows)


def test_queries_have_contract_columns(spark):
    sf = "/root/testdata/sf0.001"
    first = {
        "op11_language": ["doc_id", "held_out", "lang_pred", "score"],
        "op12_conversations": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
        "op13_manifest": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
        "op1_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
        "op2_simhash": ["doc_id", "fingerprint", "component_id"],
        "op6_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
        "op7_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
        "op8_fingerprint": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        "op10_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    }
    for name, columns in first.items():
        assert queries.QUERIES[name](spark, sf).columns[:len(columns)] == columns


def test_planted_copies_leave_one_document(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    good = spark.read.parquet(f"{sf}/labels.parquet")
    kept = corpus_pipeline.quality_classifier(spark, docs, sf).orderBy("doc_id").limit(1).collect()[0]
    text = "\n".join(f"{kept['text']} {' '.join(f'{w}{n}' for w in kept['text'].split()[:60])}" for n in ("a", "b"))
    copies = spark.createDataFrame([(10**6 + k, text, kept["lang"], f"copy{k}.example", len(text)) for k in range(6)], docs.schema)
    docs.unionByName(copies).write.parquet(f"{tmp_path}/documents.parquet")
    good.write.parquet(f"{tmp_path}/labels.parquet")
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().collect() if r["doc_id"] >= 10**6}
    assert len(left) == 1
