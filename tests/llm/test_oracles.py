"""The operators against their SQL on rows with NULLs, empty and long texts, ties, repeated rows and clashing names, and on empty tables."""

from collections import Counter

import duckdb
import pytest

from slicewright.llm import oracles, queries

OF_DOCUMENTS = ["op2_simhash", "op6_sharding", "op8_fingerprint", "op9_decontaminate", "op13_manifest"]


def same(spark, folder, name, **tables):
    con = duckdb.connect()
    for table, df in tables.items():
        path = f"{folder}/{table}.parquet"
        df.write.parquet(path)
        con.execute(f"create view {table} as select * from read_parquet('{path}/*.parquet')")
    got = queries.QUERIES[name](spark, str(folder))
    want = con.sql(oracles.ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert Counter(tuple(r) for r in got.select(*columns).collect()) == Counter(want.project(", ".join(columns)).fetchall())


@pytest.fixture(scope="module")
def benchmark(spark, edge_rows):
    long_text = edge_rows[11][1].split()
    rows = [(1, " ".join(long_text[40:70])), (1, " ".join(long_text[40:70])), (2, " ".join(long_text[100:109])), (3, "one"), (4, None), (5, ""), (None, " ".join(long_text[200:240]).replace("w1", "x1")),
            (6, " ".join(long_text[300:310] + ["other"] * 2)), (7, " ".join(long_text[:400]))]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("name", OF_DOCUMENTS)
def test_documents(spark, tmp_path, edge_docs, benchmark, name):
    same(spark, tmp_path, name, documents=edge_docs, benchmark=benchmark)


@pytest.mark.parametrize("name", OF_DOCUMENTS)
def test_no_documents(spark, tmp_path, no_docs, benchmark, name):
    same(spark, tmp_path, name, documents=no_docs, benchmark=benchmark)


def test_pages(spark, tmp_path):
    rows = [(1, "u", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""), (2**62, "u", "x" * 100_000), (-5, "u", "x" * 100_000), (6, "u", "\r\n\r\n"), (7, "u", "<p>E</p>")]
    same(spark, tmp_path, "op7_warc", pages=spark.createDataFrame(rows, "page_id long, url string, html string"))


def test_conversations(spark, tmp_path):
    rows = [(c, t if (c + t) % 7 else None, ["system", "user", "assistant", "tool", "", None][(c * t + t) % 6], ["Yes.", "No!", "cut", "", " \n", "Why? ", f"T {t}.", None][(c + 3 * t) % 8])
            for c in range(60) for t in range(c % 9)] + [(None, 1, "user", "Hello."), (None, None, None, None), (2**62, 5, "assistant", "Far."), (3, 1, "user", "No!")]
    same(spark, tmp_path, "op12_conversations", conversations=spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
