from slicewright.llm import hot, line_dedup


def brute(rows, least=3):
    sites, first = {}, {}
    for i, text, site in rows:
        for line in (text or "").split("\n"):
            key = line.strip(" \t\r")
            if key:
                sites.setdefault(key, set()).update({site} - {None})
                if i is not None:
                    first[key] = min(first.get(key, i), i)
    out = []
    for i, text, _ in rows:
        lines = (text or "").split("\n")
        gone = [bool(k := x.strip(" \t\r")) and len(sites[k]) >= least and first.get(k, "none") != i for x in lines]
        out.append((i, text if not any(gone) else "\n".join(x for x, g in zip(lines, gone) if not g), sum(gone)))
    return out


order = lambda r: tuple((x is not None, x) for x in r)


def test_edges(spark, edge_docs, edge_rows, no_docs):
    got = line_dedup.dedup_lines(edge_docs)
    assert got.columns == [*edge_docs.columns, "__lines_removed"]
    want = brute([(r[0], r[1], r[3]) for r in edge_rows])
    assert sorted(((r["doc_id"], r["text"], r["__lines_removed"]) for r in got.collect()), key=order) == sorted(want, key=order)
    assert sum(w[2] for w in want) > 20
    assert line_dedup.dedup_lines(no_docs).count() == 0


def test_near_and_clear_lines(spark):
    """Spreads from one site to far over the threshold, with sketches that must hold many sites."""
    rows = [(1000 * n + k, f"line on {n}\nown {n} {k}", f"site{k}") for n in (1, 2, 3, 4, 6, 7, 40, 500) for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for least in (3, 20, 300):
        got = {(r["doc_id"], r["text"], r["__lines_removed"]) for r in line_dedup.dedup_lines(docs, min_sites=least).collect()}
        assert got == set(brute(rows, least)), least


def test_long_document_masks(spark):
    lines = [f"l{k}" for k in range(1000)]
    rows = [(k, "\n".join(lines[k::2]) + ("\n" if k else ""), f"s{k}") for k in range(2)] + [(9, "\n".join(lines), "s9"), (10, "\n".join(lines[::3]), "s10")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((r["doc_id"], r["text"], r["__lines_removed"]) for r in line_dedup.dedup_lines(docs, min_sites=2).collect())
    assert got == sorted(brute(rows, 2))


def test_long_lines_follow_the_same_rule(spark):
    passage = " ".join(f"word{k}" for k in range(60))
    rows = [(1, f"own line\n{passage}", "a"), (2, f"{passage}\nshort line", "b"), (3, "short line", "c"), (4, passage + " more", "a"), (5, passage, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((r["doc_id"], r["text"], r["__lines_removed"]) for r in line_dedup.dedup_lines(docs).collect())
    assert got == sorted(brute(rows)) and got[1] == (2, "short line", 1) and got[3][2] == 0


def test_whole_copies_stay_equal(spark):
    long, own = " ".join(f"p{k}" for k in range(60)), "own words of the text"
    text = f"{own}\n{long}\nshared line"
    rows = [(k, text, f"s{k}") for k in range(1, 6)] + [(None, text, "s9"), (20, f"another one\n{long}", "t"), (24, f"yet another\n{long}", "t2"), (21, "shared line\nthird", "u"), (22, "shared line\nfourth", "v"), (23, "shared line\nfourth", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [(r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(docs, whole_copies=True).collect()]
    want = [(i, text) for i in (None, 1, 2, 3, 4, 5)] + [(20, "another one"), (24, "yet another"), (21, "third"), (22, "fourth"), (23, "fourth")]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_hot_lines_and_copies(spark):
    """A line, and a whole text, in most rows: spread over salts, with the same result."""
    rows = [(k, f"the same line\nown {k}\ncommon on one site", "a" if k % 3 else f"s{k % 50}") for k in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = sorted((r["doc_id"], r["text"], r["__lines_removed"]) for r in line_dedup.dedup_lines(docs).collect())
    assert got == sorted(brute(rows)) and hot.hot_keys(docs.selectExpr("1 as n", "doc_id"), "doc_id", 10) == []
    copies = [(k, "a whole text\nof two lines", f"s{k % 9}") for k in range(900)] + [(2000 + k, "of two lines", f"s{k}") for k in range(4)]
    docs = spark.createDataFrame(copies, "doc_id long, text string, source string").repartition(4)
    out = {r["text"] for r in line_dedup.dedup_lines(docs, whole_copies=True).where("doc_id < 2000").collect()}
    assert out == {"a whole text\nof two lines"}


def test_passages_on_two_sites(spark):
    """A line of over 50 words is boilerplate on two sites, a shorter one on three."""
    fifty, passage = " ".join(f"w{k}" for k in range(50)), "\t".join(f"p{k}" for k in range(51))
    rows = [(1, f"own\n{passage}", "a"), (2, f" {passage}\r\nrest\n{fifty}", "b"), (3, f"{fifty}\nx", "c"), (4, f"{passage} more", "a"), (5, f"{passage} more", "a"), (6, f"{passage} more", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((r["doc_id"], r["text"], r["__lines_removed"]) for r in line_dedup.dedup_lines(docs).collect())
    assert got == [(i, f"rest\n{fifty}" if i == 2 else t, int(i == 2)) for i, t, _ in rows]


def test_passages_as_in_the_sql(spark, tmp_path):
    from slicewright.llm import queries

    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(1, passage, "a"), (2, f"{passage}\nshort", "b"), (3, "short", "c")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = sorted(con.execute(queries.ORACLES["op3_line_dedup"]).fetchall())
    assert want == sorted(tuple(r) for r in queries.op3_line_dedup(spark, str(tmp_path)).collect()) and want[1] == (2, "short", 1)
