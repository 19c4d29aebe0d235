import re
from collections import Counter
from math import comb

import pytest
from pyspark.sql import functions as F

from quarry.llm import rules

DOCS = "doc_id long, text string, lang string, source string, n_words int, kept string"


def brute(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    n = Counter(windows)
    ls = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    covered = {p for i, w in enumerate(windows) if n[w] > 1 for p in (i, i + 1, i + 2)}
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(ls) - len(set(ls)), len(covered)


def test_measures(spark):
    texts = [None, "", " ", "a", "a b c", "a b c a b c", "x x x x x", "l\nl\n \n\nl\r\n", "é 中文 😀 #$%&|<>*", "\x1c a\x85b c", "one two three " * 700,
             "a b c d a b c", "the end\nof the end\nof the end", "w" * 100_000, " lead  and trail \t"]
    df = spark.createDataFrame([(i, t, "en", None, 7, "x") for i, t in enumerate(texts)] + [(0, None, None, None, 7, "x")], DOCS)
    got = {r.doc_id: tuple(r[c] for c in rules.MEASURES) for r in rules.measure(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_binomial_tail(spark):
    rows = [(n, k) for n in (1, 5, 40, 300) for k in (0, 1, 3) if k <= n]
    df = spark.createDataFrame(rows, "n long, k long").withColumn("p", rules.binomial_tail(F.col("n"), F.col("k"), 0.02))
    for r in df.collect():
        exact = sum(comb(r.n, i) * 0.02 ** i * 0.98 ** (r.n - i) for i in range(r.k + 1))
        assert r.p == pytest.approx(1.0 if r.k > r.n * 0.02 + 1 else exact, rel=1e-9)
    big = spark.createDataFrame([(200_000, 1_500)], "n long, k long").select(rules.binomial_tail(F.col("n"), F.col("k"), 0.01).alias("p")).first().p
    assert 0 < big < 1e-20


def test_cutoffs_hold_and_need_labels(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(i, words, "en") for i in range(1000)] + [(1000 + i, words, "fr") for i in range(30)] + [(2000 + i, words + " |" * 40, "en") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1030)] + [(2000, 0, 0)], "doc_id long, quality int, toxic int")
    chosen = {r.lang: r for r in rules.cutoffs(rules.measure(df), labels).collect()}
    assert chosen["en"].symbol_share_cutoff == rules.CUTOFFS[0]
    assert chosen["fr"].symbol_share_cutoff is None
    kept = {r.doc_id: r.kept for r in rules.judge(df, labels).collect()}
    assert [d for d, k in kept.items() if not k] == [2000, 2001, 2002, 2003, 2004]
    none = {r.doc_id: r.kept for r in rules.judge(df, labels.limit(0)).collect()}
    assert all(none.values()) and len(none) == 1035
    assert rules.judge(df.limit(0), labels).collect() == []
    twice = df.limit(3).union(df.limit(3))
    assert rules.judge(twice, labels).count() == 6


def test_query_equals_sql(spark):
    import duckdb

    import __spark_entry__ as e
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.01/{t}.parquet'")
    want = con.execute(e.oracle_sql()["op6_quality_rules"]).fetchall()
    got = e.queries()["op6_quality_rules"](spark, "/root/testdata/sf0.01")
    assert got.columns == ["doc_id", *rules.MEASURES, "base_failed", "kept"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
