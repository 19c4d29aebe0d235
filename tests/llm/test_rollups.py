import tempfile

import public_tokenizers as P

from quarry.llm.common import new_folder
from quarry.llm.rollups import COUNTED, TokenRollup, cleaned, count_tokens
from quarry.llm.tokens import WordIds

VERSIONS = {"bpe": P.path("word_bpe_49k.json"), "ws": None}


def totals(rollup):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in rollup.totals().collect()}


def test_signed_batches(spark):
    rollup = TokenRollup(spark, tempfile.mkdtemp(prefix="rollup-"))
    assert totals(rollup) == {}
    rows = [(1, "a", "en", "v1", 10), (2, "a", "en", "v1", 5), (2, "a", "en", "v2", 6), (3, None, None, "v1", 7), (None, "a", "en", "v1", None)]
    df = spark.createDataFrame(rows, COUNTED)
    assert rollup.commit(1, inserts=df)
    assert totals(rollup) == {("a", "en", "v1"): (3, 15), ("a", "en", "v2"): (1, 6), (None, None, "v1"): (1, 7)}
    assert not rollup.commit(1, inserts=df)
    revised = spark.createDataFrame([(2, "b", "en", "v1", 50), (9, "c", "en", "v1", 1)], COUNTED)
    gone = spark.createDataFrame([(3,), (3,), (77,), (None,)], "doc_id long")
    assert rollup.commit(5, revised=revised, deletes=gone)
    want = {("a", "en", "v1"): (2, 10), ("a", "en", "v2"): (1, 6), ("b", "en", "v1"): (1, 50), ("c", "en", "v1"): (1, 1)}
    assert totals(rollup) == want
    assert not rollup.commit(5, deletes=spark.createDataFrame([(1,)], "doc_id long"))
    assert totals(rollup) == want
    try:
        rollup.commit(3, inserts=df)
        raise AssertionError("an older batch was taken")
    except ValueError:
        pass


def test_a_broken_batch_is_written_anew(spark):
    folder = tempfile.mkdtemp(prefix="rollup-")
    rollup = TokenRollup(spark, folder)
    one = spark.createDataFrame([(1, "a", "en", "v", 10)], COUNTED)
    rollup.commit(1, inserts=one)
    # a batch that died after its ledger and before its totals
    spark.createDataFrame([(8, "a", "en", "v", 1, 999)], "doc_id long, source string, lang string, tokenizer string, docs long, tokens long").write.parquet(rollup._path("ledger", 2))
    assert rollup.committed() == [1]
    assert totals(rollup) == {("a", "en", "v"): (1, 10)}
    assert rollup.commit(2, deletes=spark.createDataFrame([(1,)], "doc_id long"))
    assert totals(rollup) == {}
    assert rollup.commit(3, inserts=one) and totals(rollup) == {("a", "en", "v"): (1, 10)}


def test_counts(spark):
    rows = [(1, "s", "en", "two words"), (2, None, None, None), (2, "s", "de", ""), (4, "s", "en", "x\n" * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string").selectExpr("*", "1 as tokens")
    got = sorted((r.doc_id, r.tokenizer, r.tokens) for r in count_tokens(df, VERSIONS).collect())
    assert got == [(1, "bpe", 2), (1, "ws", 2), (2, "bpe", 0), (2, "bpe", 0), (2, "ws", 0), (2, "ws", 0), (4, "bpe", 30_000), (4, "ws", 30_000)]
    assert count_tokens(df.limit(0), VERSIONS).collect() == []


def test_query(spark):
    import __spark_entry__ as e
    got = {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in e.queries()["op10_token_rollups"](spark, "/root/testdata/sf0.001").collect()}
    words, want, seen = WordIds(VERSIONS["bpe"]), {}, set()
    for d in sorted(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect(), key=lambda r: r.doc_id):
        if d.text in seen:
            continue
        seen.add(d.text)
        text = "\n".join(dict.fromkeys((d.text or "").split("\n")))
        for version, n in (("word_bpe_49k", len(words.encode([text])[0]) // 4), ("white_space", len(text.split()))):
            docs, tokens = want.get((d.source, d.lang, version), (0, 0))
            want[d.source, d.lang, version] = (docs + 1, tokens + n)
    assert got == want


def test_cleaned(spark):
    df = spark.createDataFrame([(1, "s", "l", "a\na"), (2, "s", "l", "a\na"), (3, "s", "l", None), (4, "s", "l", ""), (5, "s", "l", "b")], "doc_id long, source string, lang string, text string")
    gone, shorter = cleaned(df)
    assert sorted(r.doc_id for r in gone.collect()) == [2, 4]
    assert [(r.doc_id, r.text) for r in shorter.collect()] == [(1, "a")]
    assert new_folder(spark, "x") != new_folder(spark, "x")
