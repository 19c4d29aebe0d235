from collections import Counter

import public_tokenizers as P
import pytest
from test_hyperminhash import brute as components_by_pairs
from test_packing import check as check_packing
from tokenizers import Tokenizer

import corpus_pipeline as cp

D = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def outputs(spark):
    """What goes into each stage and the last one's rows."""
    docs, out = spark.read.parquet(f"{D}/documents.parquet"), []
    for name, stage in cp.STAGES:
        out.append(docs)
        docs = cp.stored(stage(spark, docs, D), name.replace(" ", "-"))
    return [*out, docs]


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages():
    assert [n for n, _ in cp.STAGES] == ["quality rules", "quality classifier", "minhash near-dedup", "suffix-array dedup", "best-fit packing"]


def test_columns(outputs):
    assert all(df.columns == COLUMNS for df in outputs[:5])
    assert all(df.schema["n_chars"] == outputs[0].schema["n_chars"] for df in outputs[:5])


def test_quality_stages_keep_clean_documents(spark, outputs):
    import duckdb

    from quarry.llm import rules
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    want = {r[0] for r in con.execute(rules.oracle_sql("SELECT doc_id FROM judged WHERE kept")).fetchall()}
    assert set(texts(outputs[1])) == want
    good = {r.doc_id for r in spark.read.parquet(f"{D}/labels.parquet").where("quality = 1").collect()}
    bad = {r.doc_id for r in spark.read.parquet(f"{D}/labels.parquet").where("quality = 0").collect()}
    first, second = set(texts(outputs[1])), set(texts(outputs[2]))
    assert second < first
    assert len(second & good) > 0.98 * len(first & good)
    assert len(second & bad) < 0.1 * len(bad)


def shingles_of_five(text):
    ws = (text or "").encode().lower().split()
    return " ".join(str(hash(tuple(ws[i:i + 5]))) for i in range(len(ws) - 4))


def test_near_dedup_by_pairs(outputs, monkeypatch):
    import test_hyperminhash as t
    monkeypatch.setattr(t, "shingle_set", lambda x: set(shingles_of_five(x).split()) or ({x} if x else set()))
    before, after = texts(outputs[2]), texts(outputs[3])
    want = components_by_pairs(list(before.items()))
    assert set(after) == {i for i, (_, c) in want.items() if c == i}
    assert all(before[i] == t for i, t in after.items())


def left_by_windows(texts, length, words):
    """Whether each byte stays: a run covered by strings of ``length`` bytes
    that stand elsewhere goes if it has ``words`` words or 400 bytes."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(hash(d[i:i + length]) for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        runs = []
        for i in range(len(d) - length + 1):
            if seen[hash(d[i:i + length])] > 1:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + length
                else:
                    runs.append([i, i + length])
        goes = [(x, y) for x, y in runs if y - x >= 400 or len(d[x:y].split()) >= words]
        out.append((len(d), sum(y - x for x, y in goes), len(goes)))
    return out


def test_suffix_dedup_by_windows(outputs):
    """The stage's own terms: runs of 51 words, found by 101 bytes."""
    before, after = texts(outputs[3]), texts(outputs[4])
    ids = sorted(before)
    want = left_by_windows([before[i] for i in ids], 101, 51)
    assert set(after) == set(ids) and sum(t > 0 for _, t, _ in want) > 20
    for i, (n, taken, spans) in zip(ids, want, strict=True):
        left = len(after[i].encode())
        assert n - taken <= left <= n - taken + 6 * spans        # of a character cut at either end, the rest
        assert after[i] == before[i] or taken
    assert all(r.n_chars == len(r.text) for r in outputs[4].collect())


def test_packing(outputs):
    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    rows = outputs[5].collect()
    lengths = {}
    for r in rows:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert lengths == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts(outputs[4]).items()}
    assert check_packing(rows) <= -(-sum(lengths.values()) // 4096) * 1.02 + 1


def test_odd_rows(spark, tmp_path):
    prose = " ".join(f"Word{i} follows the other{i * 7 % 13}, and some more of it." for i in range(30))
    rows = [(i, prose.replace("some", f"some{i} x{i}"), "en", "s", 9, "extra") for i in range(20)] + [(5, prose.replace("some", "some5 x5"), "en", "s", 9, "extra"), (30, None, None, None, None, None), (None, prose + " null", "en", "s", 1, "x"), (31, "", "en", "s", 0, "x")]
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string").selectExpr("*", "'y' as _text_hash", "1 as _found", "2 as found", "3 as its_id")
    for df in (docs, docs.limit(0)):
        for _, stage in cp.STAGES[:4]:
            df = cp.stored(stage(spark, df, str(tmp_path)), "odd")
            assert df.columns == docs.columns
        last = cp.STAGES[4][1](spark, df, str(tmp_path)).collect()
    assert last == []


def test_run(spark):
    import __spark_entry__ as e
    assert e.queries()["pipeline"](spark, "/root/testdata/sf0.001").count() > 0 and cp.ORACLE_SQL is None


def test_suffix_stage_takes_passages_of_51_words(spark):
    def words(tag, n):
        return " ".join(f"{tag}{i}" for i in range(n))
    passage, short, tiny = words("p", 51), words("s", 30), " ".join("ab"[i * i % 7 % 2] for i in range(51))
    assert len(passage) < 400 and len(short) > 101 and len(tiny) == 101
    rows = [(10 * k + i, f"{words(f'x{k}{i}y', 20)} {p} {words(f'z{k}{i}y', 20)}", "en", "s", 0) for k, p in enumerate((passage, short, tiny)) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = texts(dict(cp.STAGES)["suffix-array dedup"](spark, docs, D))
    for i in range(2):
        assert passage[3:-3] not in got[i] and len(got[i].split()) >= 39
        assert short in got[10 + i]
        assert tiny not in got[20 + i]


def test_a_worker_keeps_the_memo_of_one_step_only():
    import gc
    import weakref

    import public_tokenizers

    from quarry.llm import hyperminhash, tokens, weak_quality

    path = public_tokenizers.path("word_bpe_49k.json")
    steps = [weak_quality.reader, hyperminhash._shingler, lambda: tokens.word_ids(path)]
    last = None
    for step in [*steps, *steps]:
        memo = step()
        assert step() is memo
        gc.collect()
        assert last is None or last() is None
        last = weakref.ref(memo)
        del memo
