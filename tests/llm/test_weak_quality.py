import numpy as np

from quarry.llm import weak_quality as wq


def test_estimate_finds_the_labellers_chances():
    rnd = np.random.default_rng(1)
    m, n = len(wq.LABELLERS), 40_000
    good = rnd.random(n) < 0.9
    chance = np.stack([rnd.uniform(0.3, 0.7, m), rnd.uniform(0.005, 0.03, m)])       # of a bad vote: bad, good texts
    bad_vote = rnd.random((n, m)) < np.where(good[:, None], chance[1], chance[0])
    vote = np.where(rnd.random((n, m)) < 0.2, 0, np.where(bad_vote, -1, 1))
    counts = {}
    for v in vote.tolist():
        counts[wq.pattern(v)] = counts.get(wq.pattern(v), 0) + 1
    posterior, found, share = wq.estimate(counts)
    assert abs(share - 0.9) < 0.02
    assert np.abs(found[:, 0, 0] - chance[0]).max() < 0.06 and np.abs(found[:, 1, 0] - chance[1]).max() < 0.02
    q = np.array([posterior[wq.pattern(v)] for v in vote.tolist()])
    assert ((q >= 0.5) == good).mean() > 0.97


def test_a_clean_corpus_is_not_split():
    good = [1] * len(wq.LABELLERS)
    some = [[*good[:i], 0, *good[i + 1:]] for i in range(len(good))]
    counts = {wq.pattern(v): 100 for v in [good, *some]}
    posterior, _, share = wq.estimate(counts)
    assert min(posterior.values()) > 0.9 and share > 0.9


def test_fit_linear():
    rnd = np.random.default_rng(2)
    rows = [(np.array([y, 5 + int(rnd.integers(50))]), np.array([0.8, 0.6], np.float32)) for y in (0, 1) * 200]
    w, bias = wq.fit_linear(rows, np.array([0.0, 1.0] * 200))
    score = np.array([w[p] @ v + bias for p, v in rows])
    assert ((score > 0) == (np.arange(400) % 2 == 1)).all()


def test_odd_rows(spark):
    prose = " ".join(f"Word{i} follows the other{i * 7 % 13}, and some more of it." for i in range(20))
    rows = [(i, prose + f" {i}", "x") for i in range(30)] + [(100, None, "x"), (101, "", "x"), (102, " \n", "x"), (103, "||| ### " * 300, "x"), (103, "||| ### " * 300, "x"), (None, prose, "x"), (104, "OH NO!! " * 20_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = wq.classify(df).collect()
    assert len(got) == len(rows)
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[i] for i in range(30)) and kept[None]
    assert not any(kept[i] for i in (100, 101, 102, 103, 104))
    assert all(0 <= r.score <= 1 and len(r.votes) == len(wq.LABELLERS) for r in got)
    assert wq.classify(df.limit(0)).collect() == []
    assert wq.classify(df, sample=5).count() == len(rows)


def test_query_agrees_with_the_given_labels(spark):
    import __spark_entry__ as e
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r.kept for r in e.queries()["op1_weak_label_classifier"](spark, d).collect()}
    labels = spark.read.parquet(f"{d}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{d}/documents.parquet").count()
    good = [got[r.doc_id] for r in labels if r.quality == 1]
    bad = [got[r.doc_id] for r in labels if r.quality == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.1


def test_shape_of_a_long_word():
    from quarry.llm.weak_quality import described
    assert described("x" * 64 + "1#1#")[1] == "a0#0#" and described("漢" * 100 + "<>")[1] == "A<>"
