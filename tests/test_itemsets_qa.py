"""Apriori vs FP-growth on a hand basket set; QA scoring and tokens."""

from pyspark.sql import functions as F

from quarry.operators import itemsets as I
from quarry.operators import qa as Q

BASKETS = [[1, 2, 3], [1, 2], [1, 3], [2, 3], [1, 2, 3, 4]]


def baskets(spark):
    rows = [(b, i) for b, items in enumerate(BASKETS) for i in items]
    return spark.createDataFrame(rows, "basket long, item int")


def test_apriori_equals_fpgrowth(spark):
    b = baskets(spark)
    ap = {(r["k"], tuple(r["items"]), r["support"]) for r in I.apriori(b, 2).collect()}
    assert ap == {(1, (1,), 4), (1, (2,), 4), (1, (3,), 4), (2, (1, 2), 3), (2, (1, 3), 3),
                  (2, (2, 3), 3), (3, (1, 2, 3), 2)}
    fp = {(r["k"], tuple(r["items"]), r["support"]) for r in I.fp_growth(b, 2, len(BASKETS)).collect()}
    assert fp == ap


def test_rules_keep_every_consequent(spark):
    fi = I.apriori(baskets(spark), 2)
    rules = {(tuple(r["antecedent"]), tuple(r["consequent"])): r["confidence"]
             for r in I.association_rules(fi, 0.5).collect()}
    assert rules[((1,), (2,))] == 0.75
    assert ((1, 2), (3,)) in rules and ((1,), (2, 3)) not in rules      # 2/4 is not > 0.5


def test_min_support_exact():
    assert I.min_support_count(14800, 0.005) == 74
    assert I.min_support_count(14743, 0.005) == 73


def test_normalise_em_f1(spark):
    rows = [("q1", "The Cat sat!", "cat sat"), ("q2", "a dog", "the dog barked"),
            ("q3", "nothing here", "something else")]
    df = spark.createDataFrame(rows, "qid string, pred string, truth string")
    p = df.select(F.col("qid"), F.lit("t").alias("truth"), Q.normalise_answer(F.col("pred")).alias("text"))
    g = df.select(F.col("qid"), F.lit("t").alias("truth"), Q.normalise_answer(F.col("truth")).alias("text"))
    f1 = {r["qid"]: r["f1"] for r in Q.token_f1(p, g, ["qid", "truth"]).collect()}
    assert f1["q1"] == 1.0 and f1["q3"] == 0.0
    assert abs(f1["q2"] - 2 * (1.0 * 0.5) / 1.5) < 1e-12


def test_token_offsets(spark):
    df = spark.createDataFrame([(1, "  Héllo, wörld_1 !x")], "id long, text string")
    toks = [(r["token"], r["start"], r["end"]) for r in Q.token_rows(df, "id", "text").orderBy("pos").collect()]
    assert toks == [("Héllo", 2, 7), (",", 7, 8), ("wörld_1", 9, 16), ("!", 17, 18), ("x", 18, 19)]


def test_bleu_identical_and_short(spark):
    rows = [("a", "the cat sat on the mat".split(), "the cat sat on the mat".split()),
            ("b", "the cat".split(), "the cat sat on the mat".split())]
    df = spark.createDataFrame(rows, "qid string, c array<string>, r array<string>")
    b = Q.bleu(df.select("qid", F.col("c").alias("toks")), df.select("qid", F.col("r").alias("toks")), ["qid"])
    got = {r["qid"]: r["bleu"] for r in b.collect()}
    assert abs(got["a"] - 1.0) < 1e-12 and got["b"] == 0.0


def test_best_span(spark):
    rows = [(1, 0, -1.0, -5.0), (1, 1, -0.1, -3.0), (1, 2, -2.0, -0.2), (1, 3, -0.1, -0.2)]
    df = spark.createDataFrame(rows, "doc_id long, pos int, ls double, le double")
    r = Q.best_span(df, "doc_id").first()
    assert (r["start_tok"], r["end_tok"]) == (1, 2)


def test_long_itemsets(spark):
    items = list(range(31))
    df = spark.createDataFrame([(31, items, 2)], "k int, items array<int>, support long")
    subsets = I.subsets_of_size(df, 2)
    assert subsets.count() == 31 * 30 // 2 and subsets.distinct().count() == 465
    assert I.subsets_of_size(df, 31).count() == 1 and I.subsets_of_size(df, 32).count() == 0
    # of a long set, only antecedents whose support is known give rules
    known = [(31, items, 2), (30, items[:-1], 3), (30, items[1:], 3), (29, items[1:-1], 4)]
    rules = I.association_rules(spark.createDataFrame(known, df.schema), 0.4).collect()
    got = {(len(r["antecedent"]), tuple(r["consequent"]), round(r["confidence"], 3)) for r in rules}
    assert got == {(30, (30,), 0.667), (30, (0,), 0.667), (29, (0, 30), 0.5), (29, (0,), 0.75), (29, (30,), 0.75)}


def test_apriori_goes_to_the_empty_level(spark):
    rows = [(b, i) for b in range(2) for i in range(7)]
    got = I.apriori(spark.createDataFrame(rows, "basket long, item int"), 2)
    assert got.count() == 2 ** 7 - 1 and got.agg(F.max("k")).first()[0] == 7


def test_no_product_of_items(spark):
    b = baskets(spark)
    plan = I.pair_candidates(b, I.frequent_filter(I.item_support(b), 2))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_corpus_bleu_and_metric(spark):
    import math
    rows = [(1, "a b c d e", "a b c d e"), (2, "a b c d x", "a b c d e f g"), (3, "q", "r s")]
    df = spark.createDataFrame([(i, c.split(), r.split()) for i, c, r in rows], "qid int, c array<string>, r array<string>")
    got = Q.corpus_bleu(df.select("qid", F.col("c").alias("toks")), df.select("qid", F.col("r").alias("toks")), ["qid"]).first()
    want = math.exp(1 - 14 / 11) * math.exp((math.log(9 / 11) + math.log(7 / 8) + math.log(5 / 6) + math.log(3 / 4)) / 4)
    assert got["sentences"] == 3 and abs(got["bleu"] - want) < 1e-12
    none = df.limit(0)
    assert Q.corpus_bleu(none.select("qid", F.col("c").alias("toks")), none.select("qid", F.col("r").alias("toks")), ["qid"]).first()["bleu"] == 0
    pred = spark.createDataFrame([(1, "red big car"), (2, "x")], "qid int, text string")
    truths = spark.createDataFrame([(1, "red car"), (1, "red big car"), (1, "red car"), (2, "y")], "qid int, text string")
    for metric in (Q.exact_match, Q.token_f1):
        assert {r[0]: r[1] for r in Q.max_over_truths(pred, truths, "qid", metric).collect()} == {1: 1, 2: 0}

    def shorter(p, t, key):         # any function of both sides
        return p.join(t.withColumnRenamed("text", "other"), key).select(*key, (F.length("other") - F.length("text")).alias("d"))
    assert {r[0]: r[1] for r in Q.max_over_truths(pred, truths, "qid", shorter).collect()} == {1: 0, 2: 0}


def test_batches_go_across_partitions(spark):
    rows = [(i, list(range(1, 1 + i * 7 % 11))) for i in range(45)] + [(99, None)]
    df = spark.createDataFrame(rows, "i int, ids array<int>").repartition(6)
    want = sorted(rows, key=lambda r: (len(r[1] or []), r[0]))
    for n in (1, 4, 100):
        got = {r["i"]: (r["batch"], r["ids"]) for r in Q.pad_batches(df, ["i"], "ids", n).collect()}
        for k, (i, ids) in enumerate(want):
            longest = max(len(x or []) for _, x in want[k // n * n:k // n * n + n])
            assert got[i] == (k // n, (ids or []) + [0] * (longest - len(ids or [])))
        assert len(got) == len(rows)
    assert Q.pad_batches(df.limit(0), ["i"], "ids", 4).count() == 0


def test_nested_batches_pad_words_and_rows(spark):
    rows = [(1, [[5, 6], [7]]), (2, [[8]]), (3, None), (4, [[1, 2, 3, 4], None]), (5, []), (6, [[9], [9, 9], [9]])]
    df = spark.createDataFrame(rows, "i int, ids array<array<int>>").repartition(4)
    want = sorted(((i, [w or [] for w in ids or []]) for i, ids in rows), key=lambda r: (len(r[1]), r[0]))
    for n in (1, 2, 10):
        got = {r["i"]: (r["batch"], r["ids"]) for r in Q.pad_nested_batches(df, ["i"], "ids", n, pad=0).collect()}
        for k, (i, ids) in enumerate(want):
            batch = [x for _, x in want[k // n * n:k // n * n + n]]
            longest, widest = max(map(len, batch)), max((len(w) for x in batch for w in x), default=0)
            assert got[i] == (k // n, [w + [0] * (widest - len(w)) for w in ids] + [[0] * widest] * (longest - len(ids)))
        assert len(got) == len(rows)
    assert Q.pad_nested_batches(df.limit(0), ["i"], "ids", 4).count() == 0
