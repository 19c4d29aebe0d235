"""Prepared sets stay with the vocabularies they were made with."""

import pytest

from quarry.sources import prepared as P

V = "token string, id int"


def test_round_trip_and_refusals(spark, tmpdir_path):
    at = {n: f"{tmpdir_path}/{n}" for n in ("a", "b", "set", "fresh")}
    a = P.save_vocabulary(spark.createDataFrame([("<unk>", 0), ("x", 1), ("y", 2)], V), at["a"])
    P.save_vocabulary(spark.createDataFrame([("<unk>", 0), ("y", 1), ("x", 2)], V), at["b"])
    rows = [(1, [1, 2]), (2, []), (3, None), (4, [0])]
    P.save_prepared(spark.createDataFrame(rows, "doc long, ids array<int>"), at["set"], {"words": a})

    df, vocab = P.load_prepared(spark, at["set"], {"words": at["a"]})
    assert sorted((r.doc, r.ids) for r in df.collect()) == rows
    assert {r.token: r.id for r in vocab["words"].collect()} == {"<unk>": 0, "x": 1, "y": 2}

    with pytest.raises(P.Mismatch, match="not made with the words vocabulary"):
        P.load_prepared(spark, at["set"], {"words": at["b"]})
    with pytest.raises(P.Mismatch, match="was made with"):
        P.load_prepared(spark, at["set"], {})
    with pytest.raises(P.Mismatch, match="holds no vocabulary"):
        P.load_prepared(spark, at["set"], {"words": at["set"]})
    with pytest.raises(FileExistsError):
        P.save_vocabulary(spark.createDataFrame([("z", 0)], V), at["a"])
    # the same content under another name is the same vocabulary
    P.save_vocabulary(spark.createDataFrame([("y", 2), ("<unk>", 0), ("x", 1)], V).repartition(3), at["fresh"])
    assert P.load_prepared(spark, at["set"], {"words": at["fresh"]})[0].count() == 4


def test_changed_or_unfinished_rows_are_refused(spark, tmpdir_path):
    path = f"{tmpdir_path}/v"
    spark.createDataFrame([("x", 1)], V).write.parquet(f"{path}/rows")
    with pytest.raises(FileNotFoundError):
        P.load_vocabulary(spark, path)
    P.save_vocabulary(spark.createDataFrame([("x", 1), (None, 2)], V), path)        # the half-written one is replaced
    assert P.load_vocabulary(spark, path).count() == 2
    spark.createDataFrame([("x", 1)], V).write.mode("append").parquet(f"{path}/rows")
    with pytest.raises(P.Mismatch, match="not those that were saved"):
        P.load_vocabulary(spark, path)


def test_content_hash(spark):
    def h(rows, schema=V):
        return P.content_hash(spark.createDataFrame(rows, schema))
    base = h([("a", 1), ("b", 2)])
    assert base == h([("b", 2), ("a", 1)])
    assert len({base, h([("a", 2), ("b", 1)]), h([("a", 1)]), h([]), h([("a", 1), ("b", 2), ("b", 2)]), h([(None, 1), ("b", 2)]),
                h([("a", 1), ("b", 2)], "token string, id long"), h([("a", 1), ("b", 2)], "word string, id int")}) == 8
