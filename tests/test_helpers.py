"""Schema-only helpers and the cooling schedule."""

from quarry.operators.mlops import split_by_kind
from quarry.operators.partition import cooling
from quarry.operators.relational import schema_of


def test_schema_helpers(spark):
    df = spark.createDataFrame([(1.0, 2, "a", 3.0)], "x double, n int, cat string, label double")
    assert schema_of(df) == [("x", "double"), ("n", "int"), ("cat", "string"), ("label", "double")]
    assert split_by_kind(df, "label", ["cat"]) == ["x", "n"]


def test_cooling():
    t, seen = 2.0, []
    for _ in range(15):
        t = cooling(t, 0.1)
        seen.append(round(t, 6))
    assert seen[0] == 1.9 and seen[-1] == 1.0 and min(seen) == 1.0
    assert abs(cooling(1.0, 0.9, mode="exponential") - 0.9) < 1e-12


def test_global_row_number_and_cumsum(spark):
    from pyspark.sql import functions as F

    from quarry.operators.ordering import global_cumsum_before, global_row_number
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("k"), (F.col("id") % 3).alias("v"))
    rn = {r["k"]: r["rn"] for r in global_row_number(df, [F.col("k")], "rn").collect()}
    assert rn == {k: k + 1 for k in range(1000)}
    cs = {r["k"]: r["before"] for r in global_cumsum_before(df, [F.col("k")], "v", "before").collect()}
    vals = {r["k"]: r["v"] for r in df.collect()}
    run, want = 0, {}
    for k in range(1000):
        want[k] = run
        run += vals[k]
    assert cs == want


def test_quantiles_without_a_window_per_target(spark):
    import random

    import numpy as np
    from quarry.operators import mlops as M
    rnd = random.Random(3)
    rows = [(rnd.choice([1, 2, None]), rnd.choice([None, 0.0, -1.5, 7.25, rnd.random()])) for _ in range(400)] + [(9, 4.0), (8, None)]
    df = spark.createDataFrame(rows, "label int, x double")
    got = {r["_t"]: [r["a"], r["b"], r["c"]] for r in M.quantiles_by_target(df, "label", "x", {"a": 0, "b": 0.37, "c": 1}).collect()}
    want = {t: np.quantile([x for u, x in rows if u == t and x is not None], [0, 0.37, 1]) for t in (1, 2, None, 9)}
    assert got.keys() == want.keys() and all(np.allclose(got[t], want[t]) for t in want)
    full = {r["label"]: r["p50"] for r in M.distribution_by_target(df, "label", "x").collect()}
    assert full[8] is None and full[9] == 4.0 and len(full) == 5
    assert M.distribution_by_target(df.limit(0), "label", "x").count() == 0


def test_rows_of_a_fit_are_dealt_where_one_partition_has_too_many(spark):
    from quarry.operators.mlops import evened
    rows = spark.range(0, 10_000, 1, 1).selectExpr("id AS order_id", "1 AS line_no")
    assert evened(rows, 10_000).rdd.getNumPartitions() == 1
    dealt = evened(rows, 1_000)
    sizes = [n for n in dealt.rdd.glom().map(len).collect() if n]
    assert len(sizes) == 10 and max(sizes) < 1_100 and sorted(r[0] for r in dealt.collect()) == list(range(10_000))


def test_clustering_a_graph_without_edges(spark, tmpdir_path):
    from quarry.plans.songs import q_pic
    from quarry.tables import Tables
    part = "p_partkey long, p_name string, p_brand string"
    spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], part).write.parquet(f"{tmpdir_path}/part.parquet")
    spark.createDataFrame([(1, 1), (2, 2)], "l_partkey long, l_suppkey long").write.parquet(f"{tmpdir_path}/lineitem.parquet")
    found = q_pic(Tables(spark, tmpdir_path))
    assert found.count() == 0 and dict(found.dtypes) == {"id": "bigint", "cluster": "int"}
