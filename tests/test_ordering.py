from quarry.operators.ordering import running_before


def test_positions_and_sums(spark):
    rows = [(i * 37 % 1000, i % 5 if i % 7 else None) for i in range(1000)]
    df = spark.createDataFrame(rows, "k long, n long").repartition(5)
    got = {r.k: (r.rn, r.s) for r in running_before(running_before(df, ["k"], None, "rn"), ["k"], "n", "s").collect()}
    total = 0
    for place, (k, n) in enumerate(sorted(rows)):
        assert got[k] == (place, total)
        total += n or 0
    assert running_before(df.limit(0), ["k"], None, "rn").collect() == []
