import random
from itertools import combinations

import numpy as np
import pytest

from quarry.llm import hyperminhash as hm


def shingle_set(text):
    ws = (text or "").encode().lower().split()
    return {tuple(ws[i:i + 2]) for i in range(len(ws) - 1)} or ({(ws[0],)} if ws else set())


def brute(rows):
    """component of each doc_id, by all pairs."""
    sets = {i: shingle_set(t) for i, t in rows}
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((top(a), top(b)))
            up[y] = x
    return {i: (len(sets[i]), top(i)) for i in sets}


def random_sets(rnd, n, j):
    """Two sets of n and about n hashes with Jaccard similarity j."""
    both = round(n * 2 * j / (1 + j))
    x = rnd.integers(0, 1 << 63, 2 * n - both, dtype=np.uint64)
    return np.unique(x[:n]), np.unique(x[n - both:])


def test_estimate_is_corrected():
    rnd = np.random.default_rng(0)
    for n, j in ((40, 0.8), (300, 0.5), (3000, 0.8), (3000, 0.0), (50_000, 0.0)):
        got = []
        for _ in range(60):
            a, b = random_sets(rnd, n, j)
            r, s = np.array([hm.sketch(a), hm.sketch(b)]), np.array([len(a), len(b)])
            got.append(hm.estimate(r, s, 0, np.array([1]))[0][0])
        assert abs(np.mean(got) - j) < 0.03
    assert hm.chance(10, 10) > hm.chance(10, 20) > 0


def test_registers():
    s = np.array([5], np.uint64)
    r = hm.sketch(s)
    assert (r != hm.EMPTY).sum() == 1 and (hm.sketch(np.zeros(0, np.uint64)) == hm.EMPTY).all()
    g = int(hm.mix(s + np.uint64(0x9E3779B97F4A7C15))[0])
    rest = g & ((1 << 57) - 1)
    zeros = 57 - rest.bit_length()
    assert int(r[g >> 57]) == zeros << 10 | (rest >> (rest.bit_length() - 11)) & 1023


def test_forest_connects_what_is_linked():
    rnd = random.Random(4)
    for _ in range(50):
        n = rnd.randint(1, 30)
        pairs = {tuple(sorted(rnd.sample(range(n), 2))) for _ in range(rnd.randint(0, n))} if n > 1 else set()
        links = hm.forest(n, lambda i, o, p=pairs: np.array([x for x in o if tuple(sorted((i, int(x)))) in p], int))
        assert all(tuple(sorted(e)) in pairs for e in links)

        def reach(edges, n=n):
            up = list(range(n))
            for _ in range(n):
                for a, b in edges:
                    up[a] = up[b] = min(up[a], up[b])
            return up
        assert reach(links) == reach(pairs) and len(links) == n - len(set(reach(pairs)))


def near_copies(rnd, base, edits):
    ws = base.split()
    for _ in range(edits):
        ws[rnd.randrange(len(ws))] = f"new{rnd.randrange(10 ** 6)}"
    return " ".join(ws)


@pytest.mark.parametrize("chunk", [1024, 7])
def test_documents(spark, monkeypatch, chunk):
    monkeypatch.setattr(hm, "CHUNK", chunk)
    rnd = random.Random(chunk)
    rows = []
    for g in range(6):
        base = " ".join(f"w{rnd.randrange(3000)}" for _ in range(rnd.choice([6, 30, 150])))
        rows += [near_copies(rnd, base, rnd.choice([0, 1, 2, 5, 12])) for _ in range(25)]
    rows += ["A b C", "a B c", "a b  c", "\tone\n", "one", "ONE", "two", "", None, "\x1cone", "é É", "É é", "x " * 30_000, "x " * 10]
    rnd.shuffle(rows)
    rows = [(i * 3 + 5, t, "s", 1) for i, t in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, component_id int")
    got = {r.doc_id: r for r in hm.components(df).collect()}
    want = brute([(i, t) for i, t, *_ in rows])
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, "some text here"), (1, "some text here"), (None, "some text here"), (None, "alone with null"), (None, None), (4, "")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in hm.components(df).collect())
    assert got == [(0, 0, 0, True), (0, 2, 0, True), (0, 2, 1, False), (1, 2, 1, True), (1, 2, 1, True), (4, 0, 4, True)]
    assert hm.components(df.limit(0)).collect() == []


def test_query_equals_sql(spark):
    import duckdb

    import __spark_entry__ as e
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    want = con.execute(e.oracle_sql()["op7_hyperminhash_dedup"]).fetchall()
    got = e.queries()["op7_hyperminhash_dedup"](spark, "/root/testdata/sf0.01").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_registers_rule_out_links_with_a_stated_chance():
    for lucky in (0.0, 0.002, 0.3):
        p = 0.8 + 0.2 * lucky
        for n in (1, 20, 64, 128):
            c = int(hm.cuts(80, lucky)[n])
            below = sum(hm.math.comb(n, k) * p ** k * (1 - p) ** (n - k) for k in range(c))
            assert below <= hm.MISS < below + hm.math.comb(n, c) * p ** c * (1 - p) ** (n - c)


def test_bound_on_sets_loses_no_link():
    rnd = np.random.default_rng(3)
    for n in (1, 5, 40, 3000):
        for j in (0.2, 0.75, 0.8, 0.85, 1.0):
            a, b = (np.unique(s * np.uint64(2)) for s in random_sets(rnd, n, j))
            sets, sizes = [a, b], np.array([len(a), len(b)])
            counts = np.array([hm.counted(s) for s in sets])
            assert counts.sum(1).tolist() == sizes.tolist()
            true = hm.exact(sets, 0, np.array([1]), 80)
            assert set(true) <= set(hm.possible(counts, sizes, 0, np.array([1]), 80))


def test_components_in_one_task_and_in_rounds(spark):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rnd.randrange(100, 200), rnd.randrange(100, 200)) for _ in range(70)] + [(300, 300), (7, 3), (7, 3)]
    want = hm.least_reached(edges)
    assert want[60] == 0 and want[300] == 300
    df = spark.createDataFrame(edges, hm.EDGES).repartition(7)
    for one_task in (10_000, 5):
        got = {r.cid: r.component for r in hm._components(df, one_task).collect()}
        assert {k: v for k, v in want.items() if k != 300} == {k: v for k, v in got.items() if k != 300}
    assert hm._components(spark.createDataFrame([], hm.EDGES)).count() == 0
