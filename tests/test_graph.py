"""Golden answers of the six-vertex social graph and small triangle cases."""

from pyspark.sql import functions as F

from quarry.operators import graph as G

# The six people and eight "likes" edges of the social lab.
PEOPLE = [(1, "Alice", 28), (2, "Bob", 27), (3, "Charlie", 65), (4, "David", 42),
          (5, "Ed", 55), (6, "Fran", 50)]
LIKES = [(2, 1, 7), (2, 4, 2), (3, 2, 4), (3, 6, 3), (4, 1, 1), (5, 2, 2), (5, 3, 8), (5, 6, 3)]


def social(spark):
    v = spark.createDataFrame(PEOPLE, "id long, name string, age int")
    e = spark.createDataFrame(LIKES, "src long, dst long, likes int")
    return G.Graph(v, e)


def test_followers(spark):
    g = social(spark)
    d = {r["name"]: r["in_deg"] for r in G.vertices_with_degrees(g).collect()}
    assert d == {"Alice": 2, "Bob": 2, "Charlie": 1, "David": 1, "Ed": 0, "Fran": 2}


def test_oldest_follower(spark):
    g = social(spark)
    best = G.aggregate_messages(
        g, lambda tr: F.struct(F.col("src_age").alias("age"), (-F.col("src")).alias("nid"),
                               F.col("src_name").alias("name")),
        lambda m: F.max(m).alias("b"))
    got = {r["id"]: r["b"]["name"] for r in best.collect()}
    names = {1: "David", 2: "Charlie", 3: "Ed", 4: "Bob", 6: "Charlie"}
    assert got == names          # Ed (5) has no follower


def test_subgraph_and_components(spark):
    g = social(spark)
    sub = G.subgraph(g, F.col("age") >= 30)
    assert {tuple(r) for r in sub.edges.select("src", "dst").collect()} == {(3, 6), (5, 3), (5, 6)}
    cc = {r["id"]: r["component"] for r in G.connected_components(g).collect()}
    assert set(cc.values()) == {1}


def test_components_two_groups(spark):
    v = spark.createDataFrame([(i,) for i in range(1, 11)], "id long")
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (7, 8), (9, 8)], "src long, dst long")
    cc = {r["id"]: r["component"] for r in G.connected_components(G.Graph(v, e)).collect()}
    assert cc == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 6, 7: 7, 8: 7, 9: 7, 10: 10}


def test_triangles_k4_plus_tail(spark):
    edges = [(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4), (4, 5), (5, 6)]
    e = G.undirected_edges(spark.createDataFrame(edges, "src long, dst long"))
    assert G.triangle_count(e).first()[0] == 4
    local = {r["id"]: r["triangles"] for r in G.local_triangle_count(e).collect()}
    assert local == {1: 3, 2: 3, 3: 3, 4: 3}


def test_improved_estimator_exact_at_p1(spark):
    edges = [(1, 1, 2), (2, 1, 3), (3, 2, 3), (4, 3, 4), (5, 2, 4), (6, 1, 4), (7, 2, 2)]
    s = spark.createDataFrame(edges, "t long, u long, v long")
    r = G.triangle_estimate_improved(s, 1.0).first()
    assert r["estimate"] == 4.0


def test_merged_samples_and_local_estimates(spark):
    import random
    rnd = random.Random(2)
    rows = [(i, rnd.randrange(30), rnd.randrange(30)) for i in range(400)]
    s = spark.createDataFrame(rows, "t long, u long, v long")
    whole = G.edge_sample(s, 120)
    parts = [G.edge_sample(s.where(F.col("t") % 3 == i), 120) for i in range(3)]
    merged = G.merged_edge_samples([G.merged_edge_samples(parts[:2], 120), parts[2]], 120)
    assert sorted(merged.collect()) == sorted(whole.collect())
    edges = {(min(r.u, r.v), max(r.u, r.v)) for r in whole.collect() if r.u != r.v}
    around = {x: {b for a, b in edges if a == x} | {a for a, b in edges if b == x} for x in range(30)}
    count = {x: sum(1 for a, b in edges if a in around[x] and b in around[x]) for x in range(30)}
    scale = 400 * 399 * 398 / (120 * 119 * 118)
    got = {r.id: (r.sample_triangles, r.estimate) for r in G.local_triangles_from_sample(merged, 120).collect()}
    assert got == {x: (n, round(n * scale, 3)) for x, n in count.items() if n}
    total = G.triangles_from_sample(merged, 120).first()
    assert total.stream_edges == 400 and 3 * total.sample_triangles == sum(count.values())
    # a sample of everything is exact; streams without rows weigh nothing
    assert G.triangles_from_sample(G.merged_edge_samples([G.edge_sample(s, 1000), G.edge_sample(s.limit(0), 1000)], 1000), 1000).first().stream_edges == 400
    empty = G.triangles_from_sample(G.edge_sample(s.limit(0), 50), 50).first()
    assert (empty.stream_edges, empty.sample_triangles, empty.estimate) == (0, 0, 0.0)
