"""Graph jobs on the ``likes`` graph and its edge stream (G1-G15, A16-A18,
J2, J3, J8, J9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import graph as G
from quarry.plans.registry import query
from quarry.plans.relations import edge_stream, likes_graph
from quarry.session import cut_lineage
from quarry.streaming.keyed import chunks

ESTIMATE_M = 4000      # reservoir size of the base estimator (memory budget)
ESTIMATE_P = 0.5       # keep rate of the improved estimator
MIN_AGE = 30


@query("build_graph")
def q_build_graph(t):
    """G1: vertex and edge counts."""
    return likes_graph(t).counts()


@query("vertex_filter")
def q_vertex_filter(t):
    """People aged 30 or more."""
    return likes_graph(t).vertices.where(F.col("age") >= 30)


@query("triplets")
def q_triplets(t):
    """Edges with both end attributes."""
    return G.triplets(likes_graph(t))


@query("edge_filter")
def q_edge_filter(t):
    """Triplets whose edge attribute exceeds 5."""
    tr = G.triplets(likes_graph(t)).where(F.col("likes") > 5)
    return tr.select("src_name", "dst_name", "likes")


@query("subgraph_semi")
def q_subgraph(t):
    """Edges whose both ends are aged 30 or more."""
    return G.subgraph(likes_graph(t), F.col("age") >= MIN_AGE).edges


@query("in_degree")
def q_in_degree(t):
    """A18."""
    return G.in_degrees(likes_graph(t))


@query("out_degree")
def q_out_degree(t):
    """A18."""
    return G.out_degrees(likes_graph(t))


@query("map_vertices")
def q_map_vertices(t):
    """Vertices extended with zeroed degree fields."""
    v = likes_graph(t).vertices
    return v.withColumn("in_deg", F.lit(0).cast("long")).withColumn("out_deg", F.lit(0).cast("long"))


@query("vertices_with_degrees")
def q_vertices_with_degrees(t):
    """G5."""
    return G.vertices_with_degrees(likes_graph(t))


@query("outer_join_default")
def q_outer_join_default(t):
    """Every vertex with its in-degree, 0 when absent."""
    g = likes_graph(t)
    from quarry.operators.relational import outer_join_default
    return outer_join_default(g.vertices.select("id", "name"), G.in_degrees(g), "id",
                              {"in_deg": 0}).withColumn("in_deg", F.col("in_deg").cast("long"))


@query("balanced_degree_vertices")
def q_balanced(t):
    """Vertices whose in-degree equals out-degree."""
    v = G.vertices_with_degrees(likes_graph(t))
    return v.where(F.col("in_deg") == F.col("out_deg")).select("id", "name", "in_deg", "out_deg")


def oldest_follower(g):
    # message = (age, -id, name): max picks the oldest, ties to the lowest id
    return G.aggregate_messages(
        g, lambda tr: F.struct(F.col("src_age").alias("age"), (-F.col("src")).alias("nid"),
                               F.col("src_name").alias("name")),
        lambda m: F.max(m).alias("best"))


@query("max_by_message")
def q_max_by_message(t):
    """Per account, its oldest follower."""
    b = oldest_follower(likes_graph(t))
    return b.select("id", F.col("best.name").alias("follower_name"),
                    F.col("best.age").alias("follower_age"))


@query("left_join_message")
def q_left_join_message(t):
    """Every vertex with its oldest follower's name or a fixed text."""
    g = likes_graph(t)
    b = oldest_follower(g).select("id", F.col("best.name").alias("follower"))
    from quarry.operators.relational import left_join_message
    return left_join_message(g.vertices.select("id", "name"), b, "id", "follower",
                             "no followers", "oldest_follower").drop("follower")


@query("avg_message")
def q_avg_message(t):
    """Mean follower age per account."""
    a = G.aggregate_messages(likes_graph(t), lambda tr: F.col("src_age"),
                             lambda m: F.avg(m).alias("avg_age"))
    return a.select("id", F.round("avg_age", 6).alias("avg_age"))


@query("aggregate_messages")
def q_aggregate_messages(t):
    """Generic send/merge: message count and summed likes per target."""
    return G.aggregate_messages(
        likes_graph(t), lambda tr: F.col("likes"),
        lambda m: [F.count(m).alias("n_msgs"), F.sum(m).cast("long").alias("sum_likes")])


@query("connected_components")
def q_connected_components(t):
    """Components of the subgraph of ages from 30, labelled by least id."""
    sub = G.subgraph(likes_graph(t), F.col("age") >= MIN_AGE)
    return G.connected_components(sub)


@query("edge_dedup")
def q_edge_dedup(t):
    """Simple undirected edge set."""
    return G.undirected_edges(edge_stream(t), "u", "v")


@query("triangle_count")
def q_triangle_count(t):
    """Exact number of triangles."""
    return G.triangle_count(G.undirected_edges(edge_stream(t), "u", "v"))


@query("local_triangle_count")
def q_local_triangles(t):
    """Triangles per vertex."""
    return G.local_triangle_count(G.undirected_edges(edge_stream(t), "u", "v"))


@query("triangle_estimate_base")
def q_triangle_base(t):
    """Reservoir-style sample of M edges, scaled triangle count."""
    return G.triangle_estimate_base(edge_stream(t), ESTIMATE_M)


def sample_by_chunks(t, n=4):
    """G13's state kept over a stream that arrives in ``n`` chunks: each
    chunk's sample is merged with the one held so far, which is written."""
    held = None
    for chunk in chunks(edge_stream(t), n, "t"):
        new = G.edge_sample(chunk, ESTIMATE_M)
        held = cut_lineage(new if held is None else G.merged_edge_samples([held, new], ESTIMATE_M))
    return held if held is not None else G.edge_sample(edge_stream(t), ESTIMATE_M)


@query("triangle_estimate_merged")
def q_triangle_merged(t):
    """G13 over four chunks of the stream, by the state that merges."""
    return G.triangles_from_sample(sample_by_chunks(t), ESTIMATE_M)


@query("triangle_estimate_local")
def q_triangle_local(t):
    """G13's local estimates: scaled triangles of the sample per vertex."""
    return G.local_triangles_from_sample(sample_by_chunks(t), ESTIMATE_M)


@query("triangle_estimate_improved")
def q_triangle_improved(t):
    """Fixed-rate sample, wedges closed by each arriving edge."""
    return G.triangle_estimate_improved(edge_stream(t), ESTIMATE_P)
