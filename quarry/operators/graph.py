"""Property graphs as a pair of DataFrames.

``vertices(id, ...)`` and ``edges(src, dst, ...)``.  Every operator is a
join or an aggregate; hubs (one vertex holding a third of all edges) are
handled by partial aggregation (degrees, messages) and by AQE skew-join
splitting, never by collecting a vertex's neighbourhood.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage


@dataclass
class Graph:
    """G1: vertices(id, attrs...) + edges(src, dst, attrs...)."""
    vertices: DataFrame
    edges: DataFrame

    def counts(self) -> DataFrame:
        nv = self.vertices.select(F.count(F.lit(1))).scalar()
        return self.edges.agg(F.count(F.lit(1)).alias("n_edges")).select(
            nv.alias("n_vertices"), "n_edges")


def _prefixed(v: DataFrame, prefix: str) -> DataFrame:
    return v.select([F.col(c).alias(f"{prefix}{c}") for c in v.columns])


def triplets(g: Graph) -> DataFrame:
    """Each edge with both end attributes (``src_*``, ``dst_*``)."""
    s, d = _prefixed(g.vertices, "src_"), _prefixed(g.vertices, "dst_")
    return (g.edges.join(s, g.edges["src"] == s["src_id"], "inner")
            .join(d, F.col("dst") == d["dst_id"], "inner")
            .drop("src_id", "dst_id"))


def subgraph(g: Graph, vpred: Column, epred: Column | None = None) -> Graph:
    """Vertices passing ``vpred``; edges whose both ends pass (and epred)."""
    v = g.vertices.where(vpred)
    e = g.edges if epred is None else g.edges.where(epred)
    ids = v.select("id")
    e = (e.join(ids.withColumnRenamed("id", "src"), "src", "left_semi")
          .join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi"))
    return Graph(v, e)


def in_degrees(g: Graph) -> DataFrame:
    """(id, in_deg); vertices without in-edges are absent."""
    return g.edges.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("in_deg"))


def out_degrees(g: Graph) -> DataFrame:
    """(id, out_deg)."""
    return g.edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("out_deg"))


def vertices_with_degrees(g: Graph) -> DataFrame:
    """Every vertex with in/out degree, 0 when it has none."""
    return (g.vertices.join(in_degrees(g), "id", "left")
            .join(out_degrees(g), "id", "left")
            .withColumn("in_deg", F.coalesce("in_deg", F.lit(0)).cast("long"))
            .withColumn("out_deg", F.coalesce("out_deg", F.lit(0)).cast("long")))


def aggregate_messages(g: Graph, send: Callable[[DataFrame], Column],
                       merge: Callable[[Column], Column | list],
                       to: str = "dst") -> DataFrame:
    """``send(triplets) -> msg`` per edge, ``merge(msg)`` per target.

    The merge must be an associative aggregate (sum, max, max_by, avg...),
    so Spark combines map-side before the shuffle on the target id.
    """
    tr = triplets(g)
    msgs = tr.select(F.col(to).alias("id"), send(tr).alias("msg"))
    aggs = merge(F.col("msg"))
    aggs = aggs if isinstance(aggs, list) else [aggs]
    return msgs.groupBy("id").agg(*aggs)


def connected_components(g: Graph) -> DataFrame:
    """(id, component) with component = least vertex id reachable.

    Alternating large-star / small-star rounds (Kiveris et al., 2014):
    every step is one aggregate and one join over the edge list, so a
    hub never gathers its neighbourhood in one task.  Each round's edge
    set is checkpointed (reliable, shared folder) to cut lineage.  The
    loop ends when the edges form a star forest (no parent is itself a
    child, no child has two parents): an exact test, one aggregate.
    """
    e = (g.edges.select(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v"))
         .where(F.col("u") != F.col("v")).distinct())
    e = cut_lineage(e)
    while not _is_star_forest(e):
        e = cut_lineage(_small_star(_large_star(e)))
    # e is now (v, root) with root < v; roots and isolated vertices label themselves
    labels = e.select(F.col("v").alias("id"), F.col("u").alias("component"))
    return (g.vertices.select("id").join(labels, "id", "left")
            .withColumn("component", F.coalesce("component", "id")))


def _is_star_forest(e: DataFrame) -> bool:
    """Whether every vertex is a parent only, or the child of one parent."""
    ends = e.select(F.col("v").alias("id"), F.lit(1).alias("parents"), F.lit(0).alias("children")).union(
        e.select(F.col("u").alias("id"), F.lit(0).alias("parents"), F.lit(1).alias("children")))
    per = ends.groupBy("id").agg(F.sum("parents").alias("p"), F.sum("children").alias("c"))
    return per.where((F.col("p") > 1) | ((F.col("p") > 0) & (F.col("c") > 0))).isEmpty()


def _large_star(e: DataFrame) -> DataFrame:
    """Connect every larger neighbour of u to min(N(u) ∪ {u})."""
    sym = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    m = sym.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    out = (sym.where(F.col("v") > F.col("u")).join(m, "u")
           .select(F.col("m").alias("u"), F.col("v")))
    return out.distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Connect u and its smaller neighbours to the least of them."""
    # e holds (u smaller, v larger); the "smaller neighbours" of v are the u's
    m = e.groupBy("v").agg(F.min("u").alias("m"))
    moved = e.join(m, "v").select(F.col("m").alias("u"), F.col("u").alias("v"))
    out = moved.where(F.col("u") != F.col("v")).union(m.select(F.col("m").alias("u"), "v"))
    return out.distinct()


# ------------------------------------------------------------------ triangles

def undirected_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Drop self loops and repeats; (u, v) with u < v."""
    return (edges.select(F.least(src, dst).alias("u"), F.greatest(src, dst).alias("v"))
            .where(F.col("u") != F.col("v")).distinct())


def list_triangles(e: DataFrame) -> DataFrame:
    """All triangles (a, b, c) with a < b < c of a simple undirected edge set.

    Edges are oriented from lower to higher (degree, id) rank, so every
    vertex keeps at most sqrt(2m) out-edges.  Paths x->y->z are formed by
    an equi-join on y (a hub y has many in-edges but few out-edges, and
    AQE splits the large side) and closed by a semi join on (x, z).  Work
    is O(m^1.5), the bound for triangle listing; no vertex's neighbour
    list is ever gathered in one place.
    """
    deg = (e.select(F.col("u").alias("n")).union(e.select(F.col("v").alias("n")))
           .groupBy("n").agg(F.count(F.lit(1)).alias("d")))
    r = e.join(deg.select(F.col("n").alias("u"), F.col("d").alias("du")), "u") \
         .join(deg.select(F.col("n").alias("v"), F.col("d").alias("dv")), "v")
    u_first = (F.col("du") < F.col("dv")) | ((F.col("du") == F.col("dv")) & (F.col("u") < F.col("v")))
    o = r.select(F.when(u_first, F.col("u")).otherwise(F.col("v")).alias("x"),
                 F.when(u_first, F.col("v")).otherwise(F.col("u")).alias("y"))
    o = cut_lineage(o)      # used three times below; derive it once
    o2 = o.select(F.col("x").alias("y"), F.col("y").alias("z"))
    paths = o.join(o2, "y")
    closed = paths.join(o.select(F.col("x"), F.col("y").alias("z")), ["x", "z"], "left_semi")
    a = F.least("x", "y", "z")
    c = F.greatest("x", "y", "z")
    b = F.col("x") + F.col("y") + F.col("z") - a - c
    return closed.select(a.alias("a"), b.alias("b"), c.alias("c"))


def triangle_count(e: DataFrame) -> DataFrame:
    """One row, exact number of triangles."""
    return list_triangles(e).agg(F.count(F.lit(1)).alias("triangles"))


def local_triangle_count(e: DataFrame) -> DataFrame:
    """Triangles per vertex (vertices in none are absent)."""
    t = list_triangles(e)
    corners = t.select(F.explode(F.array("a", "b", "c")).alias("id"))
    return corners.groupBy("id").agg(F.count(F.lit(1)).alias("triangles"))


def hash_unit(seed: int, col: str) -> Column:
    """Repeatable 32-bit hash of ``seed:col`` as a bigint in [0, 2^32).

    md5 is used because DuckDB computes the identical value, which lets
    the sampled estimators be checked exactly.
    """
    hexs = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(col).cast("string"))), 1, 8)
    return F.conv(hexs, 16, 10).cast("long")


def edge_sample(stream: DataFrame, m: int, seed: int = 7) -> DataFrame:
    """G13's state: (h, t, u, v, seen), the ``m`` rows of ``stream`` (t, u,
    v) of least md5 of ``seed:t`` and how many rows it was drawn from.  m
    is the sample's bound, so the state never grows with the stream; a
    stream without rows has an empty state."""
    n = stream.select(F.count(F.lit(1)).alias("n")).scalar()
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col("t").cast("string")))
    return stream.select(h.alias("h"), "t", "u", "v").orderBy("h", "t", "u", "v").limit(m).withColumn("seen", n)


def merged_edge_samples(states: list[DataFrame], m: int) -> DataFrame:
    """The state of streams one after the other, from their states (drawn
    with the same m and seed): what is among the m least of all is among
    the m least of its own stream."""
    both = functools.reduce(DataFrame.unionByName, [s.withColumn("_of", F.lit(i)) for i, s in enumerate(states)])
    seen = both.groupBy("_of").agg(F.max("seen").alias("seen")).agg(F.sum("seen").alias("n")).select("n").scalar()
    return both.select("h", "t", "u", "v").orderBy("h", "t", "u", "v").limit(m).withColumn("seen", seen)


def _sample_scale(seen: Column, m: int) -> Column:
    """What a sampled triangle stands for: max(1, n(n-1)(n-2) / (m(m-1)(m-2)))
    with n = stream length."""
    n, mm = seen.cast("double"), float(m)
    return F.greatest(F.lit(1.0), n * (n - 1) * (n - 2) / F.lit(mm * (mm - 1) * (mm - 2)))


def triangles_from_sample(state: DataFrame, m: int) -> DataFrame:
    """The number of triangles that a state stands for, one row."""
    tau = triangle_count(undirected_edges(state, "u", "v"))
    n = F.coalesce(state.agg(F.max("seen").alias("n")).select("n").scalar(), F.lit(0).cast("long"))
    return tau.select(n.alias("stream_edges"), F.lit(m).cast("long").alias("m"), F.col("triangles").alias("sample_triangles"),
                      F.round(F.col("triangles") * _sample_scale(n, m), 3).alias("estimate"))


def local_triangles_from_sample(state: DataFrame, m: int) -> DataFrame:
    """(id, sample_triangles, estimate) per vertex of a sampled
    triangle, scaled as the whole is; all others stand at 0 and are absent."""
    n = state.agg(F.max("seen").alias("n")).select("n").scalar()
    local = local_triangle_count(undirected_edges(state, "u", "v"))
    return local.select("id", F.col("triangles").alias("sample_triangles"), F.round(F.col("triangles") * _sample_scale(n, m), 3).alias("estimate"))


def triangle_estimate_base(stream: DataFrame, m: int, seed: int = 7) -> DataFrame:
    """Sample m stream rows uniformly (seeded hash rank), count the
    triangles of the sampled simple graph, scale.

    ``stream`` is (t, u, v) including loops and repeats, as they arrived.
    """
    return triangles_from_sample(cut_lineage(edge_sample(stream, m, seed)), m)


def triangle_estimate_improved(stream: DataFrame, p: float, seed: int = 7) -> DataFrame:
    """Fixed-rate sample (edge kept iff hash < p); each arriving edge
    counts the wedges closed by two *earlier sampled* edges, weight 1/p².

    Equivalent closed form, computed without per-edge state: list the
    triangles of the distinct-edge graph once, take each triangle's last
    arriving edge, and count it when the other two edges are sampled.
    """
    first = (stream.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), "t")
             .where(F.col("u") != F.col("v")).groupBy("u", "v").agg(F.min("t").alias("t")))
    cutoff = int(p * (1 << 32))
    first = cut_lineage(first.withColumn("s", hash_unit(seed, "t") < F.lit(cutoff)))
    tri = list_triangles(first.select("u", "v"))

    def edge(x, y, tag):
        return first.select(F.col("u").alias(x), F.col("v").alias(y),
                            F.col("t").alias(f"t{tag}"), F.col("s").alias(f"s{tag}"))
    j = (tri.join(edge("a", "b", "ab"), ["a", "b"]).join(edge("b", "c", "bc"), ["b", "c"])
            .join(edge("a", "c", "ac"), ["a", "c"]))
    last = F.greatest("tab", "tbc", "tac")
    hit = (F.when(F.col("tab") == last, F.col("sbc") & F.col("sac"))
            .when(F.col("tbc") == last, F.col("sab") & F.col("sac"))
            .otherwise(F.col("sab") & F.col("sbc")))
    return j.agg(F.count_if(hit).alias("closed_wedges")).select(
        "closed_wedges", F.round(F.col("closed_wedges") / F.lit(p * p), 3).alias("estimate"))
