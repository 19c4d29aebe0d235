"""Oracle SQL for the graph jobs."""

from oracles.relations import CTE, with_

SQL = {}
V, E = "likes_v", "likes_e"

SQL["build_graph"] = with_([V, E], """
SELECT (SELECT count(*) FROM likes_v) AS n_vertices, count(*) AS n_edges FROM likes_e""")

SQL["vertex_filter"] = with_(V, "SELECT id, name, age FROM likes_v WHERE age >= 30")

SQL["triplets"] = with_([V, E], """
SELECT e.src, e.dst, e.likes, s.name AS src_name, s.age AS src_age,
       d.name AS dst_name, d.age AS dst_age
FROM likes_e e JOIN likes_v s ON e.src = s.id JOIN likes_v d ON e.dst = d.id""")

SQL["edge_filter"] = with_([V, E], """
SELECT s.name AS src_name, d.name AS dst_name, e.likes
FROM likes_e e JOIN likes_v s ON e.src = s.id JOIN likes_v d ON e.dst = d.id
WHERE e.likes > 5""")

SQL["subgraph_semi"] = with_([V, E], """
SELECT src, dst, likes FROM likes_e
WHERE src IN (SELECT id FROM likes_v WHERE age >= 30)
  AND dst IN (SELECT id FROM likes_v WHERE age >= 30)""")

SQL["in_degree"] = with_(E, "SELECT dst AS id, count(*) AS in_deg FROM likes_e GROUP BY dst")
SQL["out_degree"] = with_(E, "SELECT src AS id, count(*) AS out_deg FROM likes_e GROUP BY src")

SQL["map_vertices"] = with_(V, """
SELECT id, name, age, CAST(0 AS BIGINT) AS in_deg, CAST(0 AS BIGINT) AS out_deg FROM likes_v""")

_DEG = """
SELECT v.id, v.name, v.age,
       CAST(coalesce((SELECT count(*) FROM likes_e e WHERE e.dst = v.id), 0) AS BIGINT) AS in_deg,
       CAST(coalesce((SELECT count(*) FROM likes_e e WHERE e.src = v.id), 0) AS BIGINT) AS out_deg
FROM likes_v v"""

SQL["vertices_with_degrees"] = with_([V, E], _DEG)

SQL["outer_join_default"] = with_([V, E], """
SELECT v.id, v.name, CAST(count(e.dst) AS BIGINT) AS in_deg
FROM likes_v v LEFT JOIN likes_e e ON e.dst = v.id GROUP BY v.id, v.name""")

SQL["balanced_degree_vertices"] = with_([V, E], f"""
SELECT id, name, in_deg, out_deg FROM ({_DEG}) WHERE in_deg = out_deg""")

_OLDEST = """
oldest AS (
  SELECT dst AS id, name AS follower_name, age AS follower_age FROM (
    SELECT e.dst, s.name, s.age,
           row_number() OVER (PARTITION BY e.dst ORDER BY s.age DESC, s.id ASC) AS rn
    FROM likes_e e JOIN likes_v s ON e.src = s.id JOIN likes_v d ON e.dst = d.id)
  WHERE rn = 1)"""

SQL["max_by_message"] = with_([V, E], _OLDEST + "\nSELECT * FROM oldest")

SQL["left_join_message"] = with_([V, E], _OLDEST + """
SELECT v.id, v.name, coalesce(o.follower_name, 'no followers') AS oldest_follower
FROM likes_v v LEFT JOIN oldest o ON o.id = v.id""")

SQL["avg_message"] = with_([V, E], """
SELECT e.dst AS id, round(avg(s.age), 6) AS avg_age
FROM likes_e e JOIN likes_v s ON e.src = s.id JOIN likes_v d ON e.dst = d.id GROUP BY e.dst""")

SQL["aggregate_messages"] = with_([V, E], """
SELECT e.dst AS id, count(*) AS n_msgs, CAST(sum(e.likes) AS BIGINT) AS sum_likes
FROM likes_e e JOIN likes_v s ON e.src = s.id JOIN likes_v d ON e.dst = d.id GROUP BY e.dst""")

SQL["connected_components"] = "WITH RECURSIVE " + ",\n".join(
    [CTE[V].strip(), CTE[E].strip()]) + """,
sv AS (SELECT id FROM likes_v WHERE age >= 30),
se AS (SELECT src, dst FROM likes_e WHERE src IN (SELECT id FROM sv)
       AND dst IN (SELECT id FROM sv) AND src <> dst),
sym AS (SELECT src AS a, dst AS b FROM se UNION SELECT dst, src FROM se),
reach(id, r) AS (SELECT id, id FROM sv
                 UNION SELECT reach.id, sym.b FROM reach JOIN sym ON sym.a = reach.r)
SELECT id, min(r) AS component FROM reach GROUP BY id"""

SQL["edge_dedup"] = with_([E, "und"], "SELECT u, v FROM und")

SQL["triangle_count"] = with_([E, "und", "tri"], "SELECT count(*) AS triangles FROM tri")

SQL["local_triangle_count"] = with_([E, "und", "tri"], """
SELECT id, count(*) AS triangles FROM (
  SELECT a AS id FROM tri UNION ALL SELECT b FROM tri UNION ALL SELECT c FROM tri)
GROUP BY id""")

SQL["triangle_estimate_base"] = with_(E, """
samp AS (SELECT * FROM likes_e ORDER BY md5('7:' || CAST(t AS VARCHAR)) LIMIT 4000),
sund AS (SELECT DISTINCT least(src, dst) AS u, greatest(src, dst) AS v FROM samp WHERE src <> dst),
stri AS (SELECT count(*) AS tau FROM sund e1 JOIN sund e2 ON e1.v = e2.u
         JOIN sund e3 ON e3.u = e1.u AND e3.v = e2.v),
n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM likes_e)
SELECT CAST(n.n AS BIGINT) AS stream_edges, CAST(4000 AS BIGINT) AS m, stri.tau AS sample_triangles,
       round(stri.tau * greatest(1.0, n.n * (n.n - 1) * (n.n - 2) / (4000.0 * 3999.0 * 3998.0)), 3)
         AS estimate
FROM stri, n""")

SQL["triangle_estimate_merged"] = SQL["triangle_estimate_base"]

SQL["triangle_estimate_local"] = with_(E, """
samp AS (SELECT * FROM likes_e ORDER BY md5('7:' || CAST(t AS VARCHAR)) LIMIT 4000),
sund AS (SELECT DISTINCT least(src, dst) AS u, greatest(src, dst) AS v FROM samp WHERE src <> dst),
stri AS (SELECT e1.u AS a, e1.v AS b, e2.v AS c FROM sund e1 JOIN sund e2 ON e1.v = e2.u
         JOIN sund e3 ON e3.u = e1.u AND e3.v = e2.v),
n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM likes_e)
SELECT id, count(*) AS sample_triangles,
       round(count(*) * greatest(1.0, max(n.n) * (max(n.n) - 1) * (max(n.n) - 2) / (4000.0 * 3999.0 * 3998.0)), 3)
         AS estimate
FROM (SELECT a AS id FROM stri UNION ALL SELECT b FROM stri UNION ALL SELECT c FROM stri), n GROUP BY id""")

SQL["triangle_estimate_improved"] = with_(E, """
fe AS (SELECT least(src, dst) AS u, greatest(src, dst) AS v, min(t) AS t FROM likes_e
       WHERE src <> dst GROUP BY 1, 2),
fs AS (SELECT u, v, t, ('0x' || substr(md5('7:' || CAST(t AS VARCHAR)), 1, 8))::BIGINT
                       < CAST(0.5 * 4294967296 AS BIGINT) AS s FROM fe),
tr AS (SELECT e1.t AS tab, e1.s AS sab, e2.t AS tbc, e2.s AS sbc, e3.t AS tac, e3.s AS sac
       FROM fs e1 JOIN fs e2 ON e1.v = e2.u JOIN fs e3 ON e3.u = e1.u AND e3.v = e2.v),
h AS (SELECT CASE WHEN tab = greatest(tab, tbc, tac) THEN sbc AND sac
                  WHEN tbc = greatest(tab, tbc, tac) THEN sab AND sac
                  ELSE sab AND sbc END AS hit FROM tr)
SELECT count(*) FILTER (WHERE hit) AS closed_wedges,
       round(count(*) FILTER (WHERE hit) / 0.25, 3) AS estimate FROM h""")
