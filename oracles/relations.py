"""DuckDB twins of the test relations, built from base columns.

They encode the same facts as ``quarry.plans.relations`` without going
through the generated text: the web-log twin reads ``events`` directly,
the ballot twin reads ``orders`` directly, and so on.
"""

CTE = {}

CTE["clf"] = """
clf AS (
  SELECT 'u' || user_id AS host, '-' AS client_id, '-' AS user_id,
         CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END AS method,
         '/' || event_type || '/' || CAST(user_id % 20 AS VARCHAR) AS endpoint,
         CASE WHEN event_id % 89 = 0 THEN '' ELSE 'HTTP/1.0' END AS protocol,
         CAST(CASE WHEN event_id % 20 = 0 THEN 404
                   WHEN event_id % 50 = 1 THEN 500
                   WHEN event_id % 50 IN (3, 7) THEN 302
                   WHEN event_id % 10 = 9 THEN 304
                   ELSE 200 END AS INTEGER) AS response_code,
         CASE WHEN event_id % 13 = 0 THEN CAST(0 AS BIGINT)
              ELSE CAST(floor(value * 100) AS BIGINT) END AS content_size,
         CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
         CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour,
         CAST(minute(ts) AS INTEGER) AS minute, CAST(second(ts) AS INTEGER) AS second,
         event_id
  FROM events WHERE event_id % 97 <> 0 AND event_id % 103 <> 0)"""

CTE["votes"] = """
votes AS (
  SELECT o_orderpriority AS candidate_name,
         substr(o_orderpriority, 1, 1) AS candidate_ballot_order,
         CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR) AS total_votes,
         CASE WHEN o_orderkey % 17 = 0 THEN 'P' || CAST(o_custkey % 50 AS VARCHAR)
              ELSE CAST(o_custkey % 50 AS VARCHAR) END AS precinct_code,
         CAST(o_custkey % 50 AS VARCHAR) || ' - ' || o_orderstatus AS precinct_name,
         o_orderstatus AS party,
         o_orderkey, o_custkey, o_totalprice
  FROM orders)"""

CTE["xml_ok"] = """
xml_ok AS (
  SELECT c_custkey AS id, CAST(floor(c_acctbal / 10) AS INTEGER) AS reputation
  FROM customer WHERE c_custkey % 41 <> 0 AND c_custkey % 37 <> 0)"""


def with_(names, body):
    """Prefix ``body`` with the named CTEs."""
    if isinstance(names, str):
        names = [names]
    head = "WITH " + ",\n".join(CTE[n].strip() for n in names)
    b = body.lstrip()
    # a body that starts with "name AS (" carries more CTEs of its own
    sep = "\n" if b.upper().startswith(("SELECT", "(")) else ",\n"
    return head + sep + b

CTE["likes_v"] = """
likes_v AS (SELECT c_custkey AS id, c_name AS name, CAST(18 + c_custkey % 60 AS INTEGER) AS age
            FROM customer)"""

CTE["likes_e"] = """
likes_e AS (SELECT o_custkey AS src, o_orderkey % (SELECT count(*) FROM customer) AS dst,
                   CAST(floor(o_totalprice / 50000) AS INTEGER) AS likes, o_orderkey AS t
            FROM orders)"""

CTE["und"] = """
und AS (SELECT DISTINCT least(src, dst) AS u, greatest(src, dst) AS v FROM likes_e
        WHERE src <> dst)"""

CTE["tri"] = """
tri AS (SELECT e1.u AS a, e1.v AS b, e2.v AS c FROM und e1
        JOIN und e2 ON e1.v = e2.u JOIN und e3 ON e3.u = e1.u AND e3.v = e2.v)"""

CTE["hs"] = """
hs AS (SELECT DISTINCT doc_id, ('0x' || substr(md5(substr(text, p, 10)), 1, 15))::BIGINT AS x
       FROM (SELECT doc_id, text, unnest(range(1, length(text) - 8)) AS p
             FROM documents WHERE length(text) >= 10))"""

CTE["sz"] = "sz AS (SELECT doc_id, count(*) AS n FROM hs GROUP BY doc_id)"

CTE["shared"] = """
shared AS (SELECT a.doc_id AS id1, b.doc_id AS id2, count(*) AS inter
           FROM hs a JOIN hs b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2)"""

CTE["exact"] = """
exact AS (SELECT id1, id2, inter / (s1.n + s2.n - inter) AS jaccard
          FROM shared JOIN sz s1 ON s1.doc_id = id1 JOIN sz s2 ON s2.doc_id = id2)"""


def _minhash_cte():
    from quarry.operators.similarity import minhash_params
    cols = ",\n  ".join(f"min(({a} * (x % 2147483647) + {b}) % 2147483647) AS h{i}"
                        for i, (a, b) in enumerate(minhash_params(100, 1)))
    lst = ", ".join(f"h{i}" for i in range(100))
    return (f"sigw AS (SELECT doc_id,\n  {cols}\n  FROM hs GROUP BY doc_id),\n"
            f"sig AS (SELECT doc_id, list_value({lst}) AS sig FROM sigw)")


CTE["sig"] = _minhash_cte()

CTE["bk"] = """
bk AS (SELECT doc_id, band, array_to_string(sig[band * 5 + 1 : band * 5 + 5], ',') AS bucket
       FROM (SELECT doc_id, sig, unnest(range(0, 20)) AS band FROM sig))"""

CTE["bm"] = """
bm AS (SELECT a.doc_id AS id1, b.doc_id AS id2, a.band FROM bk a JOIN bk b
       ON a.band = b.band AND a.bucket = b.bucket AND a.doc_id < b.doc_id)"""

CTE["fi"] = """
b AS (SELECT DISTINCT l_orderkey AS bid, CAST(substr(p_brand, 7) AS INTEGER) AS item
      FROM lineitem JOIN part ON l_partkey = p_partkey),
ms AS (SELECT floor(0.005 * count(DISTINCT bid)) AS ms FROM b),
f1 AS (SELECT item, count(*) AS s FROM b GROUP BY item HAVING count(*) >= (SELECT ms FROM ms)),
bf AS (SELECT * FROM b WHERE item IN (SELECT item FROM f1)),
f2 AS (SELECT a.item AS i1, c.item AS i2, count(*) AS s FROM bf a JOIN bf c
       ON a.bid = c.bid AND a.item < c.item GROUP BY 1, 2 HAVING count(*) >= (SELECT ms FROM ms)),
f3 AS (SELECT a.item AS i1, c.item AS i2, d.item AS i3, count(*) AS s FROM bf a
       JOIN bf c ON a.bid = c.bid AND a.item < c.item JOIN bf d ON d.bid = a.bid AND c.item < d.item
       GROUP BY 1, 2, 3 HAVING count(*) >= (SELECT ms FROM ms)),
f4 AS (SELECT a.item AS i1, c.item AS i2, d.item AS i3, e.item AS i4, count(*) AS s FROM bf a
       JOIN bf c ON a.bid = c.bid AND a.item < c.item JOIN bf d ON d.bid = a.bid AND c.item < d.item
       JOIN bf e ON e.bid = a.bid AND d.item < e.item
       GROUP BY 1, 2, 3, 4 HAVING count(*) >= (SELECT ms FROM ms)),
fi AS (SELECT 1 AS k, [item] AS items, s AS support FROM f1
       UNION ALL SELECT 2, [i1, i2], s FROM f2
       UNION ALL SELECT 3, [i1, i2, i3], s FROM f3
       UNION ALL SELECT 4, [i1, i2, i3, i4], s FROM f4)"""

CTE["housing"] = """
housing AS (SELECT l_orderkey AS order_id, l_linenumber AS line_no,
                   l_discount * 100 AS longitude, l_tax * 100 AS latitude,
                   CAST(p_size AS DOUBLE) AS housing_median_age, l_quantity * 10 AS total_rooms,
                   CASE WHEN l_orderkey % 23 = 0 THEN NULL ELSE l_quantity * 3 END AS total_bedrooms,
                   l_quantity * 7 + p_size AS population, l_quantity * 2 AS households,
                   p_retailprice / 100 AS median_income, l_extendedprice AS median_house_value,
                   p_type AS ocean_proximity
            FROM lineitem JOIN part ON l_partkey = p_partkey)"""

CTE["dflt"] = """
dflt AS (SELECT d.doc_id, l.quality AS label, CAST(d.n_chars AS DOUBLE) AS n_chars
         FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"""
