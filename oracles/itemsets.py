"""Oracle SQL for frequent itemsets: plain k-way self joins per basket
(no Apriori pruning) and subset masks for rules."""

from oracles.relations import with_

SQL = {}

SQL["item_support"] = """
SELECT item, count(*) AS support FROM (
  SELECT DISTINCT l_orderkey, CAST(substr(p_brand, 7) AS INTEGER) AS item
  FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY item"""

SQL["frequent_filter"] = with_("fi", "SELECT item, s AS support FROM f1")

SQL["candidate_k"] = with_("fi", """
SELECT CAST(x.i1 AS VARCHAR) || ' ' || CAST(x.i2 AS VARCHAR) || ' ' || CAST(y.i2 AS VARCHAR) AS items
FROM f2 x JOIN f2 y ON x.i1 = y.i1 AND x.i2 < y.i2
WHERE (x.i2, y.i2) IN (SELECT i1, i2 FROM f2)""")

SQL["apriori"] = with_("fi", """
SELECT k, array_to_string(items, ' ') AS items, support FROM fi""")

SQL["fp_growth"] = SQL["apriori"]

SQL["subsets_of_size"] = with_("fi", """
SELECT array_to_string([i1, i2, i3], ' ') AS items, array_to_string(sub, ' ') AS subset
FROM (SELECT i1, i2, i3, [i1, i2] AS sub FROM f3 UNION ALL SELECT i1, i2, i3, [i1, i3] FROM f3
      UNION ALL SELECT i1, i2, i3, [i2, i3] FROM f3)""")

SQL["association_rules"] = with_("fi", """
zm AS (SELECT items AS z, support AS sz, m FROM fi, range(1, (1 << len(items)) - 1) r(m)
       WHERE len(items) >= 2),
ze AS (SELECT z, sz, m, unnest(z) AS e, unnest(range(0, len(z))) AS i FROM zm),
ant AS (SELECT z, sz, m,
               list_sort(list(e) FILTER (WHERE (m >> i) & 1 = 1)) AS ante,
               list_sort(list(e) FILTER (WHERE (m >> i) & 1 = 0)) AS cons
        FROM ze GROUP BY z, sz, m)
SELECT array_to_string(ante, ' ') AS antecedent, array_to_string(cons, ' ') AS consequent,
       sz AS support, round(sz / fx.support, 6) AS confidence
FROM ant JOIN fi fx ON fx.items = ant.ante
WHERE sz / fx.support > 0.12""")
