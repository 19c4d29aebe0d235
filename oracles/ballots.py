"""Oracle SQL for ballots and the XML top-ten."""

from oracles.relations import with_

SQL = {}

SQL["project_columns"] = with_("votes", """
SELECT candidate_name, candidate_ballot_order, total_votes FROM votes""")

SQL["distinct_values"] = "SELECT DISTINCT o_orderpriority AS candidate_name, " \
    "substr(o_orderpriority, 1, 1) AS candidate_ballot_order FROM orders"

SQL["sort_asc"] = "SELECT DISTINCT substr(o_orderpriority, 1, 1) AS candidate_ballot_order, " \
    "o_orderpriority AS candidate_name FROM orders ORDER BY 1"

SQL["sum_by_key"] = """
SELECT o_orderpriority AS candidate_name,
       CAST(sum(floor(o_totalprice / 1000)) AS BIGINT) AS votes
FROM orders GROUP BY 1"""

SQL["sort_desc"] = SQL["sum_by_key"] + " ORDER BY votes DESC"

SQL["sum_all"] = "SELECT CAST(sum(floor(o_totalprice / 1000)) AS BIGINT) AS total_votes FROM orders"

SQL["lookup_join"] = """
SELECT o_orderpriority AS candidate_name, r.r_name AS friendly_name,
       CAST(sum(floor(o_totalprice / 1000)) AS BIGINT) AS votes
FROM orders JOIN region r ON CAST(substr(o_orderpriority, 1, 1) AS INTEGER) = r.r_regionkey + 1
GROUP BY 1, 2"""

SQL["numeric_codes_only"] = """
SELECT CAST(o_custkey % 50 AS INTEGER) AS precinct_code,
       CAST(o_custkey % 50 AS VARCHAR) || ' - ' || o_orderstatus AS precinct_name,
       CAST(floor(o_totalprice / 1000) AS BIGINT) AS votes
FROM orders WHERE o_orderkey % 17 <> 0"""

SQL["max_row"] = """
SELECT CAST(o_custkey % 50 AS VARCHAR) || ' - ' || o_orderstatus AS precinct_name,
       CAST(sum(floor(o_totalprice / 1000)) AS BIGINT) AS votes
FROM orders WHERE o_orderkey % 17 <> 0 GROUP BY 1 ORDER BY votes DESC, precinct_name LIMIT 1"""

SQL["top_n_distinct_score"] = with_("xml_ok", """
SELECT reputation, id, CAST(row_number() OVER (ORDER BY reputation) - 1 AS INTEGER) AS rank_row
FROM (SELECT reputation, max(id) AS id FROM xml_ok GROUP BY reputation
      ORDER BY reputation DESC LIMIT 10)""")

SQL["top_n_with_ties"] = with_("xml_ok", """
SELECT reputation, id FROM xml_ok WHERE reputation IN
  (SELECT DISTINCT reputation FROM xml_ok ORDER BY reputation DESC LIMIT 10)""")

SQL["scan_xml_attrs"] = """
SELECT c_custkey AS id,
       CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE CAST(floor(c_acctbal / 10) AS INTEGER) END AS reputation
FROM customer WHERE c_custkey % 41 <> 0"""

SQL["hash_sample_k"] = """
SELECT l_orderkey, l_linenumber FROM lineitem
ORDER BY md5('7:' || CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR)) LIMIT 500"""
