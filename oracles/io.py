"""Oracle SQL for the source/sink round trips."""

from oracles.relations import with_

SQL = {}

SQL["scan_text"] = "SELECT unnest(string_split(text, chr(10))) AS value FROM documents"

SQL["scan_jsonl"] = with_("votes", "SELECT candidate_name, precinct_code, total_votes FROM votes")

SQL["scan_csv"] = with_("housing", """
SELECT order_id, line_no, total_rooms, total_bedrooms, ocean_proximity FROM housing""")

SQL["scan_delimited_edges"] = with_("likes_e", """
SELECT least(src, dst) AS src, greatest(src, dst) AS dst FROM likes_e""")

SQL["scan_baskets"] = """
SELECT string_agg(CAST(item AS VARCHAR), ' ' ORDER BY item) AS items FROM (
  SELECT DISTINCT l_orderkey, CAST(substr(p_brand, 7) AS INTEGER) AS item
  FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY l_orderkey"""

SQL["scan_wholetext"] = "SELECT doc_id, CAST(length(text) + 1 AS INTEGER) AS n_chars FROM documents"

SQL["scan_keyed_table"] = "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'"

SQL["chunk_lines"] = """
SELECT doc_id, CAST(floor(line_no / 5) AS BIGINT) AS chunk,
       string_agg(value, ' ' ORDER BY line_no) AS text
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS value,
             unnest(range(0, len(string_split(text, chr(10))))) AS line_no FROM documents)
WHERE trim(value) <> '' GROUP BY 1, 2"""

_PER = """SELECT o_orderpriority AS candidate_name,
       CAST(sum(floor(o_totalprice / 1000)) AS BIGINT) AS votes FROM orders GROUP BY 1"""
SQL["write_json"] = _PER + "\nUNION ALL\n" + _PER

SQL["write_csv"] = with_("housing", """
SELECT ocean_proximity, round(avg(median_house_value), 6) AS avg_value FROM housing GROUP BY 1""")

SQL["serialise_record"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS key,
       CAST(to_json({'id': o_orderkey, 'text': o_orderpriority || ' ' || o_orderstatus, 'lang': 'en',
                'user': {'id': c_custkey, 'name': c_name, 'followersCount': c_nationkey},
                'retweetCount': CAST(o_orderkey % 7 AS INTEGER)}) AS VARCHAR) AS value
FROM orders JOIN customer ON o_custkey = c_custkey"""

SQL["parse_json_record"] = """
SELECT o_orderkey AS id, o_orderpriority || ' ' || o_orderstatus AS text, c_custkey AS user_id,
       c_name AS user_name, c_nationkey AS followers_count, CAST(o_orderkey % 7 AS INTEGER) AS retweet_count
FROM orders JOIN customer ON o_custkey = c_custkey"""

SQL["fill_missing"] = with_("housing", """
SELECT order_id, line_no, coalesce(total_bedrooms, 0.0) AS total_bedrooms FROM housing""")

SQL["drop_missing_in_column"] = with_("housing", """
SELECT order_id, line_no, total_bedrooms FROM housing WHERE total_bedrooms IS NOT NULL""")

SQL["show_head"] = with_("votes", """
SELECT candidate_name, candidate_ballot_order, total_votes, precinct_code, precinct_name, party
FROM votes ORDER BY candidate_name, precinct_code, total_votes LIMIT 20""")

SQL["row_count"] = "SELECT count(*) AS row_count FROM lineitem"

SQL["max_key"] = "SELECT coalesce(max(o_orderkey), -1) + 1 AS next_id FROM orders"

SQL["scan_line_number_keyed"] = """
WITH st AS (SELECT DISTINCT l_partkey AS id, l_suppkey AS tag FROM lineitem),
l AS (SELECT id, list_sort(list(tag)) AS tags FROM st GROUP BY id)
SELECT row_number() OVER (ORDER BY id) - 1 AS line_no, CASE WHEN id % 10 = 0 THEN '' ELSE array_to_string(tags, ' ') END AS tags,
       CAST(CASE WHEN id % 10 = 0 THEN 0 ELSE len(tags) END AS INTEGER) AS n_tags FROM l"""
