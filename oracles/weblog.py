"""Oracle SQL for the web-log queries."""

from oracles.relations import with_

SQL = {}

SQL["clf_parse"] = with_("clf", """
SELECT host, client_id, user_id, method, endpoint, protocol, response_code, content_size
FROM clf""")

SQL["clf_time_parts"] = with_("clf", """
SELECT host, endpoint, year, month, day, hour, minute, second FROM clf""")

SQL["parse_split"] = """
SELECT count(*) AS total_lines,
       count(*) FILTER (WHERE event_id % 97 <> 0 AND event_id % 103 <> 0) AS accepted,
       count(*) FILTER (WHERE event_id % 97 = 0 OR event_id % 103 = 0) AS rejected
FROM events"""

SQL["rejected_lines"] = """
SELECT CASE WHEN event_id % 97 = 0 THEN 'broken line ' || CAST(event_id AS VARCHAR)
       ELSE 'u' || user_id || ' - - [garbage] "' || CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END
            || ' /' || event_type || '/' || CAST(user_id % 20 AS VARCHAR)
            || CASE WHEN event_id % 89 = 0 THEN '' ELSE ' HTTP/1.0' END || '" '
            || CASE WHEN event_id % 20 = 0 THEN '404' WHEN event_id % 50 = 1 THEN '500'
                    WHEN event_id % 50 IN (3, 7) THEN '302' WHEN event_id % 10 = 9 THEN '304' ELSE '200' END
            || ' ' || CASE WHEN event_id % 13 = 0 THEN '-' ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END
            || CASE WHEN event_id % 101 = 0 THEN ' "http://a.example/" "agent 1.0"' ELSE '' END END AS raw
FROM events WHERE event_id % 97 = 0 OR event_id % 103 = 0"""

SQL["size_stats"] = with_("clf", """
SELECT CAST(sum(content_size) // count(content_size) AS BIGINT) AS avg_size,
       min(content_size) AS min_size, max(content_size) AS max_size FROM clf""")

SQL["count_by_key"] = with_("clf", """
SELECT response_code, count(*) AS count FROM clf GROUP BY response_code""")

SQL["top_k_by_count"] = with_("clf", """
SELECT endpoint, count(*) AS count FROM clf GROUP BY endpoint
ORDER BY count DESC, endpoint LIMIT 10""")

SQL["top_failed_endpoints"] = with_("clf", """
SELECT endpoint, count(*) AS count FROM clf WHERE response_code <> 200
GROUP BY endpoint ORDER BY count DESC, endpoint LIMIT 10""")

SQL["filter_ne"] = with_("clf", """
SELECT host, endpoint, response_code FROM clf WHERE response_code <> 200""")

SQL["filter_eq"] = with_("clf", """
SELECT host, endpoint, day FROM clf WHERE response_code = 404""")

SQL["filter_gt"] = with_("clf", """
SELECT endpoint, count(*) AS count FROM clf GROUP BY endpoint HAVING count(*) > 10""")

SQL["count_distinct_all"] = with_("clf", """
SELECT count(DISTINCT host) AS unique_hosts FROM clf""")

SQL["count_distinct_by_key"] = with_("clf", """
SELECT day, count(DISTINCT host) AS unique_hosts FROM clf GROUP BY day""")

SQL["requests_per_host_by_day"] = with_("clf", """
SELECT day, CAST(count(*) // count(DISTINCT host) AS BIGINT) AS avg_requests
FROM clf GROUP BY day""")

SQL["top_404_endpoints"] = with_("clf", """
SELECT endpoint, count(*) AS count FROM clf WHERE response_code = 404
GROUP BY endpoint ORDER BY count DESC, endpoint LIMIT 10""")

SQL["top_404_hosts"] = with_("clf", """
SELECT host, count(*) AS count FROM clf WHERE response_code = 404
GROUP BY host ORDER BY count DESC, host LIMIT 10""")

SQL["top_404_days"] = with_("clf", """
SELECT day, count(*) AS count FROM clf WHERE response_code = 404
GROUP BY day ORDER BY count DESC, day LIMIT 5""")

SQL["first_k_natural"] = with_("clf", """
SELECT day, count(*) AS count FROM clf WHERE response_code = 404
GROUP BY day ORDER BY day LIMIT 30""")

SQL["errors_by_hour"] = with_("clf", """
SELECT hour, count(*) AS count FROM clf WHERE response_code = 404
GROUP BY hour ORDER BY hour LIMIT 24""")

SQL["take_any"] = with_("clf", """
SELECT DISTINCT endpoint FROM clf WHERE response_code = 404 ORDER BY endpoint LIMIT 40""")
