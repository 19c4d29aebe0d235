"""Oracle SQL for the keyed streams."""

SQL = {}

SQL["split_key_value"] = """
SELECT event_id AS arrival, event_type AS key,
       CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(floor(value) AS BIGINT) END AS value,
       event_id % 101 <> 0 AS ok
FROM events"""

_RUN = """
SELECT event_type AS key, event_id AS arrival,
       round(avg(floor(value)) OVER w, 6) AS avg, count(*) OVER w AS n
FROM events WHERE event_id % 101 <> 0
WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING)"""

SQL["running_avg_by_key"] = _RUN
SQL["stateful_running_avg"] = _RUN
SQL["log_source_running_avg"] = _RUN

_LAST = """
SELECT event_type AS key, round(avg(floor(value)), 6) AS avg, count(*) AS n
FROM events WHERE event_id % 101 <> 0 GROUP BY event_type"""

SQL["upsert_by_key"] = _LAST
SQL["checkpointed_recovery"] = _LAST
SQL["log_source_recovery"] = _LAST
