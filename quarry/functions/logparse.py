"""Common Log Format parsing as column expressions.

Everything here is a JVM expression: one ``regexp_replace`` and a split
for the groups, ``try_to_timestamp`` for the time, no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The Common Log Format pattern.  Nine groups: host, client
# id, user id, time with zone, method, endpoint, protocol (may be empty),
# status code, content size ("-" means 0).  Fields after the size are allowed.
CLF_PATTERN = (r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] '
               r'"(\S+) (\S+)\s*(\S*)\s*" (\d{3}) (\S+)')
CLF_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss"

# The groups as one text, a line each.  No group but the time can hold a
# line feed, so the time comes last; a match never begins with one.
_FIELDS = ["host", "client_id", "user_id", "method", "endpoint", "protocol", "status_text", "size_text", "time_text"]
_REWRITTEN = "\n" + "\n".join(f"${g}" for g in (1, 2, 3, 5, 6, 7, 8, 9, 4))


def clf_time_parts(time_text: Column) -> Column:
    """``dd/Mon/yyyy:HH:mm:ss ±zzzz`` -> wall-clock timestamp (zone dropped)."""
    return F.try_to_timestamp(F.substring(time_text, 1, 20),
                              F.lit(CLF_TIME_FORMAT))


def parse_clf(lines: DataFrame, col: str = "value") -> DataFrame:
    """One row per input line: ``raw``, ``ok`` and the parsed fields.

    The pattern runs once per line: it rewrites a matching line into its
    groups, one per line, and leaves others alone.  The parsed fields are
    only meaningful where ``ok``.
    """
    raw = F.col(col)
    once = lines.select(raw.alias("raw"), F.regexp_replace(raw, "(?s)" + CLF_PATTERN + ".*$", _REWRITTEN).alias("_groups"))
    ok = F.startswith("_groups", F.lit("\n")) & ~F.startswith("raw", F.lit("\n"))
    split = once.select("raw", ok.alias("ok"), F.split("_groups", "\n", len(_FIELDS) + 1).alias("_groups"))
    df = split.select("raw", "ok", *[F.when(F.col("ok"), F.get("_groups", F.lit(i + 1))).otherwise(F.lit("")).alias(name)
                                     for i, name in enumerate(_FIELDS)])
    ts = clf_time_parts(F.col("time_text"))
    return (df
            .withColumn("response_code", F.expr("try_cast(status_text AS INT)"))
            .withColumn("content_size",
                        F.when(F.col("size_text") == "-", F.lit(0).cast("long"))
                        .otherwise(F.expr("try_cast(size_text AS BIGINT)")))
            .withColumn("ts", ts)
            .withColumn("year", F.year(ts))
            .withColumn("month", F.month(ts))
            .withColumn("day", F.dayofmonth(ts))
            .withColumn("hour", F.hour(ts))
            .withColumn("minute", F.minute(ts))
            .withColumn("second", F.second(ts))
            .drop("status_text", "size_text"))


def parse_split(lines: DataFrame, col: str = "value"):
    """(accepted, rejected): parsed rows and raw lines that did not match."""
    parsed = parse_clf(lines, col)
    accepted = parsed.where("ok").drop("ok", "raw")
    rejected = parsed.where("NOT ok").select("raw")
    return accepted, rejected


def parse_counts(lines: DataFrame, col: str = "value") -> DataFrame:
    """One row: total, accepted and rejected line counts in one pass."""
    ok = F.col(col).rlike(CLF_PATTERN)
    return lines.agg(F.count(F.lit(1)).alias("total_lines"),
                     F.count_if(ok).alias("accepted"),
                     F.count_if(~ok).alias("rejected"))
