"""Web-log analytics (S1, P1-P3, P6, A3-A8, O3-O5) on ``clf_lines``."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.logparse import parse_clf, parse_counts, parse_split
from quarry.operators import relational as R
from quarry.plans.registry import query
from quarry.plans.relations import clf_lines


def access_logs(t):
    accepted, _ = parse_split(clf_lines(t))
    return accepted


@query("clf_parse")
def q_clf_parse(t):
    """Every accepted line, parsed."""
    return access_logs(t).select("host", "client_id", "user_id", "method", "endpoint",
                                 "protocol", "response_code", "content_size")


@query("clf_time_parts")
def q_clf_time_parts(t):
    """Wall-clock parts of each accepted line (zone dropped)."""
    return access_logs(t).select("host", "endpoint", "year", "month", "day",
                                 "hour", "minute", "second")


@query("parse_split")
def q_parse_split(t):
    """Total / accepted / rejected in one pass."""
    return parse_counts(clf_lines(t))


@query("rejected_lines")
def q_rejected_lines(t):
    """The raw text of lines that did not parse."""
    return parse_clf(clf_lines(t)).where("NOT ok").select("raw")


@query("size_stats")
def q_size_stats(t):
    """A4: integer average, min, max content size."""
    return R.size_stats(access_logs(t), "content_size")


@query("count_by_key")
def q_count_by_key(t):
    """A3: requests per response code."""
    return R.count_by_key(access_logs(t), "response_code")


@query("top_k_by_count")
def q_top_endpoints(t):
    """O3: ten most requested endpoints."""
    return R.top_k_by_count(R.count_by_key(access_logs(t), "endpoint"), "endpoint", 10)


@query("top_failed_endpoints")
def q_top_failed(t):
    """O3 + P6: ten endpoints with most non-200 responses (flagship)."""
    failed = access_logs(t).where(F.col("response_code") != 200)
    return R.top_k_by_count(R.count_by_key(failed, "endpoint"), "endpoint", 10)


@query("filter_ne")
def q_filter_ne(t):
    """Requests whose status is not 200."""
    return access_logs(t).where(F.col("response_code") != 200).select(
        "host", "endpoint", "response_code")


@query("filter_eq")
def q_filter_eq(t):
    """404 requests."""
    return access_logs(t).where(F.col("response_code") == 404).select(
        "host", "endpoint", "day")


@query("filter_gt")
def q_filter_gt(t):
    """Endpoints requested more than 10 times."""
    return R.count_by_key(access_logs(t), "endpoint").where(F.col("count") > 10)


@query("count_distinct_all")
def q_unique_hosts(t):
    """Number of distinct hosts."""
    return R.count_distinct_all(access_logs(t), "host", "unique_hosts")


@query("approx_count_distinct")
def q_unique_hosts_approx(t):
    """A6 variant: HyperLogLog++ estimate (rows-only check)."""
    return R.count_distinct_all(access_logs(t), "host", "unique_hosts", approx=True)


@query("count_distinct_by_key")
def q_unique_hosts_by_day(t):
    """Distinct hosts per day."""
    return R.count_distinct_by_key(access_logs(t), "day", "host", "unique_hosts")


@query("requests_per_host_by_day")
def q_requests_per_host(t):
    """Requests per distinct host per day, integer division."""
    return R.count_per_distinct_by_key(access_logs(t), "day", "host", "avg_requests")


@query("top_404_endpoints")
def q_top_404_endpoints(t):
    """O3: ten endpoints with most 404s."""
    nf = access_logs(t).where(F.col("response_code") == 404)
    return R.top_k_by_count(R.count_by_key(nf, "endpoint"), "endpoint", 10)


@query("top_404_hosts")
def q_top_404_hosts(t):
    """O3: ten hosts with most 404s."""
    nf = access_logs(t).where(F.col("response_code") == 404)
    return R.top_k_by_count(R.count_by_key(nf, "host"), "host", 10)


@query("top_404_days")
def q_top_404_days(t):
    """O3: five days with most 404s."""
    nf = access_logs(t).where(F.col("response_code") == 404)
    return R.top_k_by_count(R.count_by_key(nf, "day"), "day", 5)


@query("first_k_natural")
def q_404_by_day(t):
    """404s per day, first 30 days in day order."""
    nf = access_logs(t).where(F.col("response_code") == 404)
    return R.first_k_natural(R.count_by_key(nf, "day"), "day", 30)


@query("errors_by_hour")
def q_404_by_hour(t):
    """404s per hour of day, 24 hours in order."""
    nf = access_logs(t).where(F.col("response_code") == 404)
    return R.first_k_natural(R.count_by_key(nf, "hour"), "hour", 24)


@query("take_any")
def q_take_any(t):
    """Forty distinct 404 endpoints (stable order)."""
    nf = access_logs(t).where(F.col("response_code") == 404).select("endpoint").distinct()
    return R.take_any(nf, 40, "endpoint")
