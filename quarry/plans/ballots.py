"""Ballot analytics on text-typed rows (P4, P5, A1, A2, A5, J1, O1, O2) and
the XML top-ten (S9, O6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import relational as R
from quarry.plans.registry import query
from quarry.plans.relations import ballot_lookup, votes, xml_rows
from quarry.sources.xmlattrs import scan_xml_attrs

def votes_int():
    return F.col("total_votes").try_cast("bigint")


@query("project_columns")
def q_project(t):
    """P4."""
    return votes(t).select("candidate_name", "candidate_ballot_order", "total_votes")


@query("distinct_values")
def q_distinct(t):
    """A5."""
    return votes(t).select("candidate_name", "candidate_ballot_order").distinct()


@query("sort_asc")
def q_sort_asc(t):
    """O1: candidates ordered by ballot order as text."""
    return (votes(t).select("candidate_ballot_order", "candidate_name").distinct()
            .orderBy("candidate_ballot_order"))


@query("sum_by_key")
def q_sum_by_key(t):
    """A2: votes per candidate."""
    return R.sum_by_key(votes(t), "candidate_name", votes_int(), "votes")


@query("sort_desc")
def q_sort_desc(t):
    """O1: candidates by votes, most first."""
    return R.sum_by_key(votes(t), "candidate_name", votes_int(), "votes").orderBy(F.desc("votes"))


@query("sum_all")
def q_sum_all(t):
    """A1: all votes."""
    return R.sum_all(votes(t), votes_int(), "total_votes")


@query("lookup_join")
def q_lookup_join(t):
    """Per-candidate totals with the friendly name (int key cast to text)."""
    per = (votes(t).groupBy("candidate_name", "candidate_ballot_order")
           .agg(F.sum(votes_int()).alias("votes"))
           .withColumn("ballot_no", F.expr("try_cast(candidate_ballot_order AS INT)"))
           .drop("candidate_ballot_order"))
    out = R.lookup_join(per, ballot_lookup(t), "ballot_no", "candidate_ballot_order")
    return out.select("candidate_name", "friendly_name", "votes")


def numeric_precincts(t):
    code = F.expr("try_cast(precinct_code AS INT)")
    return votes(t).withColumn("code", code).where(F.col("code").isNotNull())


@query("numeric_codes_only")
def q_numeric_codes(t):
    """P5: rows whose precinct code is a number."""
    return numeric_precincts(t).select(F.col("code").alias("precinct_code"),
                                       "precinct_name", votes_int().alias("votes"))


@query("max_row")
def q_max_row(t):
    """O2: the physical precinct with most votes."""
    per = R.sum_by_key(numeric_precincts(t), "precinct_name", votes_int(), "votes")
    return R.max_row(per, "votes", "precinct_name")


def xml_scores(t):
    rows = scan_xml_attrs(xml_rows(t), "_Id BIGINT, _Reputation INT")
    return rows.select(F.col("_Id").alias("id"), F.col("_Reputation").alias("reputation"))


@query("top_n_distinct_score")
def q_top_ten(t):
    """Ten best reputations, one user per reputation, ascending rows."""
    return R.top_n_distinct_score(xml_scores(t), "id", "reputation", 10)


@query("top_n_with_ties")
def q_top_ties(t):
    """O6 variant: every user within the ten best distinct reputations."""
    s = xml_scores(t).where(F.col("id").isNotNull() & F.col("reputation").isNotNull())
    return R.top_n_with_ties(s, "reputation", 10)


@query("scan_xml_attrs")
def q_scan_xml(t):
    """Attribute rows parsed; cut-off rows have no id and are dropped."""
    return xml_scores(t).where(F.col("id").isNotNull())


@query("hash_sample_k")
def q_hash_sample(t):
    """500 line items sampled by a seeded hash, repeatable."""
    return R.hash_sample_k(t.lineitem.select("l_orderkey", "l_linenumber"), 500, 7,
                           ["l_orderkey", "l_linenumber"])


@query("random_split")
def q_random_split(t):
    """O11 (rows-only): 80/20 random split sizes."""
    a, b = R.random_split(t.orders.select("o_orderkey"), (0.8, 0.2), 42)
    return a.agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("train")).unionByName(
        b.agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("test")))
