"""Frequent itemsets and rules on order baskets of part brands."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import itemsets as I
from quarry.plans.registry import query
from quarry.plans.relations import baskets

MIN_SUPPORT = 0.005    # fraction of baskets
MIN_CONF = 0.12        # strict


def _setup(t):
    b = baskets(t)
    n = b.select(F.count_distinct("basket")).first()[0]   # loop parameter only
    return b, n, I.min_support_count(n, MIN_SUPPORT)


def _fmt(df):
    return df.select("k", F.array_join("items", " ").alias("items"), "support")


@query("item_support")
def q_item_support(t):
    """baskets per item."""
    return I.item_support(baskets(t))


@query("frequent_filter")
def q_frequent_filter(t):
    """items reaching the minimum support."""
    b, _, ms = _setup(t)
    return I.frequent_filter(I.item_support(b), ms)


@query("candidate_k")
def q_candidate_k(t):
    """candidate 3-itemsets from the frequent pairs (pruned)."""
    b, _, ms = _setup(t)
    pairs = I.pair_candidates(b, I.frequent_filter(I.item_support(b), ms))
    l2 = I.frequent_filter(pairs.groupBy("items").agg(F.count(F.lit(1)).alias("support")), ms)
    c3 = I.candidate_k(l2, 3)
    return c3.select(F.array_join("items", " ").alias("items"))


def _apriori(t):
    b, _, ms = _setup(t)
    return I.apriori(b, ms)


@query("apriori")
def q_apriori(t):
    """all frequent itemsets (k, items, support)."""
    return _fmt(_apriori(t))


@query("subsets_of_size")
def q_subsets(t):
    """every 2-subset of each frequent 3-itemset."""
    fi = _apriori(t).where(F.col("k") == 3)
    s = I.subsets_of_size(fi, 2)
    return s.select(F.array_join("items", " ").alias("items"),
                    F.array_join("subset", " ").alias("subset"))


@query("association_rules")
def q_rules(t):
    """rules with confidence > 0.12, all consequents kept."""
    r = I.association_rules(_apriori(t), MIN_CONF)
    return r.select(F.array_join("antecedent", " ").alias("antecedent"),
                    F.array_join("consequent", " ").alias("consequent"),
                    "support", F.round("confidence", 6).alias("confidence"))


@query("fp_growth")
def q_fp_growth(t):
    """the same itemsets from Spark ML's FP-growth."""
    b, n, ms = _setup(t)
    return _fmt(I.fp_growth(b, ms, n))
