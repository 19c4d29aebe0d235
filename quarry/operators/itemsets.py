"""Frequent itemsets and association rules.

Baskets are long form ``(basket, item)``.  Apriori runs one Spark job
per level: candidates from a join of the previous level on its shared
prefix, pruning by a join against the previous level, support by a join
of basket items with candidate members (partial aggregation per basket),
and a reliable checkpoint per level.
"""

from __future__ import annotations

import itertools
import math
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage


def min_support_count(n_baskets: int, fraction: float) -> int:
    """keep value > support - 1 with support = n·fraction, i.e.
    value >= support when integral, else >= floor(support).  Exact
    rational arithmetic, so 0.005·14800 is 74, not 73.99999."""
    s = Fraction(n_baskets) * Fraction(str(fraction))
    return math.floor(s)


def item_support(baskets: DataFrame) -> DataFrame:
    """number of baskets holding each item (duplicates count once)."""
    return (baskets.select("basket", "item").distinct()
            .groupBy("item").agg(F.count(F.lit(1)).alias("support")))


def frequent_filter(counts: DataFrame, min_count: int) -> DataFrame:
    """F2."""
    return counts.where(F.col("support") >= min_count)


def candidate_k(prev: DataFrame, k: int) -> DataFrame:
    """k-candidates (k of 3 or more) from frequent (k-1)-sets
    (``items`` sorted arrays); pairs come from ``pair_candidates``.

    Join on the first k-2 items, append the larger last item, then keep a
    candidate only if every (k-1)-subset is frequent (subset pruning by
    an equi-join on the subset array, counted per candidate).
    """
    if k < 3:
        raise ValueError("pairs come from pair_candidates")
    p = prev.select("items")
    left = p.select(F.slice("items", 1, k - 2).alias("pre"), F.element_at("items", -1).alias("a"))
    right = p.select(F.slice("items", 1, k - 2).alias("pre"), F.element_at("items", -1).alias("b"))
    cand = left.join(right, "pre").where(F.col("a") < F.col("b")).select(
        F.concat("pre", F.array("a", "b")).alias("items"))
    # all k subsets of size k-1 (drop one position each)
    subs = cand.select("items", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("drop"))
    subs = subs.select("items", F.filter("items", lambda x, i: i != F.col("drop") - 1).alias("sub"))
    ok = subs.join(p.select(F.col("items").alias("sub")), "sub", "left_semi")
    return ok.groupBy("items").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") == k) \
             .select("items")


def pair_candidates(baskets: DataFrame, frequent: DataFrame) -> DataFrame:
    """F3 for k = 2: (basket, items) for every pair of ``frequent`` items
    (column ``item``) that a basket holds.  A pair that no basket holds has
    no support, so the product of all frequent items is never formed; the
    join on the basket is an equi-join, which AQE splits at a hot basket."""
    b = baskets.select("basket", "item").distinct().join(frequent.select("item"), "item", "left_semi")
    other = b.select("basket", F.col("item").alias("larger"))
    return b.join(other, "basket").where(F.col("item") < F.col("larger")).select("basket", F.array("item", "larger").alias("items"))


def count_support(baskets: DataFrame, cand: DataFrame, k: int) -> DataFrame:
    """Support of each candidate: baskets holding all of its k items."""
    members = cand.select("items", F.explode("items").alias("item"))
    hits = baskets.join(members, "item").groupBy("basket", "items").agg(
        F.count(F.lit(1)).alias("m"))
    return (hits.where(F.col("m") == k).groupBy("items")
            .agg(F.count(F.lit(1)).alias("support")))


def apriori(baskets: DataFrame, min_count: int) -> DataFrame:
    """all frequent itemsets as (k, items sorted, support).

    Level-wise with basket lists kept vertically: T(k) holds (basket,
    items) for every frequent k-set a basket contains.  Level k+1 extends
    each T(k) row by the basket's own larger items (a join on basket),
    keeps only candidates that survive Apriori pruning (a semi join with
    the small candidate set), counts them, and keeps the frequent ones.
    Work follows the itemsets actually present in baskets, not baskets ×
    candidates.  Stops at the first empty level; each level is
    checkpointed to the shared checkpoint folder.
    """
    b = baskets.select("basket", "item").distinct()
    l1 = frequent_filter(item_support(b), min_count)
    l1 = cut_lineage(l1.select(F.array("item").alias("items"), "support"))
    t1 = cut_lineage(b.join(l1.select(F.col("items")[0].alias("item")), "item", "left_semi"))
    levels = [l1.select(F.lit(1).alias("k"), "items", "support")]
    prev, tk = l1, t1.select("basket", F.array("item").alias("items"))
    for k in itertools.count(2):
        ext = (tk.join(t1, "basket").where(F.col("item") > F.element_at("items", -1))
               .select("basket", F.concat("items", F.array("item")).alias("items")))
        if k > 2:       # a pair of frequent items needs no pruning
            ext = ext.join(candidate_k(prev, k), "items", "left_semi")
        counts = ext.groupBy("items").agg(F.count(F.lit(1)).alias("support"))
        lk = cut_lineage(frequent_filter(counts, min_count))
        if lk.limit(1).count() == 0:
            break
        levels.append(lk.select(F.lit(k).alias("k"), "items", "support"))
        tk = cut_lineage(ext.join(lk.select("items"), "items", "left_semi"))
        prev = lk
    out = levels[0]
    for lv in levels[1:]:
        out = out.unionByName(lv)
    return out


def subsets_of_size(itemsets: DataFrame, n: int) -> DataFrame:
    """every n-subset of each itemset: one place after the other, each
    behind the one before."""
    rows = itemsets.select("items", F.array().cast(itemsets.schema["items"].dataType).alias("subset"), F.lit(0).alias("last"))
    for left in range(n - 1, -1, -1):
        room = F.size("items") - left
        places = F.when(F.col("last") < room, F.sequence(F.col("last") + 1, room)).otherwise(F.array().cast("array<int>"))
        rows = rows.select("items", "subset", F.explode(places).alias("last"))
        rows = rows.select("items", F.concat("subset", F.array(F.element_at("items", F.col("last")))).alias("subset"), "last")
    return rows.select("items", "subset")


def association_rules(itemsets: DataFrame, min_conf: float) -> DataFrame:
    """X -> Y for every frequent Z = X ∪ Y (X, Y non-empty, disjoint),
    confidence sup(Z)/sup(X) > min_conf (strict).  All consequents kept;
    only frequent unions are used (every subset of a frequent set is
    frequent, so sup(X) is always known).

    Antecedents shrink by one item per round.  Taking an item from X can
    only raise sup(X), so what follows from a rule that fails fails too, and
    a round starts from the rules that hold: work follows the result."""
    z = itemsets.where(F.col("k") >= 2).select(F.col("items").alias("z"), F.col("support").alias("sup_z"))
    sx = itemsets.select(F.col("items").alias("x"), F.col("support").alias("sup_x"))
    held = z.withColumn("x", F.col("z"))
    found = []
    while True:
        shorter = held.where(F.size("x") > 1).select("z", "sup_z", F.explode(F.transform("x", lambda e: F.array_remove("x", e))).alias("x")).distinct()
        held = cut_lineage(shorter.join(sx, "x").withColumn("confidence", F.col("sup_z") / F.col("sup_x"))
                           .where(F.col("confidence") > min_conf).select("z", "sup_z", "x", "confidence"))
        found.append(held)
        if held.limit(1).count() == 0:
            break
    rules = found[0]
    for more in found[1:]:
        rules = rules.unionByName(more)
    return rules.select(F.col("x").alias("antecedent"), F.array_except("z", "x").alias("consequent"), F.col("sup_z").alias("support"), "confidence")


def fp_growth(baskets: DataFrame, min_count: int, n_baskets: int):
    """the same itemsets from Spark ML's FP-growth (items de-duplicated
    per basket first; FP-growth rejects repeats)."""
    from pyspark.ml.fpm import FPGrowth
    arr = baskets.groupBy("basket").agg(F.array_distinct(F.collect_list("item")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=(min_count - 0.5) / n_baskets,
                     minConfidence=0.0).fit(arr)
    fi = model.freqItemsets
    return fi.select(F.size("items").alias("k"), F.array_sort("items").alias("items"),
                     F.col("freq").alias("support"))
