"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Every text is measured by its words: counts, symbols, repeated lines and
repeated three-word windows.  Besides fixed base rules there are scored
rules, each a ratio that is high for bad texts.  Their cutoffs come from
labelled holdouts, for every stratum (language) and rule on its own: with
k of n labelled good documents above a cutoff, the exact binomial p-value
P(Binomial(n, alpha) <= k) says how likely that is if the rule rejected a
share ``alpha`` of good documents or more.  Cutoffs are tried from the
mildest on, and the first whose p-value is above delta / (strata x rules)
ends the walk (fixed sequence inside a rule, Bonferroni across rules and
strata), so with confidence 1 - delta every chosen cutoff holds its share.
``alpha`` is the bound for all rules of a stratum together and is divided
among them.  A stratum with too few labels to prove any cutoff gets none,
and its documents pass.

Cutoffs, binomial sums and counts are DataFrame aggregations; one row per
stratum is joined back.  Holdouts are the labelled good documents that
pass the base rules.

Null texts have no words and fail the base rules.  Repeated rows are
measured one by one (in the holdouts, too), null languages are a stratum,
and extra columns are ignored.  An empty table gives an empty table;
without labels there are no cutoffs and the base rules alone decide.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import SPACE, stored

#: Scored rules, high for bad texts.
RATIOS = {
    "symbol_share": ("n_symbols", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_word_share": ("n_repeat_words", "n_words"),
}
#: Cutoffs tried for every rule, a document is rejected above one.
CUTOFFS = (0.02, 0.03, 0.05, 0.08, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5)
#: Good documents that may be rejected in a stratum, and the chance to be wrong about any.
ALPHA, DELTA = 0.03, 0.05

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
WHITE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeat_words(w: Column) -> Column:
    """How many words lie in a three-word window found twice or more.
    Windows are sorted with their places; equal neighbours repeat."""
    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def covered(placed: Column) -> Column:
        again = F.transform(placed, lambda x, i: F.when((x["w"] == F.get(placed, i + 1)["w"]) | (x["w"] == F.get(placed, i - 1)["w"]), x["p"]))
        places = F.filter(again, lambda p: p.isNotNull())
        return F.size(F.array_distinct(F.flatten(F.transform(places, lambda p: F.array(p, p + 1, p + 2)))))

    def count(found: Column) -> Column:
        placed = F.array_sort(F.transform(found, lambda x, i: F.struct(x.alias("w"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(let(placed, covered))

    return F.when(F.size(w) < 3, F.lit(0)).otherwise(let(windows, count)).cast("long")


def measure(df: DataFrame) -> DataFrame:
    """doc_id, lang and the measures of every whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, WHITE, "") != "")
    trimmed = F.btrim(text, F.lit(WHITE))
    solid = F.length(F.translate(text, WHITE, ""))
    read = df.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        solid.cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE)).alias("w"),
        lines.alias("lines"))
    return read.select(
        "doc_id", "lang", F.size("w").cast("long").alias("n_words"), "word_chars", "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("w")).alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def ratio(name: str) -> Column:
    top, bottom = RATIOS[name]
    return F.col(top) / F.greatest(F.col(bottom), F.lit(1))


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k) by the sum of its terms, in logarithms."""
    odds = math.log(p) - math.log1p(-p)
    first = n * F.lit(math.log1p(-p))

    def step(s, i):
        term = s["term"] + F.log((n - i + 1) / i) + F.lit(odds)
        high, low = F.greatest(s["total"], term), F.least(s["total"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    total = F.aggregate(terms, F.struct(first.alias("term"), first.alias("total")), step)["total"]
    # above the mean the tail is a half at least: no sum is needed to turn it down
    return F.when(k > n * p + 1, F.lit(1.0)).otherwise(F.exp(total))


def cutoffs(measured: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per stratum: lang, and for every rule its cutoff (null: none
    is proven).  ``labels``: doc_id, quality (1: good)."""
    good = labels.where(F.col("quality") == 1).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    held = measured.where(~base_failed()).join(good, "doc_id", "left_semi")
    above = [F.sum((ratio(r) > c).cast("long")).alias(f"{r}_{i}") for r in RATIOS for i, c in enumerate(CUTOFFS)]
    counts = held.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), *above)
    tried = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(c).alias("cutoff"), F.col(f"{r}_{i}").alias("k"))
                      for r in RATIOS for i, c in enumerate(CUTOFFS)])
    rows = counts.select("lang", "n", F.explode(tried).alias("x")).select("lang", "n", "x.*")
    share = alpha / len(RATIOS)
    tests = rows.withColumn("strata", F.count(F.lit(1)).over(Window.partitionBy("rule", "cutoff")))
    tests = tests.withColumn("proven", binomial_tail(F.col("n"), F.col("k"), share) <= F.lit(delta) / (F.col("strata") * len(RATIOS)))
    walk = Window.partitionBy("lang", "rule").orderBy(F.col("cutoff").desc())
    held_so_far = tests.withColumn("admissible", F.min("proven").over(walk))
    return held_so_far.groupBy("lang").agg(*[F.min(F.when(F.col("admissible") & (F.col("rule") == r), F.col("cutoff"))).alias(f"{r}_cutoff") for r in RATIOS])


def judge(df: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Measures of every document with base_failed, every rule's cutoff and kept."""
    measured = stored(measure(df), "measures")
    chosen = stored(cutoffs(measured, labels, alpha, delta), "cutoffs").withColumnRenamed("lang", "stratum")
    rejected = [F.coalesce(ratio(r) > F.col(f"{r}_cutoff"), F.lit(False)) for r in RATIOS]
    any_rule = rejected[0]
    for one in rejected[1:]:
        any_rule = any_rule | one
    joined = measured.join(chosen, F.col("lang").eqNullSafe(F.col("stratum")), "left")
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~any_rule).drop("stratum")


def oracle_sql(query: str, alpha: float = ALPHA, delta: float = DELTA) -> str:
    """The judgement as DuckDB SQL over ``documents`` and ``labels``;
    ``query`` reads its last table, ``judged``."""
    tried = ", ".join(f"({c})" for c in CUTOFFS)
    share = alpha / len(RATIOS)
    shares = {r: f"({top} / greatest({bottom}, 1))" for r, (top, bottom) in RATIOS.items()}
    above = " UNION ALL ".join(f"SELECT lang, '{r}' AS rule, c.cutoff, count(*) AS n, count(*) FILTER (WHERE {s} > c.cutoff) AS k FROM held, tried c GROUP BY ALL" for r, s in shares.items())
    chosen = " ".join(f"LEFT JOIN chosen c{i} ON c{i}.lang IS NOT DISTINCT FROM m.lang AND c{i}.rule = '{r}'" for i, r in enumerate(RATIOS))
    rejects = " OR ".join(f"coalesce({s} > c{i}.cutoff, false)" for i, s in enumerate(shares.values()))
    return rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, lang, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
windows AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM again, range(3) x(j) GROUP BY doc_id),
m AS (SELECT w.doc_id, lang, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
      (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
      (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN covered USING (doc_id)),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
held AS (SELECT * FROM based WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
tried(cutoff) AS (SELECT c::DOUBLE FROM (VALUES {tried}) x(c)),
counts AS ({above}),
tests AS (SELECT *, CASE WHEN k > n * {share!r} + 1 THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1),
      lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({share!r}) + (n - i) * ln(1 - {share!r})))) END
      <= {delta!r} / (count(*) OVER (PARTITION BY rule, cutoff) * {len(RATIOS)}) AS proven FROM counts),
walked AS (SELECT *, bool_and(proven) OVER (PARTITION BY lang, rule ORDER BY cutoff DESC) AS admissible FROM tests),
chosen AS (SELECT lang, rule, min(cutoff) AS cutoff FROM walked WHERE admissible GROUP BY lang, rule),
judged AS (SELECT m.*, NOT m.base_failed AND NOT ({rejects}) AS kept FROM based m {chosen})
{query}"""
