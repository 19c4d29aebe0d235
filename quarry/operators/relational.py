"""Relational building blocks: aggregates, top-k, joins, set operations.

All of them are thin compositions of DataFrame operators.  Aggregations
get Spark's partial + final HashAggregate (map-side combine) for free;
top-k becomes TakeOrderedAndProject (per-partition heap, k rows merged).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


# ---------------------------------------------------------------- aggregates

def count_by_key(df: DataFrame, keys, name: str = "count") -> DataFrame:
    """A3: (key, count)."""
    return df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias(name))


def sum_by_key(df: DataFrame, keys, value: str | Column, name: str) -> DataFrame:
    """A2: sum per key."""
    v = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*_cols(keys)).agg(F.sum(v).alias(name))


def sum_all(df: DataFrame, value: Column, name: str) -> DataFrame:
    """A1: one-row total."""
    return df.agg(F.sum(value).alias(name))


def size_stats(df: DataFrame, col: str) -> DataFrame:
    """A4: integer average (sum div count), min, max, as longs."""
    c = F.col(col)
    return df.agg(F.expr(f"sum({col}) div count({col})").alias("avg_size"),
                  F.min(c).cast("long").alias("min_size"),
                  F.max(c).cast("long").alias("max_size"))


def count_distinct_all(df: DataFrame, col: str, name: str,
                       approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Exact (or HyperLogLog++) number of distinct values."""
    agg = (F.approx_count_distinct(col, rsd) if approx
           else F.count_distinct(F.col(col)))
    return df.agg(agg.alias(name))


def count_distinct_by_key(df: DataFrame, key: str, col: str,
                          name: str) -> DataFrame:
    """Distinct values per key, without materialising per-key lists."""
    return df.groupBy(key).agg(F.count_distinct(F.col(col)).alias(name))


def count_per_distinct_by_key(df: DataFrame, key: str, col: str,
                              name: str) -> DataFrame:
    """Rows per distinct value per key, integer division."""
    return (df.groupBy(key)
            .agg(F.count(F.lit(1)).alias("_n"),
                 F.count_distinct(F.col(col)).alias("_d"))
            .select(key, F.expr("_n div _d").alias(name)))


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """Count as a one-row frame (no driver round trip)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def group_avg(df: DataFrame, key: str, value: str,
              name: str = "avg_value") -> DataFrame:
    """A11 (DataFrame form)."""
    return df.groupBy(key).agg(F.avg(value).alias(name))


def group_avg_sql(df: DataFrame, key: str, value: str,
                  name: str = "avg_value") -> DataFrame:
    """A11 (SQL-text form); the frame is a parameter of the statement."""
    return df.sparkSession.sql(
        f"SELECT {key}, avg({value}) AS {name} FROM {{source}} GROUP BY {key}", source=df)


def group_count_desc(df: DataFrame, key: str) -> DataFrame:
    """Categories by size, largest first (ties by key)."""
    return count_by_key(df, key).orderBy(F.desc("count"), F.asc(key))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values per column in one pass, returned long."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column", "n_null")


def max_key(df: DataFrame, col: str, name: str = "next_id") -> DataFrame:
    """The next free id (max + 1, 0 when empty)."""
    return df.agg((F.coalesce(F.max(col), F.lit(-1)) + 1).alias(name))


def global_stats(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """A10: arbitrary one-row aggregates."""
    return df.agg(*[e.alias(n) for n, e in exprs.items()])


# ---------------------------------------------------------------- ordering

def top_k_by_count(df: DataFrame, key, k: int, count_col: str = "count") -> DataFrame:
    """O3: k largest counts; ties broken by key so the result is stable."""
    keys = _cols(key)
    return df.orderBy(F.desc(count_col), *[F.asc(c) for c in keys]).limit(k)


def first_k_natural(df: DataFrame, key, k: int) -> DataFrame:
    """First k rows in key order."""
    return df.orderBy(*_cols(key)).limit(k)


def max_row(df: DataFrame, value: str, key: str) -> DataFrame:
    """O2: best single row (ties by key)."""
    return df.orderBy(F.desc(value), F.asc(key)).limit(1)


def take_any(df: DataFrame, n: int, order) -> DataFrame:
    """N rows with a stable order (testable)."""
    return df.orderBy(*_cols(order)).limit(n)


def top_n_distinct_score(df: DataFrame, id_col: str, score_col: str,
                         n: int = 10) -> DataFrame:
    """Top n by score with one record per score.

    Rows with a null/empty id or score are dropped; for equal scores one
    record is kept (the largest id, an order-free stand-in for "last
    seen").  The n rows are returned ascending with ``rank_row`` 0..n-1.
    Plan: partial/final aggregate by score, then TakeOrderedAndProject.
    """
    clean = df.where(F.col(id_col).isNotNull() & F.col(score_col).isNotNull())
    per_score = clean.groupBy(score_col).agg(F.max(id_col).alias(id_col))
    top = per_score.orderBy(F.desc(score_col)).limit(n)
    w = Window.orderBy(F.asc(score_col))  # n rows only
    return top.withColumn("rank_row", F.row_number().over(w) - 1)


def top_n_with_ties(df: DataFrame, score_col: str, n: int = 10) -> DataFrame:
    """O6 variant: every row whose dense score rank is within n."""
    per_score = df.select(score_col).distinct()
    cut = per_score.orderBy(F.desc(score_col)).limit(n)
    return df.join(cut, score_col, "left_semi")


def hash_sample_k(df: DataFrame, k: int, seed: int, key_cols) -> DataFrame:
    """Repeatable uniform sample of k rows without replacement.

    Rows are ranked by md5(seed:key...) (reproducible in SQL engines);
    ``orderBy`` + ``limit`` is planned as TakeOrderedAndProject, a
    per-partition top-k heap merged over k rows, never a full sort.
    """
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in _cols(key_cols)]))
    return df.withColumn("_h", h).orderBy("_h").limit(k).drop("_h")


def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = 42):
    """Spark's randomSplit (deterministic for a fixed partitioning)."""
    return df.randomSplit(list(weights), seed)


def hash_split(df: DataFrame, key: str, train_pct: int = 80, seed: int = 42):
    """O11 deterministic variant: bucket by hash of the key."""
    b = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(100))
    return df.where(b < train_pct), df.where(b >= train_pct)


# ---------------------------------------------------------------- joins

def lookup_join(left: DataFrame, right: DataFrame, left_key: str,
                right_key: str) -> DataFrame:
    """Inner equi-join after casting the left key to string.

    No broadcast hint: the planner (and AQE at run time) broadcasts the
    lookup when its measured size is under the broadcast threshold and
    falls back to a shuffle join when it is not.
    """
    l2 = left.withColumn("_k", F.col(left_key).cast("string"))
    return l2.join(right, l2["_k"] == right[right_key], "inner").drop("_k")


def outer_join_default(left: DataFrame, right: DataFrame, on,
                       defaults: dict) -> DataFrame:
    """Left outer join, missing values replaced by defaults."""
    out = left.join(right, on, "left")
    for c, v in defaults.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out


def left_join_message(left: DataFrame, right: DataFrame, on, value: str,
                      message: str, name: str) -> DataFrame:
    """Left join, a text where nothing matched."""
    out = left.join(right, on, "left")
    return out.withColumn(name, F.when(F.col(value).isNull(), F.lit(message))
                          .otherwise(F.col(value).cast("string")))


def update_where_matched(base: DataFrame, updates: DataFrame, key: str,
                         col: str) -> DataFrame:
    """Replace ``col`` where an update exists (coalesce new, old)."""
    u = updates.select(F.col(key), F.col(col).alias("_new"))
    return (base.join(u, key, "left")
            .withColumn(col, F.coalesce("_new", col)).drop("_new"))


def ids_to_names(sets: DataFrame, key: str, ids: str, lookup: DataFrame,
                 lookup_id: str, lookup_name: str, out: str) -> DataFrame:
    """Set of ids -> sorted set of names; unknown ids vanish."""
    ex = sets.select(key, F.explode(ids).alias(lookup_id))
    named = ex.join(lookup.select(lookup_id, lookup_name), lookup_id, "inner")
    return named.groupBy(key).agg(
        F.array_sort(F.collect_set(lookup_name)).alias(out))


# ---------------------------------------------------------------- set ops

def distinct_union(*dfs: DataFrame) -> DataFrame:
    """O9-style: distinct within each input, concatenated (duplicates across
    inputs are kept, as in the reference)."""
    out = dfs[0].distinct()
    for d in dfs[1:]:
        out = out.unionAll(d.distinct())
    return out


def set_intersect_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """O10."""
    return a.intersect(b)


def set_union_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """O10."""
    return a.union(b).distinct()


def schema_of(df: DataFrame) -> list[tuple[str, str]]:
    """(name, type) pairs of a frame's schema; nothing is read."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
