"""Feature pipelines, regression, classification and their metrics
(M1-M14, A9, A13, A14, A22, P7-P9) on Spark ML and DataFrame aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.ordering import running_sums

#: Rows of a partition that a fit goes over again and again, widened to one
#: number per feature.
FIT_ROWS = 1 << 18


def evened(df: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """``df`` dealt to partitions of about ``rows`` rows if one has more, else
    as it is: files are split by their bytes, and many rows of a compressed
    file are few of them."""
    sizes = df.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    total, most = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    return df if most <= rows else df.repartition(-(-total // rows))


def split_by_kind(df: DataFrame, label: str, categorical: Sequence[str]) -> list[str]:
    """Numeric feature names = all columns minus label and categoricals
    (schema only; nothing is read)."""
    return [c for c, t in df.dtypes if c != label and c not in categorical
            and t in ("double", "float", "int", "bigint", "smallint", "decimal")]


def derive_ratios(df: DataFrame) -> DataFrame:
    """Three ratio columns; ``try_divide`` gives null for a zero divisor."""
    return (df.withColumn("rooms_per_household", F.try_divide("total_rooms", "households"))
              .withColumn("bedrooms_per_room", F.try_divide("total_bedrooms", "total_rooms"))
              .withColumn("population_per_household", F.try_divide("population", "households")))


def describe_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A9 in long form (column, stat, value): count, mean, stddev, min, max
    in one aggregate pass."""
    aggs = []
    for c in cols:
        aggs += [F.count(c).cast("double").alias(f"{c}|count"), F.avg(c).alias(f"{c}|mean"),
                 F.stddev(c).alias(f"{c}|stddev"), F.min(c).cast("double").alias(f"{c}|min"),
                 F.max(c).cast("double").alias(f"{c}|max")]
    wide = df.agg(*aggs)
    long = wide.unpivot([], [a for a in wide.columns], "key", "value")
    return long.select(F.split("key", r"\|")[0].alias("column"), F.split("key", r"\|")[1].alias("stat"),
                       F.round("value", 6).alias("value"))


def pearson_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """All-pairs Pearson correlation as (a, b, r), one aggregate pass."""
    aggs = [F.corr(a, b).alias(f"{a}|{b}") for a in cols for b in cols]
    wide = df.agg(*aggs)
    long = wide.unpivot([], wide.columns, "key", "r")
    return long.select(F.split("key", r"\|")[0].alias("a"), F.split("key", r"\|")[1].alias("b"),
                       F.round("r", 6).alias("r"))


def quantiles_by_target(df: DataFrame, target: str, col: str, at: dict[str, float]) -> DataFrame:
    """Exact quantiles (linear between neighbours) of ``col`` per target.
    Distinct values are counted, ranges of them are summed from the least
    on, and the values on either side of a quantile's place are picked from
    the sums: no task holds a target's values.  Nulls are left out."""
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(target).alias("_t"), F.col(col).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_k"))
    placed = running_sums(counts, ["_t", "_v"], {"_before": "_k"})
    whole = placed.groupBy(F.col("_t").alias("_t0")).agg(F.min("_before").alias("_first"), F.sum("_k").alias("_m"))
    rows = placed.join(whole, F.col("_t").eqNullSafe(F.col("_t0")))
    rank = F.col("_before") - F.col("_first")
    picked = []
    for name, q in at.items():
        place = (F.col("_m") - 1) * F.lit(float(q))
        for side, r in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            picked.append(F.max(F.when((rank <= r) & (r < rank + F.col("_k")), F.col("_v"))).alias(f"_{name}_{side}"))
    found = rows.groupBy("_t").agg(F.max("_m").alias("_m"), *picked)
    between = []
    for name, q in at.items():
        place, lo, hi = (F.col("_m") - 1) * F.lit(float(q)), F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        between.append(F.when(lo == hi, lo).otherwise((F.ceil(place) - place) * lo + (place - F.floor(place)) * hi).alias(name))
    return found.select("_t", *between)


def distribution_by_target(df: DataFrame, target: str, col: str) -> DataFrame:
    """Per target value, count, moments and quartiles of a feature."""
    moments = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(col), 6).alias("mean"),
                                     F.round(F.stddev(col), 6).alias("stddev"), F.min(col).alias("min"), F.max(col).alias("max"))
    quartiles = quantiles_by_target(df, target, col, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return moments.join(quartiles, moments[target].eqNullSafe(quartiles["_t"]), "left").select(target, "n", "mean", "stddev", "min", "p25", "p50", "p75", "max")


def histogram_by_target(df: DataFrame, target: str, col: str, n: int) -> DataFrame:
    """Equal-width histogram per target value, ``n`` buckets from the
    least to the largest value of the feature (the largest in the last)."""
    ends = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    place = F.floor((F.col(col) - F.col("lo")) * n / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)))
    b = F.least(F.coalesce(place, F.lit(0)) + 1, F.lit(n)).cast("long")
    return df.join(F.broadcast(ends)).groupBy(target, b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))     # one row


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features",
             handle_invalid: str = "skip"):
    """M1."""
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol=out,
                           handleInvalid=handle_invalid).transform(df)


def numeric_pipeline(cols: Sequence[str]):
    """M2 + M1 + M3: median imputation, assembly, standard scaling."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
    imp = [f"{c}_imp" for c in cols]
    return Pipeline(stages=[
        Imputer(strategy="median", inputCols=list(cols), outputCols=imp),
        VectorAssembler(inputCols=imp, outputCol="num_raw"),
        StandardScaler(inputCol="num_raw", outputCol="num_features", withMean=True, withStd=True)])


def categorical_pipeline(col: str):
    """M4 + M5: string index (most frequent -> 0) and one-hot."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    return Pipeline(stages=[
        StringIndexer(inputCol=col, outputCol=f"{col}_idx", stringOrderType="frequencyDesc"),
        OneHotEncoder(inputCols=[f"{col}_idx"], outputCols=[f"{col}_vec"])])


def feature_pipeline(num_cols: Sequence[str], cat_col: str):
    """M6: numeric and categorical pipelines nested, then one vector."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    return Pipeline(stages=[numeric_pipeline(num_cols), categorical_pipeline(cat_col),
                            VectorAssembler(inputCols=["num_features", f"{cat_col}_vec"],
                                            outputCol="features")])


def rmse(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """M11 as a column expression (one aggregate)."""
    return pred.agg(F.sqrt(F.avg(F.pow(F.col(prediction) - F.col(label), 2))).alias("rmse"))


def auc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under ROC by the rank formula with ties at half weight.

    Scores are first reduced to (score, positives, negatives), combined
    map-side; the running count of negatives is a distributed prefix sum
    over range partitions (no single-partition window).
    """
    from quarry.operators.ordering import global_cumsum_before
    g = scored.groupBy(score).agg(F.count_if(F.col(label) == 1).alias("pos"),
                                  F.count_if(F.col(label) != 1).alias("neg"))
    g = global_cumsum_before(g, [F.col(score)], "neg", "neg_below")
    return g.agg((F.sum(F.col("pos") * (F.col("neg_below") + 0.5 * F.col("neg")))
                  / (F.sum("pos") * F.sum("neg"))).alias("auc"))
