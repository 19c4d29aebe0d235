"""ML lab jobs on the housing-shaped and default tables (M1-M14, A9-A14,
A22, P7, P8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import mlops as M
from quarry.operators import relational as R
from quarry.operators.relational import hash_split
from quarry.plans.registry import query
from quarry.plans.relations import HOUSING_NUMERIC, credit_default, housing

KEY = ["order_id", "line_no"]
DESCRIBED = ["housing_median_age", "total_rooms", "total_bedrooms", "median_house_value"]
FEATURES = ["n_chars", "n_words", "n_lines", "chars_per_word"]
CORR = ["total_rooms", "population", "median_income", "median_house_value"]


@query("derive_ratios")
def q_ratios(t):
    """P7."""
    d = M.derive_ratios(housing(t))
    return d.select(*KEY, *[F.round(c, 6).alias(c) for c in
                            ("rooms_per_household", "bedrooms_per_room", "population_per_household")])


@query("rename_label")
def q_rename(t):
    """P8."""
    return housing(t).withColumnRenamed("median_house_value", "label").select(*KEY, "label")


@query("describe_columns")
def q_describe(t):
    """A9 (long form)."""
    return M.describe_columns(housing(t), DESCRIBED)


@query("global_max_min_avg")
def q_global(t):
    """A10."""
    h = housing(t)
    return R.global_stats(h, {"max_age": F.max("housing_median_age"),
                              "min_rooms": F.min("total_rooms"),
                              "avg_value": F.round(F.avg("median_house_value"), 6)})


@query("group_avg")
def q_group_avg(t):
    """A11 (DataFrame)."""
    g = R.group_avg(housing(t), "ocean_proximity", "median_house_value")
    return g.withColumn("avg_value", F.round("avg_value", 6))


@query("group_avg_sql")
def q_group_avg_sql(t):
    """A11 (SQL text on a temp view)."""
    g = R.group_avg_sql(housing(t), "ocean_proximity", "median_house_value")
    return g.withColumn("avg_value", F.round("avg_value", 6))


@query("group_count_desc")
def q_group_count(t):
    """A12."""
    return R.group_count_desc(housing(t), "ocean_proximity")


@query("null_counts")
def q_null_counts(t):
    """A13."""
    return R.null_counts(housing(t), HOUSING_NUMERIC)


@query("pearson_matrix")
def q_pearson(t):
    """A14."""
    return M.pearson_matrix(housing(t), CORR)


@query("distribution_by_target")
def q_distribution(t):
    """Moments and quartiles of every feature per target value."""
    d = credit_default(t)
    parts = [M.distribution_by_target(d, "label", c).withColumn("feature", F.lit(c)) for c in FEATURES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("histogram_by_target")
def q_histogram(t):
    """n_chars histogram per target value, 20 buckets over its range."""
    return M.histogram_by_target(credit_default(t), "label", "n_chars", 20)


@query("assemble_features")
def q_assemble(t):
    """M1 (rows-only): numeric columns to one vector, rows with nulls skipped."""
    from pyspark.ml.functions import vector_to_array
    a = M.assemble(housing(t), HOUSING_NUMERIC)
    return a.select(*KEY, F.array_join(vector_to_array("features"), ",").alias("features"))


@query("impute_median")
def q_impute(t):
    """M2 (rows-only): median-imputed bedrooms."""
    from pyspark.ml.feature import Imputer
    h = housing(t)
    m = Imputer(strategy="median", inputCols=["total_bedrooms"],
                outputCols=["total_bedrooms_imp"]).fit(h)
    return m.transform(h).select(*KEY, "total_bedrooms_imp")


@query("standard_scale")
def q_standard_scale(t):
    """M3: (x - mean) / sample std of median_income."""
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.functions import vector_to_array
    a = M.assemble(housing(t), ["median_income"], "v")
    s = StandardScaler(inputCol="v", outputCol="z", withMean=True, withStd=True).fit(a).transform(a)
    return s.select(*KEY, F.round(vector_to_array("z")[0], 4).alias("scaled"))


@query("index_labels")
def q_index(t):
    """M4: most frequent category -> 0, ties alphabetical."""
    from pyspark.ml.feature import StringIndexer
    h = housing(t).select("ocean_proximity").distinct()
    model = StringIndexer(inputCol="ocean_proximity", outputCol="idx").fit(housing(t))
    return model.transform(h).select("ocean_proximity", F.col("idx").cast("int").alias("idx"))


@query("one_hot")
def q_one_hot(t):
    """M5 (rows-only)."""
    from pyspark.ml.functions import vector_to_array
    p = M.categorical_pipeline("ocean_proximity").fit(housing(t))
    o = p.transform(housing(t))
    return o.select(*KEY, F.array_join(vector_to_array("ocean_proximity_vec"), ",").alias("onehot"))


@query("feature_pipeline")
def q_feature_pipeline(t):
    """M6 (rows-only): nested numeric + categorical pipelines."""
    from pyspark.ml.functions import vector_to_array
    h = housing(t)
    m = M.feature_pipeline(HOUSING_NUMERIC, "ocean_proximity").fit(h)
    return m.transform(h).select(*KEY, F.size(vector_to_array("features")).alias("n_features"))


def _lr(t):
    from pyspark.ml.regression import LinearRegression
    h = M.assemble(housing(t), ["total_rooms"])
    model = LinearRegression(featuresCol="features", labelCol="median_house_value",
                             solver="normal").fit(h)
    return h, model


@query("linear_regression")
def q_linear_regression(t):
    """M7: one-feature OLS coefficients (checked against regr_slope)."""
    h, model = _lr(t)
    return h.limit(1).select(
        F.round(F.lit(float(model.coefficients[0])), 4).alias("coefficient"),
        F.round(F.lit(float(model.intercept)), 4).alias("intercept"))


@query("rmse")
def q_rmse(t):
    """Training RMSE of the one-feature model, as an aggregate."""
    h, model = _lr(t)
    p = model.transform(h)
    return M.rmse(p, "median_house_value").select(F.round("rmse", 4).alias("rmse"))


def _regression(t, est):
    from pyspark.ml import Pipeline
    h = housing(t)
    train, test = hash_split(h.withColumn("rid", F.col("order_id") * 16 + F.col("line_no")), "rid")
    pipe = Pipeline(stages=[M.feature_pipeline(HOUSING_NUMERIC, "ocean_proximity"), est])
    model = pipe.fit(M.evened(train))
    return M.rmse(model.transform(test), "median_house_value")


@query("decision_tree_regression")
def q_dt(t):
    """M8 (rows-only): test RMSE."""
    from pyspark.ml.regression import DecisionTreeRegressor
    return _regression(t, DecisionTreeRegressor(labelCol="median_house_value", seed=1))


@query("random_forest_regression")
def q_rf(t):
    """M9 (rows-only): test RMSE."""
    from pyspark.ml.regression import RandomForestRegressor
    return _regression(t, RandomForestRegressor(labelCol="median_house_value", numTrees=10, seed=1))


@query("gbt_regression")
def q_gbt(t):
    """M10 (rows-only): test RMSE."""
    from pyspark.ml.regression import GBTRegressor
    return _regression(t, GBTRegressor(labelCol="median_house_value", maxIter=10, seed=1))


@query("grid_cross_validate")
def q_grid_cv(t):
    """M12 (rows-only): trees {1,5,10} x depth {5,10,15}, 3 folds, best by
    RMSE, refit on all training rows, test RMSE reported."""
    from pyspark.ml import Pipeline
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import RandomForestRegressor
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    h = housing(t)
    train, test = hash_split(h.withColumn("rid", F.col("order_id") * 16 + F.col("line_no")), "rid")
    train = M.evened(train)
    fe = M.feature_pipeline(HOUSING_NUMERIC, "ocean_proximity").fit(train)
    rf = RandomForestRegressor(labelCol="median_house_value", seed=1)
    grid = (ParamGridBuilder().addGrid(rf.numTrees, [1, 5, 10])
            .addGrid(rf.maxDepth, [5, 10, 15]).build())
    ev = RegressionEvaluator(labelCol="median_house_value", metricName="rmse")
    cv = CrossValidator(estimator=rf, estimatorParamMaps=grid, evaluator=ev, numFolds=3,
                        seed=1, parallelism=4)
    model = cv.fit(fe.transform(train))
    best = model.bestModel
    out = M.rmse(model.transform(fe.transform(test)), "median_house_value")
    return out.select("rmse", F.lit(best.getNumTrees).alias("num_trees"),
                      F.lit(best.getOrDefault("maxDepth")).alias("max_depth"))


@query("classify_compare")
def q_classify(t):
    """M13 (rows-only): logistic regression, decision tree, random forest;
    area under ROC on a hash-split test set."""
    from pyspark.ml.classification import (DecisionTreeClassifier, LogisticRegression,
                                           RandomForestClassifier)
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    d = M.assemble(credit_default(t), ["n_chars", "n_words", "n_lines", "chars_per_word"])
    train, test = hash_split(d, "doc_id")
    ev = BinaryClassificationEvaluator(metricName="areaUnderROC")
    rows = []
    for name, est in [("logistic_regression", LogisticRegression()),
                      ("decision_tree", DecisionTreeClassifier(seed=1)),
                      ("random_forest", RandomForestClassifier(seed=1))]:
        m = est.fit(train)
        p = m.transform(test)
        rows.append(p.agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("n_test"))
                    .withColumn("auc", F.lit(float(ev.evaluate(p)))))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


@query("auc")
def q_auc(t):
    """AUC of n_chars as a quality score (rank formula, ties half)."""
    d = credit_default(t).select("label", F.col("n_chars").alias("score"))
    return M.auc(d).select(F.round("auc", 6).alias("auc"))
