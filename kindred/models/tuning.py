"""Grid search by cross-validated RMSE."""

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from kindred.models.factors import BiasedFactorization
from kindred.storage import materialize


def factor_grid(estimator, rank=(5, 10), max_iter=(5, 10), reg=(0.05, 0.1)):
    """Parameter maps over factors, iterations and regularization."""
    return (
        ParamGridBuilder()
        .addGrid(estimator.rank, list(rank))
        .addGrid(estimator.maxIter, list(max_iter))
        .addGrid(estimator.regParam, list(reg))
        .build()
    )


def with_folds(ratings, folds):
    """Ratings with `fold`, 0 to folds - 1, by the md5 of both ids as text: the same in every run and layout."""
    text = F.concat_ws(":", F.col("user_id").cast("string"), F.col("item_id").cast("string"))
    digest = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return ratings.withColumn("fold", F.pmod(digest, F.lit(folds)).cast("int"))


def bias_grid(estimator, reg=(1.0, 10.0, 100.0)):
    """Parameter maps over the damping of the biases."""
    return ParamGridBuilder().addGrid(estimator.biasReg, list(reg)).build()


def tune(ratings, estimator=None, grid=None, folds=5, parallelism=1):
    """Cross-validate `grid` on `ratings`, folds by key; returns Spark's `CrossValidatorModel`."""
    estimator = estimator or BiasedFactorization()
    grid = grid or factor_grid(estimator)
    evaluator = RegressionEvaluator(labelCol="stars", predictionCol="prediction", metricName="rmse")
    validator = CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds, foldCol="fold", parallelism=parallelism,
    )
    return validator.fit(materialize(with_folds(ratings.select("user_id", "item_id", "stars"), folds), "folds"))


def tuning_report(spark, tuned):
    """One row per parameter map: its values, mean RMSE over the folds, and whether it won."""
    grid, scores = tuned.getEstimatorParamMaps(), tuned.avgMetrics
    best = min(scores)
    rows = [
        (", ".join(f"{p.name}={v}" for p, v in sorted(params.items(), key=lambda kv: kv[0].name)), float(s), bool(s == best))
        for params, s in zip(grid, scores)
    ]
    return spark.createDataFrame(rows, "params string, rmse double, best boolean")
