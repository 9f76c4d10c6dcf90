"""Regression models on MLlib pipelines."""

import json
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from campuswatt.operators import modelling as MO
from campuswatt.session import cut_lineage

SEED = 42    # fixed value

# Settings and search grids of the models.
GBT = {"maxIter": 200, "stepSize": 0.05, "maxDepth": 7, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}
FOREST = {"numTrees": 200, "maxDepth": 15, "minInstancesPerNode": 2, "featureSubsetStrategy": "sqrt"}
FOREST_GRID = {"numTrees": [50, 100, 200], "maxDepth": [30, 10, 20], "minInstancesPerNode": [1, 2, 5]}
GBT_GRID = {"maxIter": [50, 100, 200], "stepSize": [0.01, 0.1, 0.2], "maxDepth": [3, 5, 7]}
SEARCH_FOLDS = 5


def gbt(**changes):
    return GBTRegressor(seed=SEED, **{**GBT, **changes})


def random_forest(**changes):
    return RandomForestRegressor(seed=SEED, **{**FOREST, **changes})


def linreg(**changes):
    return LinearRegression(solver="normal", **changes)


KINDS = {"xgboost": gbt, "lightgbm": gbt, "gbm": gbt, "randomforest": random_forest,
         "random_forest": random_forest, "linear": linreg}


def model_of(kind, **changes):
    """Estimator by name; an unknown name means boosting."""
    return KINDS.get(kind.lower(), gbt)(**changes)


def stages(df, features, label, estimator, scale=False):
    """Text features as alphabetical codes, then one vector, then the model."""
    text = [c for c in features if df.schema[c].dataType.typeName() == "string"]
    indexers = [StringIndexer(inputCol=c, outputCol=f"{c}_code", stringOrderType="alphabetAsc", handleInvalid="keep")
                for c in text]
    inputs = [f"{c}_code" if c in text else c for c in features]
    vector = VectorAssembler(inputCols=inputs, outputCol="raw" if scale else "features", handleInvalid="keep")
    scaler = [StandardScaler(inputCol="raw", outputCol="features", withMean=True)] if scale else []
    return [*indexers, vector, *scaler, estimator.setFeaturesCol("features").setLabelCol(label)]


def fit(df, features, label, estimator, scale=False):
    return Pipeline(stages=stages(df, features, label, estimator, scale)).fit(df.filter(F.col(label).isNotNull()))


def grid_search(df, features, label, estimator, grid, folds=SEARCH_FOLDS, scale=False, parallelism=4):
    """Cross-validated search by mean squared error."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder.addGrid(estimator.getParam(name), values)
    search = CrossValidator(
        estimator=Pipeline(stages=stages(df, features, label, estimator, scale)), estimatorParamMaps=builder.build(),
        evaluator=RegressionEvaluator(labelCol=label, metricName="mse"), numFolds=folds, seed=SEED, parallelism=parallelism)
    return search.fit(df.filter(F.col(label).isNotNull()))


def cross_folds(df, k, key, seed=SEED, into="fold"):
    """Random folds by a hash of the row key: the same on any layout."""
    return df.withColumn(into, (MO.draw(key, seed) % k).cast("int"))


def boosting_search(df, features, label, grid, folds=SEARCH_FOLDS, key=None, scale=False, **settings):
    """Cross-validated scores of boosting, one row a setting with ``mse``, and the best model on all rows.

    The first trees of a longer run are the trees of a shorter one, so each step size and depth is trained once
    per fold with the most rounds, and its beginnings are scored for the others: a fit for every pair instead of
    every setting. Returns (scores, best settings, model).
    """
    rows = cut_lineage(cross_folds(df.filter(F.col(label).isNotNull()), folds, key or features))
    rounds = sorted(grid["maxIter"])
    others = [dict(zip([n for n in grid if n != "maxIter"], values)) for values in product(*[grid[n] for n in grid if n != "maxIter"])]
    scores = {}
    for setting in others:
        for i in range(folds):
            train, rest = rows.filter(F.col("fold") != i), rows.filter(F.col("fold") == i)
            model = fit(train, features, label, gbt(**{**settings, **setting, "maxIter": rounds[-1]}), scale)
            seen = PipelineModel(model.stages[:-1]).transform(rest)
            errors = model.stages[-1].evaluateEachIteration(seen, "squared")      # of the first tree, the first two, ...
            for n in rounds:
                scores.setdefault((n, *setting.values()), []).append(errors[n - 1])
    names = ["maxIter", *others[0]]
    table = [(*map(float, k), float(sum(v) / len(v))) for k, v in scores.items()]
    best = dict(zip(names, min(scores, key=lambda k: (sum(scores[k]), k))))
    out = df.sparkSession.createDataFrame(table, ", ".join(f"{n} double" for n in [*names, "mse"]))
    return out, best, fit(df, features, label, gbt(**{**settings, **best}), scale)


def grid_scores(spark, search, names, metric):
    """Score of each parameter set of a search."""
    rows = []
    for params, score in zip(search.getEstimatorParamMaps(), search.avgMetrics):
        by_name = {p.name: value for p, value in params.items()}
        rows.append((*[float(by_name[n]) for n in names], float(score)))
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in [*names.values(), metric]))


def fold_scores(df, features, label, estimator, k, order, scale=False):
    """Metrics of contiguous folds, each predicted by a model fitted on the other folds (``k`` fits)."""
    placed = MO.folds(df.filter(F.col(label).isNotNull()), k, order)
    out = None
    for i in range(k):
        model = fit(placed.filter(F.col("fold") != i), features, label, estimator, scale)
        one = MO.metrics(model.transform(placed.filter(F.col("fold") == i)), label, "prediction", by=["fold"])
        out = one if out is None else out.unionByName(one)
    return out


def importances(spark, model, features):
    """(feature, importance), most important first."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(f, float(w)) for f, w in zip(features, weights)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")


def save_model(spark, model, path, features, metrics, **info):
    """Model folder and a one-row description beside it."""
    model.write().overwrite().save(f"{path}/model")
    text = json.dumps({"features": features, "metrics": metrics, **info})
    spark.createDataFrame([(text,)], "value string").write.mode("overwrite").text(f"{path}/info")


def load_model(spark, path):
    return PipelineModel.load(f"{path}/model"), json.loads(spark.read.text(f"{path}/info").first()[0])
