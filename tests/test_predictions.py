"""The values that the model queries return, on hours whose consumption follows a feature."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from campuswatt.plans import models as ML

from entry_queries import registry
from entry_queries.core import output


class Hours:
    def __init__(self, spark):
        rng = random.Random(3)
        self.spark = spark
        shown = [rng.uniform(0, 100) for _ in range(400)]
        start = datetime.datetime(2024, 1, 1)
        self.rows = [(start + datetime.timedelta(hours=i), 3 * p + rng.uniform(-5, 5), p) for i, p in enumerate(shown)]

    def actual(self):
        return self.spark.createDataFrame(self.rows, "ts timestamp, actual double, predicted double")


def results(spark, name):
    query, hours = registry()[name], Hours(spark)
    return output(query.build(hours), query.spec).collect(), hours


@pytest.mark.parametrize("name", ["gbt_predictions", "forest_predictions"])
def test_predictions_beat_the_mean_of_the_training_rows(spark, name):
    got, hours = results(spark, name)
    train = [a for _, a, _ in hours.rows[:320]]
    mean = sum(train) / len(train)
    assert len(got) == 80
    error = sum((r.actual - r.prediction) ** 2 for r in got)
    assert error < 0.1 * sum((r.actual - mean) ** 2 for r in got)


def test_importances_name_the_feature_that_counts(spark):
    got, _ = results(spark, "importance_values")
    shares = {r.feature: r.importance for r in got}
    assert abs(sum(shares.values()) - 1) < 0.001 and max(shares, key=shares.get) == "predicted" and shares["predicted"] > 0.5


def test_shared_grid_search_equals_separate_fits(spark, monkeypatch):
    """Each step size and depth is fitted once a fold, and its beginnings score like fits of their own."""
    rows = spark.range(400).select(
        F.col("id"), (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"),
        ((F.col("id") % 17) * 2.0 + (F.col("id") % 5) * (F.col("id") % 3)).alias("y"))
    grid, features = {"maxIter": [1, 3], "stepSize": [0.1, 0.5], "maxDepth": [2]}, ["a", "b"]
    fits, real = [], ML.fit
    monkeypatch.setattr(ML, "fit", lambda *a, **k: fits.append(1) or real(*a, **k))
    scores, best, model = ML.boosting_search(rows, features, "y", grid, folds=2, key=["id"], subsamplingRate=1.0)
    assert len(fits) == 2 * 2 + 1
    got = {(r.maxIter, r.stepSize, r.maxDepth): r.mse for r in scores.collect()}
    folded = ML.cross_folds(rows, 2, ["id"])
    for (n, step, depth), mse in got.items():
        one = []
        for i in range(2):
            m = real(folded.filter(F.col("fold") != i), features, "y", ML.gbt(maxIter=int(n), stepSize=step, maxDepth=int(depth), subsamplingRate=1.0))
            one.append(m.transform(folded.filter(F.col("fold") == i)).agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0])
        assert abs(mse - sum(one) / 2) < 1e-9
    assert best["maxIter"] == 3 and model.stages[-1].getNumTrees == 3 and min(got, key=got.get)[:2] == (3.0, best["stepSize"])
