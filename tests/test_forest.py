"""Lookup tables of trees and forests against the models' own predictions."""

import pytest
from pyspark.sql import functions as F

from tabmill.operators import models as md
from tabmill.operators.forest import ForestTables, parse_trees
from tabmill.operators.recipe import Recipe


@pytest.mark.parametrize("name, kw", [("regr.rpart", {}), ("regr.ranger", {"num_trees": 12})])
def test_same_predictions_as_the_model(spark, name, kw):
    rows = [(i, float((i * 37) % 101), float(i % 13), ("p", "q", "r", None)[(i * 5) % 4], "s" if i % 3 else "t",
             float((i * i) % 97 + 3 * (i % 4) + (i * 37) % 101)) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c string, d string, y double").coalesce(1)
    rm = Recipe(target="y", key="id", unseen="zero").fit(df)
    fit = md.fit_regressor(df, rm, "y", name, **kw)
    tables = fit.tables()
    assert isinstance(tables, ForestTables)
    cuts = sorted({float(x) for t in tables.thresholds for x in t})
    extra = [(1000 + i, x, 5.0, "never seen", None, 0.0) for i, x in enumerate([-1e9, 1e9, *cuts])]  # thresholds themselves, unseen levels
    at = df.unionByName(spark.createDataFrame(extra, df.schema))
    own = fit.model.transform(md.encode(rm, at)).select("id", F.col("_prediction").alias("want"))
    got = fit.scorer()(at.withColumn("prediction", F.lit(0.0)))
    assert set(got.columns) == {*at.columns, "prediction"}
    assert "ArrowEvalPython" in got._jdf.queryExecution().executedPlan().toString()
    pairs = own.join(got, "id").select("want", "prediction").collect()
    assert len(pairs) == 600 + len(extra)
    assert all(r["want"] == r["prediction"] for r in pairs)


def test_null_number_fails_as_before(spark):
    df = spark.createDataFrame([(i, float(i % 7), float(i % 7 > 3)) for i in range(50)], "id long, a double, y double")
    rm = Recipe(target="y", key="id", unseen="zero").fit(df)
    score = md.fit_regressor(df, rm, "y", "regr.rpart").scorer()
    with pytest.raises(Exception):
        score(spark.createDataFrame([(1, None, 0.0)], df.schema)).collect()


def test_trees_that_do_not_fit():
    assert parse_trees("If (feature 0 in {1.0})\n Predict: 1.0\nElse (feature 0 not in {1.0})\n Predict: 2.0") is None
    chain = 0.0
    for k in range(40):
        chain = (0, float(-k), chain, float(k))
    assert ForestTables.of([chain], ["a"], ["a"], {}, {}) is None
    stump = ForestTables.of([5.0], ["a"], ["a"], {}, {})
    assert list(stump.predict([[1.0, 2.0]])) == [5.0, 5.0]
