"""Sparse one-hot encoding: same design and predictions as the dense frame, many levels, defined cases."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tabmill.operators import categorical as cat
from tabmill.operators.recipe import dummy_names, one_hot
from tabmill.operators.sparse import SparseEncoder


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i, float(i % 11), "abc"[i % 3], "wxyz"[(i * 7) % 4], float((i * 37) % 19)) for i in range(300)]
    return spark.createDataFrame(rows, "id long, x double, g string, h string, y double")


def test_same_design_and_predictions_as_the_dense_frame(frame):
    coded = SparseEncoder.fit(frame, ["g", "h"], ["x"]).transform(frame)
    levels = {k[0]: v for k, v in cat.level_dictionary(frame, ["g", "h"]).items()}
    names = list(dummy_names(dict(sorted(levels.items()))).values())
    dense = VectorAssembler(inputCols=["x", *names], outputCol="features").transform(one_hot(frame, levels))
    design = lambda d: {r.id: list(r.v) for r in d.select("id", vector_to_array("features").alias("v")).collect()}
    assert design(coded) == design(dense)
    learner = LinearRegression(labelCol="y", regParam=0.1, elasticNetParam=0.0)
    told = [{r.id: r.prediction for r in learner.fit(d).transform(d).collect()} for d in (coded, dense)]
    assert told[0] == pytest.approx(told[1], abs=1e-9)


def test_positions_name_the_ones(frame):
    fitted = SparseEncoder.fit(frame, ["h", "g"], ["x"])
    at = {(r.column, r.level): r.position for r in fitted.positions().collect()}
    assert at == {("h", "w"): 1, ("h", "x"): 2, ("h", "y"): 3, ("h", "z"): 4, ("g", "a"): 5, ("g", "b"): 6, ("g", "c"): 7}
    for r in fitted.transform(frame).collect():
        assert r.features[at[("h", r.h)]] == r.features[at[("g", r.g)]] == 1.0 and r.features[0] == r.x


def test_two_hundred_thousand_levels(spark):
    n = 200_000
    df = spark.range(n + 50_000).select(F.concat(F.lit("v"), (F.col("id") % n).cast("string")).alias("c"), (F.col("id") % 5).cast("double").alias("y"))
    df = df.union(spark.range(100_000).select(F.lit("v7").alias("c"), F.lit(1.0).alias("y")))  # a hot level
    fitted = SparseEncoder.fit(df, ["c"])
    assert fitted.sizes == {"c": n}
    coded = fitted.transform(df)
    assert coded.count() == n + 150_000
    assert coded.first().features.size == n
    model = LinearRegression(labelCol="y", maxIter=1, solver="l-bfgs", standardization=False).fit(coded)
    assert model.coefficients.size == n


def test_defined_cases(spark):
    train = spark.createDataFrame([("a", None, 1.0), ("b", None, 2.0), ("b", None, 2.0)], "g string, e string, x double")
    test = spark.createDataFrame([("a", None, 1.0, 1), ("new", None, 2.0, 2), (None, "q", None, 3), ("b", None, 4.0, 4), ("b", None, 4.0, 4)],
                                 "g string, e string, x double, level int")
    one = SparseEncoder.fit(train, ["g"], ["x"])
    got = sorted((r.level, r.features.toArray().tolist()) for r in one.transform(test.filter("level <> 3"), unseen="zero").collect())
    assert got == [(1, [1, 1, 0]), (2, [2, 0, 0]), (4, [4, 0, 1]), (4, [4, 0, 1])]
    assert sorted(r.level for r in one.transform(test).collect()) == [1, 4, 4]
    null = one.transform(test.filter("level = 3"), unseen="zero").first().features.toArray()
    assert null[0] != null[0] and null[1:].tolist() == [0, 0]
    both = SparseEncoder.fit(train, ["g", "e"], ["x"])
    assert both.transform(test).count() == 0 and both.transform(test, unseen="zero").count() == 5
    none = SparseEncoder.fit(train.limit(0), ["g"], ["x"])
    assert none.transform(train, unseen="zero").first().features.size == 1
    assert one.transform(test.limit(0)).count() == 0
    with pytest.raises(ValueError):
        one.transform(test, unseen="other")
