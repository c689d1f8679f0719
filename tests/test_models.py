"""MLlib-backed queries (no SQL oracle): shape and sanity checks at sf0.001."""

from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from tabmill.operators import models as md

from .conftest import SF_SMALL


def test_entry_schema(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["task", "model", "metric", "estimator", "estimate"]
    rows = df.collect()
    assert len(rows) == 3 * 2 * 2
    assert all(r["metric"] in ("accuracy", "kap") for r in rows)
    assert all(0.0 <= r["estimate"] <= 1.0 for r in rows if r["metric"] == "accuracy")


def test_risk_tree_predictions_cover_test_rows(spark):
    q = entry_mod.queries()
    preds = q["risk_dt"](spark, SF_SMALL)
    baked = q["recipe_bake"](spark, SF_SMALL)
    assert preds.count() == baked.count()
    labels = {r[0] for r in preds.select("estimate").distinct().collect()}
    assert labels <= {"High", "Low", "Medium"}


def test_house_linear_model_predicts_test_split(spark):
    q = entry_mod.queries()
    preds = q["house_lm"](spark, SF_SMALL)
    split = q["house_split_exact"](spark, SF_SMALL)
    assert preds.count() == split.filter(F.col("set") == "test").count()
    # price depends on floor area by construction: the fit must explain most of it
    r = preds.agg(F.corr("truth", "prediction")).first()[0]
    assert r > 0.9


def test_learner_registry():
    reg = md.learner_registry()
    assert reg["classification"] == ["random_forest", "decision_tree", "xgboost", "glmnet"]
    assert reg["regression"] == ["regr.lm", "regr.rpart", "regr.ranger"]
    for name in reg["classification"]:
        assert md.classifier(name) is not None
    for name in reg["regression"]:
        assert md.regressor(name) is not None


def test_models_save_and_reload(spark):
    from tabmill.plans import house_models as hm
    from tabmill.session import scratch_path

    rm, fitted, df = hm.fit_house(spark, SF_SMALL, ["regr.rpart"])
    paths = md.save_models(fitted, scratch_path(spark, "models"))
    again = md.FittedRegressor("regr.rpart", md.load_model(paths[0]), rm)
    test = df.filter(F.col("set") == "test").drop("set")
    a = {r["id"]: r["prediction"] for r in fitted["regr.rpart"].scorer()(test).select("id", "prediction").collect()}
    b = {r["id"]: r["prediction"] for r in again.scorer()(test).select("id", "prediction").collect()}
    assert a == b and len(a) > 0


def test_tasks(spark):
    from tabmill.plans import risk

    got = [r["task"] for r in risk.tasks(risk.load(spark, SF_SMALL)).collect()]
    assert got == ["Risk of Failure to Appear", "Risk of Recidivism", "Risk of Violence"]


def test_every_learner_is_explained(spark):
    from tabmill.plans import house_models as hm

    ale = hm.explain_learners(spark, SF_SMALL, "ale").collect()
    assert {r["learner"] for r in ale} == set(md.REGRESSOR_NAMES)
    shap = hm.explain_learners(spark, SF_SMALL, "shapley", names=["regr.lm"]).collect()
    from tabmill.plans.sql import EXPLAIN_FEATURES

    assert {r["feature"] for r in shap} == set(EXPLAIN_FEATURES)


def test_house_analysis_from_one_fit(spark, monkeypatch):
    from tabmill.plans import house_models as hm

    fits = []
    real = md.fit_regressor
    monkeypatch.setattr(md, "fit_regressor", lambda *a, **k: fits.append(a[3]) or real(*a, **k))
    got = hm.house_explained(spark, SF_SMALL, names=["regr.lm", "regr.rpart"])
    methods = {(r["learner"], r["method"]) for r in got.select("learner", "method").distinct().collect()}
    assert methods >= {(n, m) for n in ("regr.lm", "regr.rpart") for m in ("prediction", "importance", "pdp_ice", "ale", "shapley")}
    assert sorted(fits) == ["regr.lm", "regr.rpart"]
