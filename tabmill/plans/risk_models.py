"""RISK modelling: per-task model grid, test predictions, metrics and the result table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import explain as ex
from ..operators import metrics as mt
from ..operators import models as md
from ..operators import probability as pb
from ..operators import tuning as tn
from ..session import checkpoint_dir, scratch_path
from . import risk


def fit_risk_grid(spark: SparkSession, sf_dir: str, models: Sequence[str] = md.CLASSIFIER_NAMES,
                  test_scope: str = "own", **kw):
    """(recipe model, fitted {(task, model): FittedClassifier}, baked test rows)."""
    rm, juiced, baked = risk.prepared(spark, sf_dir, test_scope=test_scope)
    tasks = [g for g in rm.groups if g is not None]
    fitted = md.fit_grid(juiced, rm, tasks, models, risk.TASK_COL, risk.TARGET, risk.KEY, **kw)
    return rm, fitted, baked


def checkpointed_predictions(fitted, baked: DataFrame, **kw) -> DataFrame:
    """Score every (task, model) on the persisted test rows and checkpoint the stacked
    predictions (shared checkpoint folder): metrics then read them once, lineage is cut."""
    checkpoint_dir(baked.sparkSession)
    test = baked.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return md.predict_grid(fitted, test, risk.TASK_COL, risk.TARGET, risk.KEY, **kw).checkpoint(eager=True)
    finally:
        test.unpersist()


def grid_confusion(fitted, baked: DataFrame) -> DataFrame:
    """Confusion counts of every (task, model) on the test rows.  Rows alike in class and features have the same prediction: each such
    combination is scored once and counted as often as it occurs; only the counts (tasks x models x classes^2 rows) are written."""
    checkpoint_dir(baked.sparkSession)
    feats = [c for f in fitted.values() for c in f.features]
    test = md.counted_rows(baked, [risk.TASK_COL, risk.TARGET, *feats]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        preds = md.predict_grid(fitted, test, risk.TASK_COL, risk.TARGET, None, keep=[md.COUNT])
        return mt.confusion_matrix(preds, counts=md.COUNT).checkpoint(eager=True)
    finally:
        test.unpersist()


def risk_predictions(spark: SparkSession, sf_dir: str, models: Sequence[str] = md.CLASSIFIER_NAMES,
                     test_scope: str = "own", **kw) -> DataFrame:
    _, fitted, baked = fit_risk_grid(spark, sf_dir, models, test_scope, **kw)
    return checkpointed_predictions(fitted, baked)


def run_risk(spark: SparkSession, sf_dir: str, models: Sequence[str] = md.CLASSIFIER_NAMES,
             test_scope: str = "own", **kw) -> DataFrame:
    """The whole RISK pipeline; returns ``task, model, metric, estimator, estimate``."""
    _, fitted, baked = fit_risk_grid(spark, sf_dir, models, test_scope, **kw)
    return mt.metrics_from_confusion(grid_confusion(fitted, baked))


def risk_probabilities(spark: SparkSession, sf_dir: str, models: Sequence[str] = md.CLASSIFIER_NAMES, keep: Sequence[str] = (),
                       **kw) -> DataFrame:
    """Test predictions of every (task, model) with the probability of each class, written once."""
    _, fitted, baked = fit_risk_grid(spark, sf_dir, models, **kw)
    return checkpointed_predictions(fitted, baked, probs=True, keep=keep)


def run_risk_probabilities(spark: SparkSession, sf_dir: str, models: Sequence[str] = md.CLASSIFIER_NAMES, **kw) -> DataFrame:
    """Log loss and Hand-Till AUC of every (task, model): ``task, model, metric, estimator, estimate``."""
    return pb.probability_metrics(risk_probabilities(spark, sf_dir, models, **kw))


def risk_results(spark: SparkSession, sf_dir: str, models: Sequence[str] = md.CLASSIFIER_NAMES, **kw) -> DataFrame:
    """One row per (task, model): fitted-model descriptor and nested metrics."""
    _, fitted, baked = fit_risk_grid(spark, sf_dir, models, **kw)
    nested = mt.nest_metrics(mt.metrics_from_confusion(grid_confusion(fitted, baked)))
    fits = spark.createDataFrame([(t, m, f.description) for (t, m), f in fitted.items()],
                                 "task string, model string, fit string")
    return fits.join(nested, ["task", "model"], "left")


def fit_grid_summary(spark: SparkSession, sf_dir: str, models: Sequence[str] = md.CLASSIFIER_NAMES,
                     **kw) -> DataFrame:
    """The fitted grid as a table: task, model, fit descriptor, class labels, training rows."""
    rm, juiced, _ = risk.prepared(spark, sf_dir)
    tasks = [g for g in rm.groups if g is not None]
    fitted = md.fit_grid(juiced, rm, tasks, models, risk.TASK_COL, risk.TARGET, risk.KEY, **kw)
    rows = juiced.groupBy(F.col(risk.TASK_COL).alias("task")).agg(F.count(F.lit(1)).cast("bigint").alias("n_train"))
    fits = spark.createDataFrame(
        [(t, m, f.description, f.labels, len(md.feature_columns(rm))) for (t, m), f in fitted.items()],
        "task string, model string, fit string, labels array<string>, n_features int")
    return fits.join(rows, "task", "left")


# ---------------------------------------------------------------- registry of fits

def risk_registry(spark: SparkSession, sf_dir: str, models: Sequence[str] = md.CLASSIFIER_NAMES, path: str | None = None,
                  **kw) -> tuple[DataFrame, DataFrame]:
    """(registry, baked test rows).  A registry row per (task, model): the saved fit's path, its parameters and labels, numbers of training and test rows
    and its metrics on the test rows.  :func:`score_registry` predicts from the rows alone."""
    rm, juiced, baked = risk.prepared(spark, sf_dir)
    fitted = md.fit_grid(juiced, rm, [g for g in rm.groups if g is not None], models, risk.TASK_COL, risk.TARGET, risk.KEY, **kw)
    fits = md.registry_rows(spark, fitted, path or scratch_path(spark, "fits"))
    counts = [f.groupBy(F.col(risk.TASK_COL).alias("task")).agg(F.count(F.lit(1)).cast("bigint").alias(n)) for f, n in ((juiced, "n_train"), (baked, "n_test"))]
    nested = mt.nest_metrics(mt.metrics_from_confusion(grid_confusion(fitted, baked)))
    return fits.join(counts[0], "task", "left").join(counts[1], "task", "left").join(nested, ["task", "model"], "left"), baked


def score_registry(registry: DataFrame, baked: DataFrame) -> DataFrame:
    """Predictions of every fit of a registry (one row per task and model), loaded from its path."""
    rows = registry.select("task", "model", "path", "labels").collect()
    return md.predict_grid({(r["task"], r["model"]): md.load_classifier(r) for r in rows}, baked, risk.TASK_COL, risk.TARGET, risk.KEY)


# ---------------------------------------------------------------- importance per task

def rule_classifier(df: DataFrame) -> DataFrame:
    return df.withColumn("estimate", risk.rule_estimate())


PREDICTORS = ["sex_code_text", "ethnic_code_text", "date_of_birth", "custody_status", "marital_status"]


def importance_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filtered test rows with the raw predictors."""
    return risk.filter_levels(risk.split_frame(spark, sf_dir)).where("set = 'test'").select(
        risk.KEY, F.col(risk.TASK_COL).alias("task"), risk.TARGET, *PREDICTORS)


def risk_importance(spark: SparkSession, sf_dir: str, models: Sequence[str] = ("decision_tree", "glmnet"), **kw) -> DataFrame:
    """Importance of every predictor for every task and fitted model: ``model, task, feature, importance...``."""
    rm, fitted, _ = fit_risk_grid(spark, sf_dir, models, **kw)
    rows = importance_rows(spark, sf_dir)
    out = None
    for m in models:
        def classify(df, m=m):
            done = None
            for t in sorted(t for t, name in fitted if name == m):
                own = df.where(F.col("task") == t).withColumn(risk.TASK_COL, F.lit(t))
                scored = fitted[t, m].scorer(rm)(own).drop(risk.TASK_COL)
                done = scored if done is None else done.unionByName(scored)
            return done

        part = ex.grouped_importance(rows, classify, risk.TARGET, PREDICTORS, "task", risk.KEY).withColumn("model", F.lit(m))
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------- tuning

#: Settings of the tuning grid: depths of the tree, penalties of the logistic regression.
SETTINGS = [("decision_tree", {"depth": 2}), ("decision_tree", {"depth": 5}), ("glmnet", {"reg": 0.1}), ("glmnet", {"reg": 0.001})]


def risk_tuning(spark: SparkSession, sf_dir: str, settings=SETTINGS, features: Sequence[str] | None = None, **kw) -> DataFrame:
    """Mean train and test measure of every setting per task over the folds of the training rows, the best one marked."""
    rm, juiced, _ = risk.prepared(spark, sf_dir)
    tasks = [g for g in rm.groups if g is not None]
    return tn.tune(juiced, features or md.feature_columns(rm), settings, tasks, risk.TASK_COL, risk.TARGET, risk.KEY, rows=rm.rows_hint, **kw)


def run_risk_tuned(spark: SparkSession, sf_dir: str, settings=SETTINGS, features: Sequence[str] | None = None, **kw) -> DataFrame:
    """The RISK pipeline with each task's chosen settings: test metrics of every (task, model)."""
    rm, juiced, baked = risk.prepared(spark, sf_dir)
    feats = features or md.feature_columns(rm)
    tasks = [g for g in rm.groups if g is not None]
    confusion = tn.tuning_confusion(juiced, feats, settings, tasks, risk.TASK_COL, risk.TARGET, risk.KEY, rows=rm.rows_hint, **kw)
    fitted = tn.refit_chosen(juiced, feats, settings, tn.choose(confusion), risk.TASK_COL, risk.TARGET, risk.KEY, rows=rm.rows_hint)
    return mt.metrics_from_confusion(grid_confusion(fitted, baked))
