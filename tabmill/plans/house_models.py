"""HOUSE modelling: learners on the split, k-fold benchmark, predictions, scorers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import linear as ln
from ..operators import metrics as mt
from ..operators import models as md
from ..operators.categorical import level_dictionary
from ..operators import split as sp
from ..operators.recipe import Recipe
from ..session import checkpoint_dir
from . import house


def recipe() -> Recipe:
    return Recipe(target=house.TARGET, key=house.KEY, unseen="zero")


def split_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned rows with an exact 80/20 split (lowest keyed hashes train)."""
    return sp.exact_split(house.cleaned(spark, sf_dir), house.KEY, house.SPLIT_PROP, house.SPLIT_SEED)


def fit_house(spark: SparkSession, sf_dir: str, names: Sequence[str] = md.REGRESSOR_NAMES, **kw):
    """(recipe model, {learner: FittedRegressor}, tagged frame) -- learners fit on the training split."""
    df = split_frame(spark, sf_dir)
    train = df.filter(F.col("set") == "train").drop("set")
    rm = recipe().fit(train)
    return rm, md.fit_regressors(train, rm, house.TARGET, house.KEY, names, rows=rm.rows_hint, **kw), df


def house_predictions(spark: SparkSession, sf_dir: str, names: Sequence[str] = md.REGRESSOR_NAMES,
                      **kw) -> DataFrame:
    """Test-split predictions of every learner: ``learner, id, truth, prediction``."""
    _, fitted, tagged = fit_house(spark, sf_dir, names, **kw)
    return test_predictions(fitted, tagged)


def test_predictions(fitted: dict, tagged: DataFrame) -> DataFrame:
    test = tagged.filter(F.col("set") == "test").drop("set")
    return by_learner(fitted, lambda score: score(test)).select("learner", house.KEY, F.col(house.TARGET).alias("truth"), "prediction")


def by_learner(fitted: dict, run: Callable[[md.Scorer], DataFrame]) -> DataFrame:
    """``run`` applied to the scorers of all learners, stacked under ``learner``."""
    out = None
    for name, score in md.scorers(fitted):
        part = run(score) if name is None else run(score).select(F.lit(name).alias("learner"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def benchmark(spark: SparkSession, sf_dir: str, names: Sequence[str] = md.REGRESSOR_NAMES,
              folds: int = house.FOLDS, seed: int = house.FOLD_SEED, table: DataFrame | None = None, spec: Recipe | None = None, **kw) -> DataFrame:
    """k-fold CV over all rows: MSE and MAPE on the training and test part of every fold,
    averaged over folds.  Returns ``learner, measure, value`` (measure like ``mse_test``).
    ``table`` and ``spec`` replace the cleaned house table and its recipe.

    Fits run per (learner, fold) on the persisted, foldded frame; every scored frame is reduced to its
    two rows of losses, and only those are written.
    """
    checkpoint_dir(spark)
    table = table if table is not None else house.cleaned(spark, sf_dir)
    df = sp.cv_folds(table, house.KEY, folds, seed).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rm = (spec or recipe()).fit(df.drop("fold"))
        fitted = md.fit_fold_grid(df, rm, house.TARGET, house.KEY, folds, names, **kw)
        parts = []
        for (n, k), f in fitted.items():
            scored = f.scorer()(df).select(
                F.lit(n).alias("learner"), F.lit(k).cast("bigint").alias("fold"),
                F.when(F.col("fold") == k, "test").otherwise("train").alias("set"),
                F.col(house.TARGET).alias("label"), "prediction")
            parts.append(mt.regression_losses(scored, ["learner", "fold", "set"]))
        per_fold = parts[0]
        for p in parts[1:]:
            per_fold = per_fold.unionByName(p)
        per_fold = per_fold.checkpoint(eager=True)  # two rows per learner and fold
    finally:
        df.unpersist()
    return fold_means(per_fold)


def fold_means(per_fold: DataFrame) -> DataFrame:
    """``learner, measure, value``: losses averaged over the folds."""
    return per_fold.groupBy("learner", "set").agg(F.avg("mse").alias("mse"), F.avg("mape").alias("mape")).select(
        "learner", F.inline(F.array(
            F.struct(F.concat_ws("_", F.lit("mse"), F.col("set")).alias("measure"), F.col("mse").alias("value")),
            F.struct(F.concat_ws("_", F.lit("mape"), F.col("set")).alias("measure"), F.col("mape").alias("value")),
        )))


# ---------------------------------------------------------------- least squares from fold moments

def design_of(df: DataFrame, numeric: Sequence[str], nominal: Sequence[str]) -> ln.Design:
    levels = level_dictionary(df, nominal)
    return ln.Design(list(numeric), {c: levels.get((c,), []) for c in nominal}, house.TARGET)


def foldded(spark: SparkSession, sf_dir: str, numeric: Sequence[str] | None = None, nominal: Sequence[str] | None = None,
            folds: int = house.FOLDS, seed: int = house.FOLD_SEED) -> tuple[DataFrame, ln.Design]:
    """The cleaned house table with its folds, and the design over all predictors or the given ones."""
    df = sp.cv_folds(house.cleaned(spark, sf_dir), house.KEY, folds, seed)
    roles = recipe().roles(df.drop("fold"))
    return df, design_of(df, roles["numeric"] if numeric is None else numeric, roles["nominal"] if nominal is None else nominal)


def benchmark_moments(spark: SparkSession, sf_dir: str, numeric: Sequence[str] | None = None, nominal: Sequence[str] | None = None,
                      penalty: float = 0.0, **kw) -> DataFrame:
    """The linear learner's rows of :func:`benchmark`: two passes over the rows for all folds together (moments, losses)."""
    df, design = foldded(spark, sf_dir, numeric, nominal, **kw)
    models = ln.fold_models(ln.fold_matrices(ln.fold_gram(df, design), len(design.names)), penalty)
    losses = mt.regression_losses(ln.fold_losses(df, design, models), ["fold", "set"])
    return fold_means(losses.withColumn("learner", F.lit("regr.lm")))


PENALTIES = [0.0, 0.001, 0.01, 0.1, 0.3, 1.0]


def ridge_path(spark: SparkSession, sf_dir: str, numeric: Sequence[str] | None = None, nominal: Sequence[str] | None = None,
               penalties: Sequence[float] = PENALTIES, **kw) -> DataFrame:
    """``penalty, fold, set, mse, chosen``: the path of the linear learner over penalties x folds from one pass; the penalty with the
    least mean test error is marked."""
    df, design = foldded(spark, sf_dir, numeric, nominal, **kw)
    path = ln.penalty_path(ln.fold_matrices(ln.fold_gram(df, design), len(design.names)), penalties)
    best = ln.chosen_penalty(path)
    return spark.createDataFrame([(*r, r[0] == best) for r in path], "penalty double, fold bigint, set string, mse double, chosen boolean")


# ---------------------------------------------------------------- one-feature least squares (exact, oracle-checked)

def _moments(df: DataFrame, x: str, y: str, group: list[str]) -> DataFrame:
    """Centred moments per group: count, means, sum of squares of x and of products around the means."""
    n = F.count(F.lit(1)).cast("double")
    return df.groupBy(*group).agg(n.alias("n"), F.avg(x).alias("mx"), F.avg(y).alias("my"),
                                  (F.var_pop(x) * n).alias("cxx"), (F.covar_pop(x, y) * n).alias("cxy"))


def cv_linear_1d(spark: SparkSession, sf_dir: str, x: str = house.FEATURE, y: str = house.TARGET,
                 folds: int = house.FOLDS, seed: int = house.FOLD_SEED) -> DataFrame:
    """k-fold CV of ``y ~ x`` least squares, from sufficient statistics.

    One aggregate gives centred moments per fold (no cancellation at large n); each fold's training fit
    combines the other folds' (<= k x k rows).  Rows are then tagged with all
    k fold models by an ``explode`` of the fold ids and an equi join on the fold id
    against the k-row model table -- no cross join, no re-scan per fold.
    Returns ``learner, fold, set, mse, mape``.
    """
    d = sp.cv_folds(house.cleaned(spark, sf_dir).select(house.KEY, x, y), house.KEY, folds, seed)
    per = _moments(d, x, y, ["fold"])
    # training part of fold k: the other folds' moments, combined around their common mean (k x k small rows)
    other = per.select(*[F.col(c).alias(f"o_{c}") for c in per.columns]).withColumn(
        "k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(folds - 1).cast("bigint")))).filter("o_fold <> k")
    w = Window.partitionBy("k")
    mean = {c: F.sum(F.col("o_n") * F.col(f"o_m{c}")).over(w) / F.sum("o_n").over(w) for c in "xy"}
    other = other.withColumns({"dx": F.col("o_mx") - mean["x"], "dy": F.col("o_my") - mean["y"], "tx": mean["x"], "ty": mean["y"]})
    fit = other.groupBy("k").agg(F.sum(F.col("o_cxx") + F.col("o_n") * F.col("dx") * F.col("dx")).alias("cxx"),
                                 F.sum(F.col("o_cxy") + F.col("o_n") * F.col("dx") * F.col("dy")).alias("cxy"),
                                 F.first("tx").alias("tx"), F.first("ty").alias("ty"))
    slope = F.col("cxy") / F.col("cxx")
    models = fit.select("k", slope.alias("slope"), (F.col("ty") - slope * F.col("tx")).alias("intercept"))
    tagged = d.withColumn("k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(folds - 1).cast("bigint"))))
    scored = tagged.join(F.broadcast(models), "k").select(
        F.col("k").alias("fold"), F.when(F.col("fold") == F.col("k"), "test").otherwise("train").alias("set"),
        F.col(y).alias("label"), (F.col("intercept") + F.col("slope") * F.col(x)).alias("prediction"))
    losses = mt.regression_losses(scored, ["fold", "set"])
    return losses.select(F.lit("lm_1d").alias("learner"), "fold", "set", "mse", "mape")


def fit_linear_1d(spark: SparkSession, sf_dir: str, x: str = house.FEATURE, y: str = house.TARGET) -> DataFrame:
    """``y ~ x`` on the hash-split training rows with the built-in regression aggregates."""
    df = sp.training(sp.initial_split(house.cleaned(spark, sf_dir), house.KEY, house.SPLIT_PROP, house.SPLIT_SEED))
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                  F.count(F.lit(1)).cast("bigint").alias("n"))


# ---------------------------------------------------------------- explanations of every fitted learner

METHODS = ("importance", "pdp_ice", "ale", "shapley", "lime")


def observed(df: DataFrame) -> DataFrame:
    """The explained observation, written: several passes read it."""
    return sp.materialize(sp.row_at_position(df, house.KEY, house.OBSERVATION))


def explain_fitted(rm, fitted: dict, df: DataFrame, method: str, obs: DataFrame | None = None,
                   grid: Sequence[float] | None = None) -> DataFrame:
    """One explanation method applied to every fitted learner over all rows of ``df``, stacked under ``learner``.

    The explained features are the recipe's predictors; ``pdp_ice`` and ``ale`` explain ``house.FEATURE``; ``obs`` is made by :func:`observed`
    and the ``grid`` of the curves by ``equal_grid`` if not given."""
    from ..operators import explain as ex

    features = rm.roles["numeric"] + rm.roles["nominal"]
    if obs is None and method in ("shapley", "lime"):
        obs = observed(df)
    indexed = None  # made for learners that cannot be stacked, shared by them
    if method == "importance" and any(name is not None for name, _ in md.scorers(fitted)):
        indexed = ex.indexed_rows(df, house.KEY)
    run = {
        "pdp_ice": lambda score: ex.pdp_ice(df, score, house.FEATURE, grid),
        "ale": lambda score: ex.ale(df, score, house.FEATURE),
        "importance": lambda score: ex.permutation_importance(df, score, house.TARGET, features, indexed=indexed),
        "shapley": lambda score: ex.shapley(df, score, features, obs),
        "lime": lambda score: ex.lime(df, score, features, obs),
    }
    if method not in run:
        raise ValueError(f"unknown method {method!r}")
    return by_learner(fitted, run[method])


def _as_text(x: Column, values: Sequence[float]) -> Column:
    """``x`` cast to text; the text of each of ``values`` is a literal, not made again in every row."""
    out = x.cast("string")
    for v in values:
        out = F.when(x == F.lit(v), F.lit(v).cast("string")).otherwise(out)
    return out


def explain_learners(spark: SparkSession, sf_dir: str, method: str, names: Sequence[str] = md.REGRESSOR_NAMES,
                     **kw) -> DataFrame:
    """:func:`explain_fitted` of learners fitted on the split; ``method`` is one of ``METHODS``."""
    rm, fitted, tagged = fit_house(spark, sf_dir, names, **kw)
    return explain_fitted(rm, fitted, tagged.drop("set"), method)


def house_explained(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    """Test predictions and every explanation from ONE fit per learner, in long form:
    ``learner, method, feature, at, id, value``."""
    from ..operators import explain as ex

    rm, fitted, tagged = fit_house(spark, sf_dir, **kw)
    df = tagged.drop("set")
    obs, grid = observed(df), ex.equal_grid(df, house.FEATURE)
    none, text = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    value = {
        "importance": (F.col("feature"), text, none, F.col("importance")),
        "pdp_ice": (F.col("feature"), _as_text(F.col("feature_val"), grid), F.col("id"), F.col("y_hat")),
        "ale": (F.col("feature"), F.col("feature_val").cast("string"), none, F.col("ale")),
        "shapley": (F.col("feature"), F.col("feature_value"), F.col("id"), F.col("phi")),
        "lime": (F.col("feature"), F.col("feature_value"), F.col("id"), F.col("beta")),
    }
    out = test_predictions(fitted, tagged).select(
        "learner", F.lit("prediction").alias("method"), F.lit(house.TARGET).alias("feature"), text.alias("at"),
        F.col(house.KEY).cast("bigint").alias("id"), F.col("prediction").alias("value"))
    for method in METHODS:
        feature, at, ident, v = value[method]
        out = out.unionByName(explain_fitted(rm, fitted, df, method, obs, grid).select(
            "learner", F.lit(method).alias("method"), feature.alias("feature"), at.alias("at"), ident.alias("id"), v.alias("value")))
    return out
