"""Learners, fit grids and the Scorer protocol.

Learners are MLlib estimators (distributed fits).  A *Scorer* is any
``Callable[[DataFrame], DataFrame]`` that appends a ``prediction`` column and keeps
every input column; explanation operators take Scorers, so they work the same for
an MLlib model and for a fixed formula.

Grid fits run on the driver as a loop over (task, model) -- a bounded number of
Spark jobs -- over a training frame that is persisted once and released in
``finally``.  Several fits are submitted concurrently from a small thread pool
so that small fits do not leave executors idle; frames of many partitions are fitted one
after another, as each fit keeps its own copy of the rows.

Learners that draw no rows (``COUNTED``) depend on them only through how often each
combination of features and class occurs: they are fitted on the distinct combinations, weighted by their counts.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    OneVsRest,
    OneVsRestModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    DecisionTreeRegressor,
    LinearRegression,
    LinearRegressionModel,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .forest import ForestTables, parse_trees
from .recipe import RecipeModel
from .stacked import MOST_CELLS, LinearTables, Stacked

Scorer = Callable[[DataFrame], DataFrame]

# Model names of the classification grid and of the regression learners.
CLASSIFIER_NAMES = ["random_forest", "decision_tree", "xgboost", "glmnet"]
REGRESSOR_NAMES = ["regr.lm", "regr.rpart", "regr.ranger"]


# Fitted on distinct rows with their counts (the other learners read the rows: equally frequent classes fell differently on counts).
COUNTED = ["decision_tree"]
COUNT = "_count"


def counted_rows(df: DataFrame, by: Iterable[str], n: str | None = None) -> DataFrame:
    """Distinct values of ``by`` with the number of their rows (the sum of ``n``, if given) in ``COUNT``: partial aggregation, all rows."""
    return df.groupBy(*dict.fromkeys(by)).agg((F.count(F.lit(1)) if n is None else F.sum(n)).cast("bigint").alias(COUNT))


def classifier(name: str, seed: int = 7, num_trees: int = 100, boost_rounds: int = 15, reg: float = 0.001, bagging: bool = True,
               depth: int | None = None):
    """Estimator for a classification model name (features -> label).  Without ``bagging`` a forest's trees see all rows and features;
    ``depth`` bounds the trees (MLlib's default if None)."""
    grown = {} if depth is None else {"maxDepth": depth}
    if name == "random_forest":
        return RandomForestClassifier(numTrees=num_trees, seed=seed, **grown, **_bagging(bagging))
    if name == "decision_tree":
        return DecisionTreeClassifier(seed=seed, **grown)
    if name == "xgboost":
        # MLlib's GBT is binary only: one-vs-rest over boosted trees for several classes.
        return OneVsRest(classifier=GBTClassifier(maxIter=boost_rounds, seed=seed, **grown), parallelism=4)
    if name == "glmnet":
        return LogisticRegression(family="multinomial", elasticNetParam=1.0, regParam=reg, maxIter=100)
    raise KeyError(f"unknown classifier {name!r}; known: {CLASSIFIER_NAMES}")


def _bagging(on: bool) -> dict:
    return {} if on else {"bootstrap": False, "featureSubsetStrategy": "all"}


def regressor(name: str, seed: int = 7, num_trees: int = 100, bagging: bool = True):
    if name == "regr.lm":
        return LinearRegression()
    if name == "regr.rpart":
        return DecisionTreeRegressor(seed=seed)
    if name == "regr.ranger":
        return RandomForestRegressor(numTrees=num_trees, seed=seed, **_bagging(bagging))
    raise KeyError(f"unknown regressor {name!r}; known: {REGRESSOR_NAMES}")


def learner_registry() -> dict[str, list[str]]:
    return {"classification": list(CLASSIFIER_NAMES), "regression": list(REGRESSOR_NAMES)}


def feature_columns(rm: RecipeModel) -> list[str]:
    return rm.roles["numeric"] + rm.dummy_columns()


def encode(rm: RecipeModel, df: DataFrame) -> DataFrame:
    """Append the recipe's dummy columns to ``df`` keeping every column (unseen -> all zero).

    Used at scoring time, where rows must never be dropped.
    """
    exprs = {name: F.when(rm._known(c), (F.col(c) == lv).cast("int")).otherwise(F.lit(0))
             for (c, lv), name in rm.dummy_map().items()}
    return df.withColumns(exprs) if exprs else df


ROWS_PER_PARTITION = 500_000


def stable_layout(df: DataFrame, key: str | Sequence[str], rows_per_partition: int = ROWS_PER_PARTITION,
                  rows: int | None = None) -> DataFrame:
    """Persisted training layout: hash-partitioned on the key, sorted within partitions.

    Iterative learners run one job per iteration over this frame, so the partition
    count follows the data size (``rows_per_partition``) instead of the shuffle
    default: tiny partitions only add per-iteration scheduling cost, while large
    inputs still spread over many partitions.  ``rows`` (e.g. the recipe's level
    counts) sizes the layout without an extra pass; otherwise the rows are counted.
    The fixed layout also makes tree bagging reproducible.  Caller unpersists.
    """
    staged = None
    if rows is None:
        staged = df.persist(StorageLevel.MEMORY_AND_DISK)
        rows = staged.count()
    try:
        n = max(1, -(-rows // rows_per_partition))
        keys = [key] if isinstance(key, str) else list(key)
        laid = df.repartition(n, *keys).sortWithinPartitions(*keys).persist(StorageLevel.MEMORY_AND_DISK)
        laid.count()
    finally:
        if staged is not None:
            staged.unpersist()
    return laid


@dataclass
class FittedClassifier:
    task: str | None
    name: str
    model: PipelineModel
    labels: list[str]

    def predict(self, prepared: DataFrame, keep: Sequence[str]) -> DataFrame:
        return self._scored(prepared).select(*keep, "estimate")

    def predict_probs(self, prepared: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep``, estimate and ``probs``: a map from class to probability that sums to 1."""
        return self._scored(prepared).select(*keep, "estimate", F.map_from_arrays(F.array(*map(F.lit, self.labels)), "_shares").alias("probs"))

    def _scored(self, prepared: DataFrame) -> DataFrame:
        """Rows with ``estimate`` and the class probabilities in label order (``_shares``)."""
        indexer, assembler, est, _ = self.model.stages
        if not isinstance(est, OneVsRestModel):
            return self.model.transform(prepared).withColumn("_shares", vector_to_array("_prob")).withColumnRenamed("_estimate", "estimate")
        # each class against the rest has a margin F with odds exp(2 F) (the boosting loss): shares of the class probabilities.
        # The class models are applied one by one; the one-vs-rest model itself would pass every row through a Python function.
        out = assembler.transform(prepared)
        for i, m in enumerate(est.models):
            out = m.copy({m.rawPredictionCol: f"_raw{i}", m.probabilityCol: f"_prob{i}", m.predictionCol: f"_pred{i}"}).transform(out)
        margins = F.array(*[vector_to_array(f"_raw{i}")[1] for i in range(len(est.models))])
        out = out.withColumn("_margins", margins).withColumn("_odds", F.transform("_margins", lambda m: 1.0 / (1.0 + F.exp(-2.0 * m))))
        best = F.element_at(F.array(*map(F.lit, self.labels)), F.array_position("_margins", F.array_max("_margins")).cast("int"))
        whole = F.aggregate("_odds", F.lit(0.0), lambda s, x: s + x)
        return out.withColumn("estimate", best).withColumn("_shares", F.transform("_odds", lambda p: p / whole))

    @property
    def features(self) -> list[str]:
        return list(self.model.stages[1].getInputCols())

    @property
    def description(self) -> str:
        """Learner and the parameters that were set: the same in every run."""
        return f"{type(self.model.stages[-2]).__name__}({', '.join(f'{k}={v}' for k, v in self.params.items())})"

    @property
    def params(self) -> dict[str, str]:
        """Parameters of the learner that differ from its defaults, column names aside."""
        est = self.model.stages[-2]
        if isinstance(est, OneVsRestModel):
            est = est.models[0]
        return {p.name: str(v) for p, v in sorted(est.extractParamMap().items(), key=lambda x: x[0].name)
                if est.isSet(p) and not p.name.endswith("Col")}

    def scorer(self, rm: RecipeModel) -> Scorer:
        """Classifier over raw rows: encode by the recipe, append ``estimate``; keeps all input columns."""
        def score(df: DataFrame) -> DataFrame:
            keep = [c for c in df.columns if c != "estimate"]
            return self._scored(encode(rm, df.select(*keep))).select(*keep, "estimate")

        return score


def classification_pipeline(features: list[str], target: str, name: str, seed: int = 7, counts: str | None = None, **kw):
    indexer = StringIndexer(inputCol=target, outputCol="label", stringOrderType="alphabetAsc",
                            handleInvalid="error")
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")
    est = classifier(name, seed=seed, **kw).setFeaturesCol("features").setLabelCol("label") \
        .setPredictionCol("_pred_index")
    if not isinstance(est, OneVsRest):
        est = est.setProbabilityCol("_prob")
    if counts is not None:
        est = est.setWeightCol(counts)
    return indexer, assembler, est


def weighted_spread(train: DataFrame, counts: str) -> float:
    """How much larger MLlib's standard deviation of distinct rows weighted by ``counts`` is than that of the rows themselves: its
    variance divides by ``n - sum(w^2) / n`` instead of ``n - 1``, the same for every feature."""
    w = F.col(counts).cast("double")
    n, squares = train.agg(F.sum(w), F.sum(w * w)).first()
    left = n - squares / n if n else 0.0
    return math.sqrt((n - 1.0) / left) if n and n > 1.0 and left > 0.0 else 1.0


def fit_classifier(train: DataFrame, features: list[str], target: str, name: str, task: str | None = None,
                   seed: int = 7, counts: str | None = None, **kw) -> FittedClassifier:
    """``counts`` names the column with the number of rows that each row of ``train`` stands for (learners of ``COUNTED`` only)."""
    if counts is not None and name not in COUNTED:
        raise ValueError(f"{name} draws rows: it cannot be fitted on counts")
    indexer, assembler, est = classification_pipeline(features, target, name, seed, counts, **kw)
    penalty = None
    if counts is not None and name == "glmnet" and est.getRegParam():
        penalty = est.getRegParam()  # acts on coefficients in units of the spread: kept the same as on the rows
        est = est.setRegParam(penalty / weighted_spread(train, counts))
    idx_model = indexer.fit(train)
    labels = list(idx_model.labels)
    back = IndexToString(inputCol="_pred_index", outputCol="_estimate", labels=labels)
    pipe = Pipeline(stages=[idx_model, assembler, est, back]).fit(train)
    if penalty is not None:
        fitted = pipe.stages[2]
        fitted.set(fitted.getParam("regParam"), penalty)
    return FittedClassifier(task, name, pipe, labels)


def grid_threads(spark, jobs: int, threads: int | None = None, partitions: int = 1) -> int:
    """Concurrent fits: by default as many as the cluster runs tasks at once (each small
    fit occupies one partition's worth of cores), fewer over frames of many ``partitions``, never more than there are fits."""
    cores = spark.sparkContext.defaultParallelism
    want = threads or min(max(4, cores), -(-2 * cores // max(1, partitions)))
    return max(1, min(want, jobs))


def fit_frames(prepared: DataFrame, feats: Sequence[str], models: Iterable[str], task_col: str, target: str, key: str,
               rows: int | None = None, also: Sequence[str] = ()) -> dict[bool, DataFrame]:
    """The persisted frames that fits read: the rows laid out by key (``False``, for learners that draw rows) and their distinct combinations
    with counts (``True``).  Only those that ``models`` need; ``also`` are further columns.  Caller unpersists."""
    out, cols = {}, list(dict.fromkeys([*also, task_col, target, *feats]))
    if any(m not in COUNTED for m in models):
        out[False] = stable_layout(prepared, key, rows=rows)
    if any(m in COUNTED for m in models):
        try:
            out[True] = stable_layout(counted_rows(prepared, cols), cols)
        except BaseException:
            for frame in out.values():
                frame.unpersist()
            raise
    return out


def fit_grid(prepared: DataFrame, rm: RecipeModel, tasks: Iterable[str], models: Iterable[str],
             task_col: str, target: str, key: str, threads: int | None = None, seed: int = 7,
             features: Sequence[str] | None = None, **kw) -> dict[tuple[str, str], FittedClassifier]:
    """Fit every model on every task's prepared training rows, on all predictors unless ``features`` names some.

    ``prepared`` holds all tasks (one pass of preparation); the frames of :func:`fit_frames` are
    persisted for the duration of the grid, then released.
    """
    feats = list(features) if features is not None else feature_columns(rm)
    models = list(models)
    frames = fit_frames(prepared, feats, models, task_col, target, key, rm.rows_hint)
    try:
        jobs = [(t, m) for t in tasks for m in models]

        def run(tm):
            t, m = tm
            counted = m in COUNTED
            return tm, fit_classifier(frames[counted].filter(F.col(task_col) == t), feats, target, m, t, seed,
                                      COUNT if counted else None, **kw)

        return run_fits(frames, jobs, lambda tm: tm[1] in COUNTED, run, threads)
    finally:
        for frame in frames.values():
            frame.unpersist()


def run_fits(frames: dict[bool, DataFrame], jobs: Sequence, counted: Callable, run: Callable, threads: int | None = None) -> dict:
    """``{job: run(job)}`` in the order of ``jobs``; the fits of each frame share a pool that suits its partitions."""
    found = {}
    for kind, frame in frames.items():
        own = [j for j in jobs if counted(j) == kind]
        with ThreadPoolExecutor(max_workers=grid_threads(frame.sparkSession, len(own), threads, frame.rdd.getNumPartitions())) as pool:
            found.update(pool.map(run, own))
    return {j: found[j] for j in jobs}


def predict_grid(fitted: dict[tuple[str, str], FittedClassifier], test: DataFrame, task_col: str, target: str,
                 key: str | None, set_name: str = "test", probs: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Stack every (task, model) prediction: ``task, model, set, key, truth, estimate``, the class probabilities
    (``probs``) if wanted, and the columns of ``keep``.  Without a ``key`` that column is left out."""
    parts = []
    for (t, m), fc in fitted.items():
        rows = test.filter(F.col(task_col) == t)
        own = [key] if key is not None else []
        pred = (fc.predict_probs if probs else fc.predict)(rows, [*own, target, *keep]).select(
            F.lit(t).alias("task"), F.lit(m).alias("model"), F.lit(set_name).alias("set"), *own,
            F.col(target).alias("truth"), F.col("estimate"), *(["probs"] if probs else []), *keep)
        parts.append(pred)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- regression


@dataclass
class FittedRegressor:
    name: str
    model: PipelineModel
    recipe_model: RecipeModel

    def tables(self) -> ForestTables | None:
        """Lookup tables of a tree or forest (None: another learner, or trees that don't fit them)."""
        rm, est = self.recipe_model, self.model.stages[-1]
        if rm.recipe.group or not isinstance(est, (DecisionTreeRegressionModel, RandomForestRegressionModel)):
            return None
        trees, feats = parse_trees(est.toDebugString), feature_columns(rm)
        if trees is None or not feats:
            return None
        return ForestTables.of(trees, feats, rm.roles["numeric"], self._levels(), rm.dummy_map())

    def _levels(self) -> dict[str, list[str]]:
        rm = self.recipe_model
        return {c: lv for c in rm.roles["nominal"] if (lv := rm.union_levels(c))}

    def parts(self) -> ForestTables | LinearTables | None:
        """The model as a sum of one part per column (None: it is none)."""
        rm, est = self.recipe_model, self.model.stages[-1]
        if isinstance(est, LinearRegressionModel) and not rm.recipe.group and (feats := feature_columns(rm)):
            return LinearTables.of(est.coefficients.toArray(), est.intercept, feats, rm.roles["numeric"], self._levels(), rm.dummy_map())
        tables = self.tables()
        return tables if tables is not None and math.prod(tables.sizes) < MOST_CELLS else None

    def scorer(self) -> Scorer:
        """Scorer over raw (cleaned) rows: encode, assemble, predict; keeps all input columns.  Trees score by their lookup tables."""
        feats = feature_columns(self.recipe_model)
        tables = self.tables()
        if tables is not None:
            def look_up(df: DataFrame) -> DataFrame:
                return tables.score(df.drop("prediction"))

            look_up.features = feats  # type: ignore[attr-defined]
            return look_up

        def score(df: DataFrame) -> DataFrame:
            cols = df.columns
            enc = encode(self.recipe_model, df.drop("prediction") if "prediction" in cols else df)
            out = self.model.transform(enc)
            keep = [c for c in cols if c != "prediction"]
            return out.select(*keep, F.col("_prediction").alias("prediction"))

        score.features = feats  # type: ignore[attr-defined]
        return score


def scorers(fitted: dict[str, FittedRegressor]) -> list[tuple[str | None, Scorer]]:
    """Scorers that cover every learner of one recipe: one for all that can be stacked (``None``: it names the learner itself), the others by name."""
    parts = {n: f.parts() for n, f in fitted.items()}
    together = {n: p for n, p in parts.items() if p is not None}
    return ([(None, Stacked(together))] if together else []) + [(n, fitted[n].scorer()) for n, p in parts.items() if p is None]


def fit_regressor(train: DataFrame, rm: RecipeModel, target: str, name: str, seed: int = 7,
                  **kw) -> FittedRegressor:
    est = regressor(name, seed=seed, **kw).setFeaturesCol(FEATURES).setLabelCol(target) \
        .setPredictionCol("_prediction")
    assembler = _assembler(rm)
    model = est.fit(train if FEATURES in train.columns else assembler.transform(encode(rm, train)))
    return FittedRegressor(name, PipelineModel([assembler, model]), rm)


FEATURES = "_features"


def _assembler(rm: RecipeModel) -> VectorAssembler:
    return VectorAssembler(inputCols=feature_columns(rm), outputCol=FEATURES, handleInvalid="error")


def assembled(train: DataFrame, rm: RecipeModel, keep: Sequence[str]) -> DataFrame:
    """``keep`` and the feature vector: learners that read the rows many times find them encoded."""
    return _assembler(rm).transform(encode(rm, train)).select(*keep, FEATURES)


def fit_regressors(train: DataFrame, rm: RecipeModel, target: str, key: str, names: Iterable[str] = REGRESSOR_NAMES,
                   threads: int | None = None, seed: int = 7, rows: int | None = None, **kw) -> dict[str, FittedRegressor]:
    base = stable_layout(assembled(train, rm, [key, target]), key, rows=rows)
    try:
        names = list(names)
        with ThreadPoolExecutor(max_workers=grid_threads(base.sparkSession, len(names), threads, base.rdd.getNumPartitions())) as pool:
            return dict(pool.map(lambda n: (n, fit_regressor(base, rm, target, n, seed, **kw)), names))
    finally:
        base.unpersist()


def fit_fold_grid(foldded: DataFrame, rm: RecipeModel, target: str, key: str, folds: int,
                  names: Iterable[str] = REGRESSOR_NAMES, fold_col: str = "fold", threads: int | None = None,
                  seed: int = 7, **kw) -> dict[tuple[str, int], FittedRegressor]:
    """Every learner on every fold's training part (fold != k), all fits from one pool.

    The foldded frame is laid out and persisted once; each fit filters it.
    """
    base = stable_layout(foldded, key)
    try:
        jobs = [(n, k) for k in range(folds) for n in names]

        def run(job):
            n, k = job
            return job, fit_regressor(base.filter(F.col(fold_col) != k).drop(fold_col), rm, target, n, seed, **kw)

        with ThreadPoolExecutor(max_workers=grid_threads(base.sparkSession, len(jobs), threads, base.rdd.getNumPartitions())) as pool:
            return dict(pool.map(run, jobs))
    finally:
        base.unpersist()


# ---------------------------------------------------------------- persistence


def save_models(models: dict, path: str) -> list[str]:
    """Write every fitted pipeline under ``path/<name...>`` (MLlib's own format); returns the paths."""
    out = []
    for key, fitted in models.items():
        parts = key if isinstance(key, tuple) else (key,)
        target = "/".join([path.rstrip("/"), *[str(p).replace(" ", "_").replace("/", "_") for p in parts]])
        fitted.model.write().overwrite().save(target)
        out.append(target)
    return out


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_classifier(row) -> FittedClassifier:
    """The fitted classifier behind a row of the registry (:func:`registry_rows`)."""
    return FittedClassifier(row["task"], row["model"], load_model(row["path"]), list(row["labels"]))


def registry_rows(spark, fitted: dict[tuple[str, str], FittedClassifier], path: str) -> DataFrame:
    """Saves every fit below ``path``; ``task, model, fit, params, labels, n_features, path``: all that scoring from a row needs."""
    paths = save_models(fitted, path)
    rows = [(t, m, f.description, f.params, f.labels, len(f.features), p) for ((t, m), f), p in zip(fitted.items(), paths)]
    return spark.createDataFrame(rows, "task string, model string, fit string, params map<string, string>, labels array<string>, "
                                       "n_features int, path string")
