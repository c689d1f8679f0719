"""Tuning of classifiers: parameter settings x folds x tasks over one laid-out frame.

Every fit is a distributed MLlib fit on the rows outside one fold (on their distinct combinations and counts where the learner draws no
rows); it scores all rows of its task, each combination of fold, class and features once, and only the confusion
counts of both sides (at most 2 x classes^2 rows) leave the job.  Folds come from the keyed hash, so they are the same in every run.

Defined cases: a fold without rows of a task, or one that holds all of them, is left out for that task; a task without usable folds has no
rows in the result; equal measures are won by the earlier setting; the key may repeat (such rows share their fold); other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import metrics as mt
from . import models as md
from . import split as sp

CONFUSION = "task string, model string, setting int, fold bigint, set string, truth string, estimate string, n bigint"


def setting_name(params: Mapping[str, object]) -> str:
    return ", ".join(f"{k}={v}" for k, v in sorted(params.items()))


def tuning_confusion(prepared: DataFrame, features: Sequence[str], settings: Sequence[tuple[str, Mapping[str, object]]], tasks: Iterable[str],
                     task_col: str, target: str, key: str, folds: int = 4, fold_seed: int | str = 4, threads: int | None = None,
                     rows: int | None = None, seed: int = 7) -> DataFrame:
    """Confusion counts per task, setting (index into ``settings``, pairs of a model name and its parameters), fold and side (``train``: the
    fit's own rows; ``test``: the fold left out)."""
    spark = prepared.sparkSession
    frame = sp.cv_folds(prepared.select(*dict.fromkeys([key, task_col, target, *features])), key, folds, fold_seed, "_fold")
    names = [name for name, _ in settings]
    # the counted frame is always made: it is what the fits are scored on
    frames = md.fit_frames(frame, features, [*names, md.COUNTED[0]], task_col, target, key, rows, ["_fold"])
    counted = frames[True]
    try:
        sizes = {(r["task"], r["fold"]): r["n"] for r in counted.groupBy(F.col(task_col).alias("task"), F.col("_fold").alias("fold"))
                 .agg(F.sum(md.COUNT).alias("n")).collect()}  # tasks x folds rows
        tasks = list(tasks)
        usable = {t: [k for k in range(folds) if 0 < sizes.get((t, k), 0) < sum(sizes.get((t, j), 0) for j in range(folds))] for t in tasks}
        jobs = [(t, i, k) for t in tasks for i in range(len(settings)) for k in usable[t]]

        def run(job):
            t, i, k = job
            name, params = settings[i]
            own = frames[name in md.COUNTED].where(F.col(task_col) == t)
            fit = md.fit_classifier(own.where(F.col("_fold") != k), list(features), target, name, t, seed,
                                    md.COUNT if name in md.COUNTED else None, **params)
            side = F.when(F.col("_fold") == k, "test").otherwise("train")
            # classes that the fit has not seen stay as truth, they only count as misses
            pred = fit.predict(counted.where(F.col(task_col) == t), ["_fold", target, md.COUNT]).select(
                side.alias("set"), F.col(target).alias("truth"), "estimate", md.COUNT)
            counts = mt.confusion_matrix(pred, ["set"], counts=md.COUNT).collect()
            return job, [(t, name, i, k, r["set"], r["truth"], r["estimate"], r["n"]) for r in counts]

        done = md.run_fits(frames, jobs, lambda job: names[job[1]] in md.COUNTED, run, threads)
        found = [row for part in done.values() for row in part]
    finally:
        for f in frames.values():
            f.unpersist()
    return spark.createDataFrame(found, CONFUSION)


def choose(confusion: DataFrame, metric: str = "accuracy", digits: int = 12) -> DataFrame:
    """``task, model, setting, n_folds, train, test, chosen``: the mean measure over the folds on both sides; each model's best mean test
    measure is ``chosen`` for its task.  Measures that are undefined in a fold (kappa of a single class) are left out of the mean."""
    by = ["task", "model", "setting", "fold", "set"]
    long = mt.metrics_from_confusion(confusion, by).where(F.col("metric") == metric)
    means = long.groupBy("task", "model", "setting").agg(
        F.countDistinct("fold").alias("n_folds"),
        *[F.round(F.avg(F.when(F.col("set") == s, F.col("estimate"))), digits).alias(s) for s in ("train", "test")])
    order = Window.partitionBy("task", "model").orderBy(F.desc_nulls_last("test"), "setting")  # as many rows as settings
    return means.withColumn("chosen", F.row_number().over(order) == 1)


def tune(prepared: DataFrame, features: Sequence[str], settings: Sequence[tuple[str, Mapping[str, object]]], tasks: Iterable[str],
         task_col: str, target: str, key: str, metric: str = "accuracy", **kw) -> DataFrame:
    """:func:`choose` over :func:`tuning_confusion`, with the settings spelled out in ``params``."""
    table = choose(tuning_confusion(prepared, features, settings, tasks, task_col, target, key, **kw), metric)
    names = F.array(*[F.lit(setting_name(p)) for _, p in settings])
    return table.withColumn("params", F.get(names, F.col("setting")))


def refit_chosen(prepared: DataFrame, features: Sequence[str], settings: Sequence[tuple[str, Mapping[str, object]]], chosen: DataFrame,
                 task_col: str, target: str, key: str, rows: int | None = None, seed: int = 7) -> dict[tuple[str, str], md.FittedClassifier]:
    """Each task's chosen setting of each model fitted on all rows of the task: {(task, model): fit}, as a grid of fits."""
    wanted = [(r["task"], r["model"], r["setting"]) for r in chosen.where("chosen").select("task", "model", "setting").collect()]
    frames = md.fit_frames(prepared, features, [m for _, m, _ in wanted], task_col, target, key, rows)
    try:
        def run(job):
            t, m, i = job
            counted = m in md.COUNTED
            return job, md.fit_classifier(frames[counted].where(F.col(task_col) == t), list(features), target, m, t, seed,
                                          md.COUNT if counted else None, **settings[i][1])

        return {job[:2]: fit for job, fit in md.run_fits(frames, wanted, lambda job: job[1] in md.COUNTED, run).items()}
    finally:
        for f in frames.values():
            f.unpersist()
