"""Fits on distinct rows with their counts give the fits on the rows; the bagged learner keeps its rows."""

import pytest

from tabmill.operators import models as md
from tabmill.operators import tuning as tn

FEATURES = ["x", "z"]


def frame(spark):
    rows = []
    for i in range(400):
        x, z = i % 3 == 0, (i * 7) % 5 < 2
        y = ("a", "b", "c")[(i * i + 2 * x + z) % 3 if i % 4 else 2 * x]
        rows.append((i, "t", y, int(x), int(z)))
    return spark.createDataFrame(rows, "id long, task string, y string, x int, z int").coalesce(1)


@pytest.mark.parametrize("name, params", [("decision_tree", {})])
def test_counts_give_the_fit_of_the_rows(spark, name, params):
    df = frame(spark)
    counted = md.counted_rows(df, ["task", "y", *FEATURES])
    assert counted.count() <= 12
    whole = md.fit_classifier(df, FEATURES, "y", name, **params)
    few = md.fit_classifier(counted, FEATURES, "y", name, counts=md.COUNT, **params)
    assert (few.labels, few.description) == (whole.labels, whole.description)
    at = spark.createDataFrame([(x, z) for x in (0, 1) for z in (0, 1)], "x int, z int")
    a, b = ({(r["x"], r["z"]): (r["estimate"], r["probs"]) for r in f.predict_probs(at, FEATURES).collect()} for f in (whole, few))
    for k in a:
        assert a[k][0] == b[k][0]
        assert all(abs(a[k][1][c] - b[k][1][c]) < 2e-4 for c in whole.labels), (k, a[k], b[k])


def test_bagged_learner_refuses_counts(spark):
    with pytest.raises(ValueError):
        md.fit_classifier(md.counted_rows(frame(spark), ["y", *FEATURES]), FEATURES, "y", "random_forest", counts=md.COUNT)


def test_frames_hold_combinations_not_rows(spark):
    df = frame(spark)
    frames = md.fit_frames(df, FEATURES, ["decision_tree"], "task", "y", "id")
    assert list(frames) == [True] and frames[True].count() <= 12
    assert frames[True].agg({md.COUNT: "sum"}).first()[0] == 400
    frames[True].unpersist()


def test_tuning_counts_every_row(spark):
    df = frame(spark).unionByName(frame(spark).limit(50))  # repeated keys
    settings = [("decision_tree", {"depth": 1}), ("random_forest", {"num_trees": 2})]
    out = tn.tuning_confusion(df, FEATURES, settings, ["t"], "task", "y", "id", folds=2)
    sums = {(r["setting"], r["fold"]): r["n"] for r in out.groupBy("setting", "fold").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n").collect()}
    assert set(sums.values()) == {450} and len(sums) == 4


def test_large_frames_are_fitted_one_by_one(spark):
    cores = spark.sparkContext.defaultParallelism
    assert md.grid_threads(spark, 12, partitions=1) == min(12, max(4, cores))
    assert md.grid_threads(spark, 12, partitions=2 * cores) == 1
    assert md.grid_threads(spark, 12, threads=3, partitions=2 * cores) == 3


def test_level_counts_are_made_once(spark, monkeypatch):
    from tabmill.operators import effects as ef

    df = spark.createDataFrame([(i, "abc"[i % 3], "de"[i % 2], float(i)) for i in range(30)], "id long, c string, d string, x double")
    written, real = [], ef.materialize

    def keep(frame):
        written.append(frame.columns)
        return real(frame)

    monkeypatch.setattr(ef, "materialize", keep)
    assert ef.level_distances(df).count() == 4
    assert written == [["feature", "level", "other", "bin", "n"]] * 2
