"""Learners stacked in one pass against each learner's own scorer, row by row."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabmill.operators import explain as ex
from tabmill.operators import forest
from tabmill.operators import models as md
from tabmill.operators.recipe import Recipe
from tabmill.operators.stacked import Stacked
from tabmill.plans import house_models as hm

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def made(spark):
    rows = [(i, float((i * 37) % 101), float(i % 13), "pqr"[i % 3], "s" if i % 3 else "t",
             float((i * i) % 97 + 3 * (i % 4) + (i * 37) % 101)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c string, d string, y double").coalesce(1)
    rm = Recipe(target="y", key="id", unseen="zero").fit(df)
    fitted = {n: md.fit_regressor(df, rm, "y", n, **({"num_trees": 5} if n == "regr.ranger" else {})) for n in md.REGRESSOR_NAMES}
    odd = [(1000, 50.0, 5.0, "never seen", None, 3.0), (1001, -1e9, 1e9, None, "s", None), (1002, 50.0, 5.0, "p", "s", 1.0), (1002, 50.0, 5.0, "p", "s", 1.0)]
    return df.unionByName(spark.createDataFrame(odd, df.schema)), rm, fitted


def stacked(fitted):
    (name, score), = md.scorers(fitted)
    assert name is None and isinstance(score, Stacked)
    return score


def table(df, keys):
    rows = sorted((tuple(str(r[k]) for k in keys), tuple(v for k, v in sorted(r.asDict().items()) if k not in keys)) for r in df.collect())
    return rows


def same(got, want, keys):
    assert sorted(got.columns) == sorted(want.columns)
    got, want = table(got, keys), table(want, keys)
    assert [k for k, _ in got] == [k for k, _ in want]
    for (k, a), (_, b) in zip(got, want):
        for x, y in zip(a, b):
            assert (x == pytest.approx(y, rel=1e-9, abs=1e-7)) if isinstance(x, float) and y is not None else x == y, (k, a, b)


def each(fitted, run):
    parts = [run(f.scorer()).select(F.lit(n).alias("learner"), "*") for n, f in fitted.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@pytest.mark.parametrize("keys, run", [
    (["learner", "id"], lambda df, s, obs: s(df).select(*[c for c in ("learner",) if isinstance(s, Stacked)], "id", "prediction")),
    (["learner", "type", "feature_val", "id"], lambda df, s, obs: ex.pdp_ice(df, s, "a")),
    (["learner", "feature_val"], lambda df, s, obs: ex.pdp(df, s, "b", grid_size=5)),
    (["learner", "feature_val"], lambda df, s, obs: ex.ale(df, s, "a", grid_size=7)),
    (["learner", "feature"], lambda df, s, obs: ex.permutation_importance(df, s, "y", FEATURES)),
    (["learner", "id", "feature"], lambda df, s, obs: ex.shapley(df, s, FEATURES, obs, m=10)),
    (["learner", "id", "i", "j"], lambda df, s, obs: ex.lime_gram(df, s, FEATURES, obs)),
    (["learner", "id", "feature"], lambda df, s, obs: ex.lime(df, s, FEATURES, obs)),
])
def test_same_as_one_by_one(made, keys, run):
    df, _, fitted = made
    obs = df.where("id in (7, 122)")
    want = each(fitted, lambda s: run(df, s, obs))
    same(run(df, stacked(fitted), obs), want, keys)


def test_each_method_reads_the_rows_once_for_all_learners(made, monkeypatch):
    df, rm, fitted = made
    written = []
    real = ex.materialize
    monkeypatch.setattr(ex, "materialize", lambda x: written.append(x.columns) or real(x))
    monkeypatch.setattr(hm.house, "FEATURE", "a")
    monkeypatch.setattr(hm.house, "TARGET", "y")
    plan = lambda x: x._jdf.queryExecution().optimizedPlan().toString()
    assert plan(hm.explain_fitted(rm, fitted, df, "importance")).count("Join Inner") == 1
    assert plan(hm.explain_fitted(rm, fitted, df, "pdp_ice")).count("MapInArrow") == 2  # curves, their means
    assert plan(hm.explain_fitted(rm, fitted, df, "ale")).count("MapInArrow") == 1
    assert plan(hm.explain_fitted(rm, fitted, df, "lime")).count("MapInPandas") == 1
    assert written == [["_v", "_n", "_p"]]  # counted values of the feature, once; no curves


def test_trees_that_do_not_fit_are_explained_beside_the_others(made, monkeypatch):
    df, rm, fitted = made
    monkeypatch.setattr(hm.house, "FEATURE", "a")
    want = hm.explain_fitted(rm, fitted, df, "ale")
    tables = md.FittedRegressor.tables
    monkeypatch.setattr(md.FittedRegressor, "tables", lambda f: None if f.name == "regr.ranger" else tables(f))
    assert [n for n, _ in md.scorers(fitted)] == [None, "regr.ranger"]
    same(hm.explain_fitted(rm, fitted, df, "ale"), want, ["learner", "feature_val"])


def test_null_number_fails(made):
    df, _, fitted = made
    bad = df.withColumn("b", F.when(F.col("id") != 3, F.col("b")))
    with pytest.raises(Exception):
        ex.pdp_ice(bad, stacked(fitted), "a").collect()


def test_cells_of_any_number(made, monkeypatch):
    _, _, fitted = made
    t = fitted["regr.ranger"].tables()
    rng = np.random.default_rng(1)
    rows = [rng.uniform(-5, 110, 500), rng.uniform(-1, 14, 500), rng.integers(0, 4, 500), rng.integers(0, 3, 500)]
    cells = sum(t.part(i, x) for i, x in enumerate(rows))
    direct = t._of_cases([t.case(i, x) for i, x in enumerate(rows)])
    monkeypatch.setattr(forest, "_KEPT", {"another": np.zeros(forest.CELLS)})
    assert (t.predict(rows) == direct).all() and (t.finish(cells) == direct).all()
    assert list(forest._KEPT) == [t.digest]  # made room
    monkeypatch.setattr(forest, "CELLS", 1)
    assert (t.predict(rows) == direct).all() and (t.finish(cells.reshape(50, 10)) == direct.reshape(50, 10)).all()


def test_many_categories_share_few_integers():
    levels = [str(i) for i in range(1000)]
    s = Stacked({"t": forest.ForestTables(["x"], {f"c{i}": levels for i in range(13)}, [], [], np.zeros(32))})
    groups = s._groups()
    assert [c for g in groups for c in g] == list(s.nominal) and len(groups) == 3
    assert all(1001 ** len(g) <= 1 << 62 for g in groups)


def test_rows_are_made_once_for_cleaning(spark, monkeypatch):
    from tabmill.operators import clean

    seen = []
    real = clean.colops.kept_column_names
    monkeypatch.setattr(clean.colops, "kept_column_names", lambda x, *a: seen.append(x._jdf.queryExecution().optimizedPlan().toString()) or real(x, *a))
    a = spark.createDataFrame([(i, float(i % 7), None if i % 2 else 1.0) for i in range(40)], "Id long, x double, gap double")
    b = spark.createDataFrame([(i, "uv"[i % 2]) for i in range(40)], "Id long, k string")
    out = clean.combine(a.join(b, "Id"))
    assert sorted(out.columns) == ["id", "k", "x"] and out.count() == 40
    assert "Join" not in seen[0]
