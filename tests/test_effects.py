"""Effects over levels, class probabilities, moments: edge cases on literal frames and brute force."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabmill.operators import effects as ef
from tabmill.operators import linear as ln
from tabmill.operators import probability as pb
from tabmill.plans import house_models as hm

from .conftest import SF_SMALL


def _score(df):
    return df.withColumn("prediction", F.col("x") * 2 + F.when(F.col("c") == "a", 10).when(F.col("c") == "b", 4).otherwise(0)
                         + F.coalesce(F.length("d"), F.lit(0)))


ROWS = [(1, 1.0, "a", "u"), (2, 2.0, "a", "u"), (3, 3.0, "b", "vv"), (4, 4.0, "b", "u"), (5, 9.0, "z", "vv"), (6, None, "z", None), (7, 2.5, None, "vv")]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(ROWS, "id long, x double, c string, d string")


def _brute_distance(rows, f, a, b):
    """Sum over the other columns: sup distance of distribution functions, or total variation."""
    cols = {"x": 1, "c": 2, "d": 3}
    out = 0.0
    for o, k in cols.items():
        if o == f:
            continue
        one, two = ([r[k] for r in rows if r[cols[f]] == v and r[k] is not None] for v in (a, b))
        if not one or not two:
            out += 1
        elif o == "x":
            out += max(abs(sum(v <= t for v in one) / len(one) - sum(v <= t for v in two) / len(two)) for t in one + two)
        else:
            out += sum(abs(one.count(v) / len(one) - two.count(v) / len(two)) for v in {*one, *two}) / 2
    return out


def test_level_distances_equal_brute_force(spark, frame):
    got = {(r.feature, r.level_a, r.level_b): r.distance for r in ef.level_distances(frame).collect()}
    assert set(got) == {("c", "a", "b"), ("c", "a", "z"), ("c", "b", "z"), ("d", "u", "vv")}
    for (f, a, b), d in got.items():
        assert d == pytest.approx(_brute_distance(ROWS, f, a, b))


def test_places_follow_a_line_and_ties_are_stable():
    at = np.array([3.0, 0.0, 1.0, 7.0])
    place = ef.scaled_places(np.abs(at[:, None] - at))
    assert place[0] < 0 and np.allclose(np.abs(place[:, None] - place), np.abs(at[:, None] - at))
    assert not ef.scaled_places(np.zeros((3, 3))).any() and len(ef.scaled_places(np.zeros((0, 0)))) == 0


def test_effects_of_levels_accumulate_and_centre(spark, frame):
    got = {(r.feature, r.level): r for r in ef.ale_levels(frame, _score, orders={"c": ["z", "b", "a"], "d": ["u", "vv"]}).collect()}
    assert [got["c", v].position for v in "zba"] == [1, 2, 3]
    steps = [got["c", "b"].ale - got["c", "z"].ale, got["c", "a"].ale - got["c", "b"].ale]
    # rows whose prediction is NULL (a missing number) add nothing to a sum of changes but count as rows
    assert steps == pytest.approx([3 * 4 / 4, 4 * 6 / 4])
    n = {"z": 2, "b": 2, "a": 2}
    assert sum(got["c", v].ale * k for v, k in n.items()) == pytest.approx(0)
    assert got["d", "vv"].ale - got["d", "u"].ale == pytest.approx(1)


def test_effects_without_categories_or_rows(spark, frame):
    assert ef.ale_levels(frame.select("id", "x"), lambda d: d.withColumn("prediction", F.col("x"))).collect() == []
    assert ef.ale_levels(frame.limit(0), _score).collect() == []
    assert ef.level_distances(frame.limit(0)).collect() == []
    one = frame.where("c = 'a'")
    rows = ef.ale_levels(one, _score).collect()
    assert {(r.feature, r.level, r.position, r.ale) for r in rows} == {("c", "a", 1, 0.0), ("d", "u", 1, 0.0)}


def test_curves_cover_every_feature(spark, frame):
    df = frame.dropna()
    curves = ef.pdp_ice_all(df, _score, grid_size=3)
    counts = {(r.feature, r.type): r["count"] for r in curves.groupBy("feature", "type").count().collect()}
    assert counts == {("x", "ice"): 15, ("c", "ice"): 15, ("d", "ice"): 10, ("x", "pdp"): 3, ("c", "pdp"): 3, ("d", "pdp"): 2}
    mean = {r.feature_level: r.y_hat for r in curves.where("type = 'pdp' and feature = 'c'").collect()}
    assert mean["a"] - mean["b"] == pytest.approx(6)


# ---------------------------------------------------------------- class probabilities

def _auc(rows, a, b):
    pairs = [(p[a], q[a]) for t, p in rows if t == a for u, q in rows if u == b]
    return sum(1.0 if x > y else 0.5 if x == y else 0.0 for x, y in pairs) / len(pairs)


@pytest.mark.parametrize("seed", range(2))
def test_auc_equals_counting_pairs(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(160):
        w = [rng.randrange(1, 6) for _ in range(3)]
        rows.append((i % 2, rng.choice("abbc"), {k: x / sum(w) for k, x in zip("abc", w)}))
    df = spark.createDataFrame(rows, "task int, truth string, probs map<string, double>").repartition(7)
    got = {(r.task, r.class_a, r.class_b): r.auc for r in pb.class_pair_auc(df, ["task"]).collect()}
    for task in (0, 1):
        own = [(t, p) for k, t, p in rows if k == task]
        want = {(task, a, b): _auc(own, a, b) for a in "abc" for b in "abc" if a != b}
        assert {k: v for k, v in got.items() if k[0] == task} == pytest.approx(want)
    hand = {r.task: r.estimate for r in pb.hand_till_auc(df, ["task"]).collect()}
    assert hand[0] == pytest.approx(np.mean([v for k, v in got.items() if k[0] == 0]))


def test_probability_measures_of_missing_classes(spark):
    rows = [("t", "a", {"a": 0.0, "b": 1.0}), ("t", "a", {"b": 1.0}), ("t", None, {"a": 1.0}), ("u", "b", {"b": 0.5})]
    df = spark.createDataFrame(rows, "task string, truth string, probs map<string, double>")
    loss = {r.task: r.estimate for r in pb.mn_log_loss(df, ["task"]).collect()}
    assert loss == pytest.approx({"t": -math.log(1e-15), "u": math.log(2)})
    assert pb.hand_till_auc(df, ["task"]).collect() == []
    assert pb.hand_till_auc(df.limit(0), ["task"]).collect() == []


# ---------------------------------------------------------------- least squares from moments

@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10_000), st.sampled_from([0.0, 0.01, 1.0]))
def test_solve_equals_direct_least_squares(seed, penalty):
    rng = np.random.default_rng(seed)
    n = 40
    level = rng.integers(0, 3, n)
    x = np.column_stack([np.ones(n), rng.normal(1e3, 5, n), rng.normal(size=n), *(level == k for k in range(3))])
    y = 3 * x[:, 1] - 2 * x[:, 2] + 5 * (level == 1) + rng.normal(size=n)
    z = np.column_stack([x, y])
    coef = ln.solve(z.T @ z, penalty)
    assert ln.squared_error(z.T @ z, coef) == pytest.approx(np.mean((y - x @ coef) ** 2), rel=1e-5, abs=1e-6)
    if not penalty:
        best = np.mean((y - x @ np.linalg.lstsq(x, y, rcond=None)[0]) ** 2)
        assert np.mean((y - x @ coef) ** 2) == pytest.approx(best, rel=1e-6)
    else:
        mean = x[:, 1:].mean(0)
        c = x[:, 1:] - mean
        want = np.linalg.solve(c.T @ c + penalty * np.diag(np.maximum((c ** 2).sum(0), 1e-12)), c.T @ (y - y.mean()))
        assert np.allclose(coef[1:], want, rtol=1e-4, atol=1e-5)


def test_moments_give_the_linear_learners_benchmark(spark):
    """The linear rows of the benchmark without MLlib, held against MLlib."""
    a = {r.measure: r.value for r in hm.benchmark_moments(spark, SF_SMALL).collect()}
    b = {r.measure: r.value for r in hm.benchmark(spark, SF_SMALL, ["regr.lm"]).collect()}
    assert a == pytest.approx(b, rel=1e-6)


def test_gram_of_rows_with_gaps_and_levels_outside(spark):
    rows = [(0, 1.0, "a", 2.0), (0, 2.0, "q", 3.0), (1, None, "a", 1.0), (1, 4.0, None, 5.0), (None, 1.0, "a", 1.0)]
    df = spark.createDataFrame(rows, "fold int, x double, c string, y double").repartition(3)
    design = ln.Design(["x"], {"c": ["a", "b"]}, "y")
    got = ln.fold_matrices(ln.fold_gram(df, design), len(design.names))
    assert got[0].tolist() == [[2, 3, 1, 0, 5], [3, 5, 1, 0, 8], [1, 1, 1, 0, 2], [0, 0, 0, 0, 0], [5, 8, 2, 0, 13]]
    assert got[1][0].tolist() == [1, 4, 0, 0, 5] and len(got) == 2
    assert ln.fold_gram(df.limit(0), design).collect() == []
    assert ln.chosen_penalty([(0.0, 0, "test", 2.0), (1.0, 0, "test", 2.0), (1.0, 0, "train", 0.0)]) == 1.0


# ---------------------------------------------------------------- keyed bijection

@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 10, 37, 100, 101, 5000])
def test_bijection_meets_every_place_once(spark, n):
    from tabmill.operators import split as sp

    rows = spark.range(n).withColumn("rep", F.explode(F.array(F.lit(0), F.lit(1))))
    got = sp.with_permuted_index(rows.select("rep", "id"), F.col("id"), n, ["a", "b"], F.col("rep"), "j").collect()
    for rep in (0, 1):
        assert sorted(r.j for r in got if r.rep == rep) == list(range(n))
    if n > 50:
        moves = [[r.j for r in sorted(got) if r.rep == rep] for rep in (0, 1)]
        assert moves[0] != moves[1]
        assert all(abs(np.corrcoef(np.arange(n), m)[0, 1]) < 0.35 for m in moves)
        assert all(sum(i == j for i, j in enumerate(m)) <= 12 for m in moves)
