"""Tuning over folds: means against a plain loop, ties, folds that cannot be used."""

import collections
import hashlib

from tabmill.operators import tuning as tn

FOLDS = 3


def fold_of(key):
    return int(hashlib.md5(f"{key}|4".encode()).hexdigest()[:8], 16) % FOLDS


def rows():
    out = [(i, "a", "yes" if (i % 7 < 5) == (i % 2 == 0) else "no", i % 2, "extra") for i in range(60)]
    out += [(100 + i, "b", "yes" if i % 5 else "no", i % 2, None) for i in range(40)]  # the most frequent class in both groups is the same
    return out + [(7, "c", "yes", 1, "only row of its task")]


def majority(values):
    return min(collections.Counter(values).items(), key=lambda x: (-x[1], x[0]))[0]


def plain(data, task, by_x):
    """(mean train, mean test) accuracy of the most frequent class outside each fold."""
    own = [(fold_of(k), x, y) for k, t, y, x, _ in data if t == task]
    sides = {True: [], False: []}
    for k in range(FOLDS):
        best = {x: majority([b for f, a, b in own if f != k and (a == x or not by_x)]) for x in (0, 1)}
        for test in sides:
            hits = [best[x] == y for f, x, y in own if (f == k) == test]
            sides[test].append(sum(hits) / len(hits))
    return tuple(round(sum(sides[s]) / FOLDS, 12) for s in (False, True))


def test_means_ties_and_unusable_folds(spark):
    data = rows()
    df = spark.createDataFrame(data, "id long, task string, y string, x int, more string")
    settings = [("decision_tree", {"depth": 0}), ("decision_tree", {"depth": 1})]
    out = {(r["task"], r["setting"]): r for r in tn.tune(df, ["x"], settings, ["a", "b", "c", "none"], "task", "y", "id", folds=FOLDS).collect()}
    assert set(out) == {("a", 0), ("a", 1), ("b", 0), ("b", 1)}  # c has one fold only
    for (task, setting), r in out.items():
        assert (r["train"], r["test"]) == plain(data, task, setting == 1), (task, setting)
        assert r["n_folds"] == FOLDS and r["params"] == f"depth={setting}"
    assert [t for t, r in out.items() if r["chosen"]] == sorted([("a", 1), ("b", 0)], key=list(out).index)  # b: a tie, the earlier one wins

    chosen = spark.createDataFrame([tuple(r) for r in out.values()], "task string, model string, setting int, n_folds long, train double, test double, "
                                   "chosen boolean, params string")
    fits = tn.refit_chosen(df, ["x"], settings, chosen, "task", "y", "id")
    assert set(fits) == {("a", "decision_tree"), ("b", "decision_tree")}
    assert fits["a", "decision_tree"].params["maxDepth"] == "1" and fits["b", "decision_tree"].params["maxDepth"] == "0"


def test_no_rows(spark):
    df = spark.createDataFrame([], "id long, task string, y string, x int")
    assert tn.tune(df, ["x"], [("decision_tree", {"depth": 1})], ["a"], "task", "y", "id").count() == 0
