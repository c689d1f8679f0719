"""Edge cases and properties of the operators on small literal frames."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabmill.functions.dates import age_bucket
from tabmill.functions.names import clean_name_list, snake
from tabmill.functions.strings import str_remove_first_digit
from tabmill.operators import categorical as cat
from tabmill.operators import columns as co
from tabmill.operators import explain as ex
from tabmill.operators import metrics as mt
from tabmill.operators import split as sp
from tabmill.operators.recipe import Recipe, one_hot


# ---------------------------------------------------------------- names


@pytest.mark.parametrize("raw,clean", [
    ("AssessmentID", "assessment_id"), ("Person_ID", "person_id"), ("MSSubClass", "ms_sub_class"),
    ("GrLivArea", "gr_liv_area"), ("PoolQC", "pool_qc"), ("DateOfBirth", "date_of_birth"),
    ("Sale Price", "sale_price"), ("1stFlrSF", "x1st_flr_sf"), ("BsmtFinSF1", "bsmt_fin_sf1"),
    ("already_clean", "already_clean"),
])
def test_snake(raw, clean):
    assert snake(raw) == clean


def test_clean_names_unique_and_idempotent():
    out = clean_name_list(["Sale Price", "SalePrice", "Sale.Price", "id"])
    assert out == ["sale_price", "sale_price_2", "sale_price_3", "id"]
    assert clean_name_list(out) == out


# ---------------------------------------------------------------- dates


def test_age_bucket_edges(spark):
    # reference year 2014: born 1989 -> 25, 1969 -> 45, 1990 -> 24, 1968 -> 46
    rows = [("1/1/89", "25 to 45"), ("1/1/69", "25 to 45"), ("1/1/90", "Younger than 25"),
            ("1/1/68", "Older than 45"), ("1/1/00", "Older than 45"),  # 2000 read as 1900
            ("1/1/14", "Older than 45"), ("13/45/99", None), ("garbage", None), (None, None)]
    df = spark.createDataFrame(rows, "dob string, want string")
    got = df.select("want", age_bucket("dob").alias("got")).collect()
    assert all(r["want"] == r["got"] for r in got)


def test_str_remove_first_digit(spark):
    df = spark.createDataFrame([("Risk of Violence12",), ("a1b2",), ("none",)], "s string")
    got = [r[0] for r in df.select(str_remove_first_digit("s")).collect()]
    assert got == ["Risk of Violence2", "ab2", "none"]


# ---------------------------------------------------------------- columns


def test_null_share_and_constant_columns(spark):
    df = spark.createDataFrame(
        [(1, None, "a", "k", None), (2, 2.0, "a", "k", None), (3, float("nan"), "b", None, None),
         (4, 4.0, "b", "k", None)],
        "id int, x double, s string, half string, allnull string")
    shares = {r["values"]: r["count"] for r in co.null_share(df).collect()}
    assert shares == {"x": 0.5, "s": 0.0, "half": 0.25, "allnull": 1.0}
    # NULL counts as a value (two distinct values), an all-NULL column is constant
    assert co.non_constant_columns(df, ["x", "s", "half", "allnull"]) == ["x", "s", "half"]


def test_key_check_counts_duplicates(spark):
    df = spark.createDataFrame([("t", 1), ("t", 1), ("t", 2), ("u", 1)], "g string, k int")
    got = {r["g"]: (r["n_rows"], r["n_keys"], r["n_duplicated_keys"]) for r in co.key_check(df, ["k"], ["g"]).collect()}
    assert got == {"t": (3, 2, 1), "u": (1, 1, 0)}
    with pytest.raises(ValueError):
        co.assert_unique(df, ["k"], ["g"])


# ---------------------------------------------------------------- lumping


def _lumped(spark, counts, prop, **kw):
    df = spark.createDataFrame([(v,) for v, n in counts.items() for _ in range(n)], "v string")
    out = cat.lump(df.withColumn("was", F.col("v")), ["v"], prop, **kw)
    return {r["was"]: r["v"] for r in out.distinct().collect()}


def test_lump_decision_boundaries(spark):
    counts = {"a": 80, "b": 10, "c": 10}  # b and c exactly at 0.1: not kept (kept iff share > p)
    assert _lumped(spark, counts, 0.1) == {"a": "a", "b": "Other", "c": "Other"}
    assert _lumped(spark, {"a": 90, "b": 10}, 0.1, keep_single_rare=True) == {"a": "a", "b": "b"}
    # dominant: share > 0.89 becomes Other; exactly 0.89 stays
    assert _lumped(spark, {"a": 89, "b": 11}, -0.89) == {"a": "a", "b": "b"}
    assert _lumped(spark, {"a": 90, "b": 10}, -0.89) == {"a": "Other", "b": "b"}


def test_lumping_collects_only_levels_above_the_share(spark):
    df = spark.range(30_000).select(F.col("id").cast("string").alias("v"), F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("w"))
    shares = cat.level_shares(df, ["v", "w"], 0.1)
    assert shares["v"].frequent == {} and shares["v"].levels == 30_000 and set(shares["w"].frequent) == {"x", "y"}
    assert cat.lump(df, ["v", "w"], 0.1).select("v").distinct().collect()[0][0] == "Other"


def test_lump_is_idempotent_and_keeps_null(spark):
    rows = [("a",)] * 8 + [("b",), ("c",), (None,)]
    df = spark.createDataFrame(rows, "v string")
    once = cat.lump(df, ["v"], 0.1)
    twice = cat.lump(once, ["v"], 0.1)
    a = sorted((r[0] or "") for r in once.collect())
    assert a == sorted((r[0] or "") for r in twice.collect())
    assert a.count("Other") == 2 and a.count("") == 1


# ---------------------------------------------------------------- splits, folds, dense ids


def test_split_disjoint_and_complete(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    tagged = sp.initial_split(df, "k", 0.8, 42)
    train = sp.training(tagged)
    test = sp.split_complement(df, train, "k")
    assert train.count() + test.count() == 2000
    assert train.join(test, "k").count() == 0
    assert 0.75 < train.count() / 2000 < 0.85


def test_folds_partition_rows(spark):
    df = sp.cv_folds(spark.range(1000).withColumnRenamed("id", "k"), "k", 4, 4)
    counts = {r["fold"]: r["count"] for r in df.groupBy("fold").count().collect()}
    assert set(counts) == {0, 1, 2, 3} and sum(counts.values()) == 1000


def test_dense_row_id_gap_free(spark):
    df = spark.range(0, 3000, 3).withColumnRenamed("id", "k").repartition(7)
    ids = sp.dense_row_id(df, ["k"], "rid", num_partitions=5).orderBy("k").collect()
    assert [r["rid"] for r in ids] == list(range(1, 1001))
    assert [r["k"] for r in ids] == list(range(0, 3000, 3))


def test_exact_split_size(spark):
    df = spark.range(1003).withColumnRenamed("id", "k")
    tagged = sp.exact_split(df, "k", 0.8, 2)
    assert tagged.filter(F.col("set") == "train").count() == int(0.8 * 1003)


def test_permutation_is_a_permutation(spark):
    df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    out = sp.permute_column(df, "v", "k", seed=5)
    assert sorted(r["v"] for r in out.collect()) == list(range(0, 5000, 10))
    assert out.filter(F.col("v") != F.col("k") * 10).count() > 400


# ---------------------------------------------------------------- metrics


def _pred(spark, pairs):
    return spark.createDataFrame([("t", "m", a, b) for a, b in pairs], "task string, model string, truth string, estimate string")


def test_kappa_perfect_and_constant(spark):
    perfect = _pred(spark, [("a", "a"), ("b", "b"), ("c", "c"), ("a", "a")])
    k = mt.kappa_from_confusion(mt.confusion_matrix(perfect)).first()["kappa"]
    assert k == 1.0
    constant = _pred(spark, [("a", "a"), ("b", "a"), ("c", "a")])
    assert mt.kappa_from_confusion(mt.confusion_matrix(constant)).first()["kappa"] == 0.0
    one_class = _pred(spark, [("a", "a"), ("a", "a")])  # pe = 1: undefined
    assert mt.kappa_from_confusion(mt.confusion_matrix(one_class)).first()["kappa"] is None


def test_kappa_known_value(spark):
    # 2x2: [[20, 5], [10, 15]] -> po = 0.7, pe = 0.5 -> kappa 0.4
    pairs = [("y", "y")] * 20 + [("y", "n")] * 5 + [("n", "y")] * 10 + [("n", "n")] * 15
    k = mt.kappa_from_confusion(mt.confusion_matrix(_pred(spark, pairs))).first()["kappa"]
    assert math.isclose(k, 0.4, rel_tol=1e-12)


def test_mape_skips_zero_targets(spark):
    df = spark.createDataFrame([("g", 0.0, 1.0), ("g", 2.0, 1.0)], "g string, label double, prediction double")
    r = mt.regression_losses(df, ["g"]).first()
    assert r["mape"] == 0.5 and r["mse"] == 1.0


# ---------------------------------------------------------------- recipe


def test_recipe_unseen_levels(spark):
    train = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "a", "y")], "id int, c string, target string")
    test = spark.createDataFrame([(4, "a", "x"), (5, "z", "y")], "id int, c string, target string")
    model = Recipe(target="target", key="id").fit(train)
    assert model.dummy_columns() == ["c_a", "c_b"]
    assert model.label_levels() == ["x", "y"]
    assert model.bake(test).count() == 1
    zero = Recipe(target="target", key="id", unseen="zero").fit(train).bake(test)
    row = zero.filter("id = 5").first()
    assert (row["c_a"], row["c_b"]) == (0, 0)
    keep = Recipe(target="target", key="id", unseen="keep").fit(train).bake(test).filter("id = 5").first()
    assert keep["c_a"] is None
    juiced = model.juice(train)
    assert all(r["c_a"] + r["c_b"] == 1 for r in juiced.collect())


def test_recipe_roles(spark):
    df = spark.createDataFrame([(1, "t", 2.0, "a", "x")], "id int, task string, num double, c string, y string")
    roles = Recipe(target="y", key="id", group="task").roles(df)
    assert roles == {"outcome": ["y"], "id": ["id"], "group": ["task"], "nominal": ["c"], "numeric": ["num"]}


# ---------------------------------------------------------------- explanations


def _linear(df):
    return df.withColumn("prediction", 3.0 * F.col("x1") - 2.0 * F.col("x2") + F.lit(1.0))


@pytest.fixture(scope="module")
def small(spark):
    return spark.range(1, 201).select(
        F.col("id"), (F.col("id") % 17).cast("double").alias("x1"), (F.col("id") % 5).cast("double").alias("x2"),
        (F.col("id") % 3).cast("double").alias("unused"),
        (3.0 * (F.col("id") % 17) - 2.0 * (F.col("id") % 5) + 1.0 + (F.col("id") % 2)).alias("y"))


def test_pdp_slope_of_additive_model(small):
    rows = sorted(ex.pdp(small, _linear, "x1", grid_size=5).collect(), key=lambda r: r["feature_val"])
    slopes = [(b["y_hat"] - a["y_hat"]) / (b["feature_val"] - a["feature_val"]) for a, b in zip(rows, rows[1:])]
    assert all(math.isclose(s, 3.0, rel_tol=1e-9) for s in slopes)


def test_pdp_ice_one_pass_matches_parts(small):
    both = ex.pdp_ice(small, _linear, "x1", grid_size=4)
    assert both.filter("type = 'ice'").count() == 200 * 4
    assert both.filter("type = 'pdp'").count() == 4


def test_ale_centred(small):
    out = ex.ale(small, _linear, "x1", grid_size=5).collect()
    pts = sorted((r["feature_val"], r["ale"]) for r in out)
    # linear model: ALE is a straight line with slope 3
    for (a, fa), (b, fb) in zip(pts, pts[1:]):
        assert math.isclose((fb - fa) / (b - a), 3.0, rel_tol=1e-9)


def test_permutation_importance_unused_feature_is_one(small):
    imp = {r["feature"]: r for r in ex.permutation_importance(small, _linear, "y", ["x1", "x2", "unused"], top=None).collect()}
    assert imp["unused"]["importance"] == 1.0
    assert imp["x1"]["importance"] > imp["x2"]["importance"] > 1.0
    assert sorted(r["display_order"] for r in imp.values()) == [1, 2, 3]


def test_top_features_keeps_ties(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 2.0), ("c", 2.0), ("d", 1.0)], "feature string, importance double")
    assert sorted(r["feature"] for r in ex.top_features(df, top=2).collect()) == ["a", "b", "c"]


def test_shapley_efficiency(small, spark):
    obs = small.filter("id = 7")
    phi = ex.shapley(small, _linear, ["x1", "x2", "unused"], obs, m=20)
    total = sum(r["phi"] for r in phi.collect())
    bg = sp.background_sample(small, "id", 20, 3)
    mean_bg = _linear(bg).agg(F.avg("prediction")).first()[0]
    fx = _linear(obs).first()["prediction"]
    assert math.isclose(total, fx - mean_bg, rel_tol=1e-9, abs_tol=1e-9)
    unused = [r for r in phi.collect() if r["feature"] == "unused"][0]
    assert unused["phi"] == 0.0


def test_lime_recovers_linear_model(small):
    obs = small.filter("id = 7")
    out = {r["feature"]: r["beta"] for r in ex.lime(small, _linear, ["x1", "x2", "unused"], obs, k=2).collect()}
    assert set(out) == {"x1", "x2"}
    assert math.isclose(out["x1"], 3.0, rel_tol=0.05) and math.isclose(out["x2"], -2.0, rel_tol=0.05)


# ---------------------------------------------------------------- compat toggles and more edge cases


def test_recipe_filter_on_toggle(spark):
    """D5: the trained filter step applies to the test set only when asked."""
    train = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, c string, target string")
    test = spark.createDataFrame([(3, "a", "x"), (4, "b", "y")], "id int, c string, target string")
    cond = F.col("c") == "a"
    both = Recipe(target="target", key="id", filter=cond, unseen="zero").fit(train)
    only_train = Recipe(target="target", key="id", filter=cond, filter_on=("train",), unseen="zero").fit(train)
    assert both.dummy_columns() == ["c_a"]
    assert both.bake(test).count() == 1
    assert only_train.bake(test).count() == 2


def test_ale_weighted_mean_is_zero(small):
    from tabmill.operators.explain import quantile_breaks
    out = sorted((r["feature_val"], r["ale"]) for r in ex.ale(small, _linear, "x1", grid_size=5).collect())
    breaks = quantile_breaks(small, "x1", 5)
    xs = [r["x1"] for r in small.select("x1").collect()]
    counts = [sum(1 for x in xs if (breaks[k - 1] < x <= breaks[k]) or (k == 1 and x == breaks[0]))
              for k in range(1, len(breaks))]
    f = [a for _, a in out]
    centre = sum(n * (f[k] + f[k + 1]) / 2 for k, n in enumerate(counts)) / sum(counts)
    assert abs(centre) < 1e-9


def test_nth_row_per_group(spark):
    from tabmill.operators.clean import nth_row_per_group
    rows = [(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 2, "y"), (2, 1, "x")]
    df = spark.createDataFrame(rows, "g int, o int, v string")
    got = {r["g"]: r["v"] for r in nth_row_per_group(df, ["g"], ["o"], 2).collect()}
    assert got == {1: "b", 2: "y"}
    assert nth_row_per_group(df, ["g"], ["o"], 3).count() == 1


def test_csv_inference_reads_na_as_null(spark, tmp_path):
    from tabmill.sources.io import read_csv
    p = tmp_path / "t.csv"
    p.write_text("Id,LotFrontage,Alley\n1,65,NA\n2,NA,Grvl\n")
    df = read_csv(spark, str(p))
    assert dict(df.dtypes) == {"Id": "int", "LotFrontage": "int", "Alley": "string"}
    assert df.filter(F.col("LotFrontage").isNull()).count() == 1
    assert df.filter(F.col("Alley").isNull()).count() == 1


def test_single_level_column_is_dropped(spark):
    df = spark.createDataFrame([(1, "k", "a"), (2, "k", "b")], "id int, one string, two string")
    assert co.drop_constant_cols(df, keep=["id"]).columns == ["id", "two"]


def test_kappa_on_empty_predictions(spark):
    empty = _pred(spark, [("a", "a")]).filter("false")
    assert mt.class_metrics(empty).count() == 0


def test_degenerate_inputs(spark):
    only_key = spark.createDataFrame([(1,), (2,)], "id int")
    assert co.null_share(only_key).count() == 0
    assert cat.level_counts(only_key, []).count() == 0
    assert cat.level_shares(only_key, [], 0.1) == {}
    nulls = spark.createDataFrame([(1, None), (2, None)], "id int, x double")
    assert ex.equal_grid(nulls, "x") == []
    assert ex.ice(nulls, _linear_x, "x").count() == 0


def _linear_x(df):
    return df.withColumn("prediction", F.col("x") * 2.0)


def test_one_hot_names_are_unique(spark):
    df = spark.createDataFrame([(1, "A+"), (2, "A-"), (3, "B"), (4, "é"), (5, "ü")], "id int, g string")
    levels = {"g": ["A+", "A-", "B", "é", "ü"]}
    out = one_hot(df, levels)
    assert len(set(out.columns)) == 6
    assert all(sum(r[c] for c in out.columns if c != "id") == 1 for r in out.collect())
    model = Recipe(target="id", predictors=["g"]).fit(df)
    baked = model.bake(df)
    assert len(set(baked.columns)) == len(baked.columns) == 6
    assert all(sum(r[c] for c in model.dummy_columns()) == 1 for r in baked.collect())


def test_unseen_rows_are_counted(spark):
    train = spark.createDataFrame([(1, "a", "t"), (2, "b", "t")], "id int, g string, target string")
    test = spark.createDataFrame([(3, "a", "t"), (4, "c", "t"), (5, None, "t")], "id int, g string, target string")
    model = Recipe(target="target", key="id").fit(train)
    assert [tuple(r) for r in model.unseen_rows(test).collect()] == [(3, 2)]
    assert model.bake(test).count() == 1


def test_kappa_with_marginals_beyond_64_bit_products(spark):
    n = 4_000_000_000
    conf = spark.createDataFrame([("t", "m", "a", "a", n), ("t", "m", "b", "b", n), ("t", "m", "a", "b", n // 2)],
                                 "task string, model string, truth string, estimate string, n bigint")
    got = mt.kappa_from_confusion(conf).first()["kappa"]
    po = 2 * n / (2.5 * n)
    pe = (1.5 * 1.0 + 1.0 * 1.5) / 2.5**2
    assert math.isclose(got, (po - pe) / (1 - pe), rel_tol=1e-12)


def test_ice_keeps_a_curve_per_row_under_a_shared_id(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, 5.0)], "id int, x double")
    score = lambda d: d.withColumn("prediction", F.col("x") * 2.0)
    for one_pass in (True, False):
        out = ex.pdp_ice(df, score, "x", grid=[0.0, 1.0], one_pass=one_pass).collect()
        assert sum(r["type"] == "ice" for r in out) == 6 and sum(r["type"] == "pdp" for r in out) == 2


def test_lasso_path_meets_the_optimality_conditions():
    rng = np.random.default_rng(5)
    for trial in range(200):
        p, n = int(rng.integers(1, 9)), 40
        x = rng.normal(size=(n, p)) @ rng.normal(size=(p, p))
        if trial % 5 == 0 and p > 1:
            x[:, 1] = 2 * x[:, 0]  # a repeated feature never joins
        x = (x - x.mean(0)) / x.std(0)
        y = x @ rng.normal(size=p) + rng.normal(size=n)
        R, r = x.T @ x / n, x.T @ (y - y.mean()) / n
        for k in range(0, p + 1):
            beta, penalty = ex.lasso_path(R, r, k)
            on = beta != 0
            rest = r - R @ beta
            assert on.sum() <= k
            assert np.all(np.abs(rest) <= penalty + 1e-7)
            assert np.allclose(rest[on], penalty * np.sign(beta[on]), atol=1e-7)
            if k < p and penalty > 1e-9:  # one more feature is about to join
                assert (np.abs(np.abs(rest) - penalty) < 1e-7).sum() > k
    assert ex.lasso_path(np.eye(2), np.zeros(2), 2)[0].tolist() == [0.0, 0.0]
    assert len(ex.lasso_path(np.zeros((0, 0)), np.zeros(0), 2)[0]) == 0


def test_lime_leaves_incomplete_rows_out(spark):
    rows = [(i, float(i % 7), float(i % 5)) for i in range(50)]
    score = lambda d: d.withColumn("prediction", 3.0 * F.coalesce("a", F.lit(0.0)) + 2.0 * F.coalesce("b", F.lit(0.0)))
    whole = spark.createDataFrame(rows, "id int, a double, b double")
    holed = spark.createDataFrame([*rows, (50, None, 1.0)], "id int, a double, b double")
    obs = whole.filter("id in (3, 4)")
    beta = lambda d, o: sorted((r["id"], r["feature"], round(r["beta"], 2)) for r in ex.lime(d, score, ["a", "b"], o).collect())
    assert beta(whole, obs) == beta(holed, obs) == [(i, f, b) for i in (3, 4) for f, b in (("a", 3.0), ("b", 2.0))]
    assert tuple(ex.incomplete_rows(holed, ["a", "b"]).first()) == (51, 1)
    assert beta(holed, holed.filter("id = 50")) == []  # an incomplete observation has no surrogate


def test_lime_explains_more_observations_than_partitions(small):
    got = ex.lime(small.coalesce(1), _linear, ["x1", "x2"], small)
    assert got.select("id").distinct().count() == small.select("id").distinct().count()


def test_lime_recodes_categories_to_the_observation(spark):
    df = spark.createDataFrame([(i, float(i), "abc"[i % 3]) for i in range(30)], "id int, x double, g string")
    score = lambda d: d.withColumn("prediction", F.when(F.col("g") == "a", 5.0).otherwise(0.0))
    got = {r["feature"]: r for r in ex.lime(df, score, ["x", "g"], df.filter("id = 0")).collect()}
    assert math.isclose(got["g"]["beta"], 5.0, rel_tol=1e-2) and got["g"]["feature_value"] == "g=a"


def test_quantile_breaks_with_a_hot_value(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, 7.0).otherwise(F.col("id").cast("double")).alias("x"))
    values = sorted(r["x"] for r in df.collect())
    want = sorted({values[max(1, -(-(1000 * k) // 20)) - 1] for k in range(21)})
    assert ex.quantile_breaks(df, "x") == want


@pytest.mark.parametrize("prop", [0.0, 0.003, 0.5, 0.801, 1.0])
def test_exact_split_draws_the_lowest_hashes(spark, prop):
    df = spark.range(777).withColumnRenamed("id", "k")
    out = sp.exact_split(df, "k", prop).withColumn("h", sp.hash_hex("k", 2)).collect()
    low = {r["k"] for r in sorted(out, key=lambda r: r["h"])[:int(prop * 777)]}
    assert {r["k"] for r in out if r["set"] == "train"} == low
