"""Registered queries of the HOUSE side: loading, column operators, cleaning, splitting."""

from __future__ import annotations

import warnings

from pyspark.sql import functions as F

from ..functions.names import clean_names
from ..operators import categorical as cat
from ..operators import clean
from ..operators import columns as co
from ..operators import linear as ln
from ..operators import split as sp
from ..operators.recipe import Recipe
from ..sources import io
from . import house
from .catalog import query
from .sql import HOUSE_FACTORS, HOUSE_KEPT_FACTORS, fold_gram_sql, with_tables

_COMPLETE_COLS = ["id", "sale_price", "gr_liv_area", "lot_frontage", *HOUSE_FACTORS]


def _complete(spark, d):
    t = house.typed(spark, d)
    return co.drop_na_rows(t.select(*_COMPLETE_COLS), _COMPLETE_COLS[1:])


@query("house_load", with_tables(["houses_raw"], "select * from houses_raw"))
def q_house_load(spark, d):
    return house.load(spark, d)


@query("clean_names", with_tables(["houses_named"], "select * from houses_named"))
def q_clean_names(spark, d):
    return clean_names(house.load(spark, d))


@query("cast_by_pattern", with_tables(["houses_named"], """
select * replace (cast(yr_sold as varchar) as yr_sold) from houses_named
"""))
def q_cast_by_pattern(spark, d):
    return co.cast_by_pattern(clean_names(house.load(spark, d)))


@query("csv_roundtrip", with_tables(["houses_raw"], "select * from houses_raw"))
def q_csv_roundtrip(spark, d):
    return io.csv_roundtrip(spark, house.load(spark, d))


@query("persist_roundtrip", with_tables(["houses_typed"], "select * from houses_typed"))
def q_persist_roundtrip(spark, d):
    return io.persist_roundtrip(spark, house.typed(spark, d), partition_by=["yr_sold"])


@query("select_one_of", with_tables(["houses_typed"], "select id, sale_price, gr_liv_area from houses_typed"))
def q_select_one_of(spark, d):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return co.select_one_of(house.typed(spark, d), ["id", "sale_price", "no_such_column", "gr_liv_area"])


@query("select_numeric", with_tables(["houses_typed"], "select id, sale_price, gr_liv_area, lot_frontage from houses_typed"))
def q_select_numeric(spark, d):
    return co.select_numeric(house.typed(spark, d), ["id"])


@query("select_categorical", with_tables(["houses_typed"], """
select id, overall_qual, mo_sold, yr_sold, ms_sub_class, neighborhood, garage_type, street, pool_qc, utilities
from houses_typed
"""))
def q_select_categorical(spark, d):
    return co.select_categorical(house.typed(spark, d), ["id"])


@query("drop_constant_cols", with_tables(["houses_typed"], "select * exclude (utilities) from houses_typed"))
def q_drop_constant(spark, d):
    return co.drop_constant_cols(house.typed(spark, d), keep=["id"])


@query("null_share", with_tables(["houses_typed"], " union all ".join(
    f"select '{c}' as \"values\", avg(case when {c} is null{' or isnan(' + c + ')' if c in ('sale_price', 'gr_liv_area', 'lot_frontage') else ''}"
    f" then 1.0 else 0.0 end)::double as \"count\" from houses_typed"
    for c in ["sale_price", "gr_liv_area", "lot_frontage", "overall_qual", "mo_sold", "yr_sold", "ms_sub_class",
              "neighborhood", "garage_type", "street", "pool_qc", "utilities"])))
def q_null_share(spark, d):
    return co.null_share(house.typed(spark, d), "id")


@query("keep_columns_by_null_share", with_tables(["houses_typed"], " union all ".join(
    f"select * from (select '{c}' as \"values\", avg(case when {c} is null then 1.0 else 0.0 end)::double as \"count\""
    f" from houses_typed) where \"count\" < 0.2"
    for c in ["sale_price", "gr_liv_area", "lot_frontage", "overall_qual", "mo_sold", "yr_sold", "ms_sub_class",
              "neighborhood", "garage_type", "street", "pool_qc", "utilities"])))
def q_keep_by_null_share(spark, d):
    return co.keep_columns_by_null_share(co.null_share(house.typed(spark, d), "id"), 0.2)


@query("drop_na_rows", with_tables(["houses_complete"], "select * from houses_complete"))
def q_drop_na_rows(spark, d):
    return _complete(spark, d)


@query("level_freq", with_tables(["houses_complete"], f"""
select "column", level, n, cast(n as double) / sum(n) over (partition by "column") as share
from (select "column", level, cast(count(*) as bigint) as n
      from (unpivot houses_complete on {", ".join(HOUSE_FACTORS)} into name "column" value level)
      group by all)
"""))
def q_level_freq(spark, d):
    return cat.level_freq(_complete(spark, d), HOUSE_FACTORS)


@query("lump_rare", with_tables(["houses_rare"], "select * from houses_rare"))
def q_lump_rare(spark, d):
    return cat.lump(_complete(spark, d), HOUSE_FACTORS, 0.1)


@query("lump_dominant", with_tables(["houses_lumped"], "select * from houses_lumped"))
def q_lump_dominant(spark, d):
    return cat.lump(cat.lump(_complete(spark, d), HOUSE_FACTORS, 0.1), HOUSE_FACTORS, -0.89)


@query("house_combine", with_tables(["houses_clean"], "select * from houses_clean"))
def q_house_combine(spark, d):
    return house.cleaned(spark, d)


@query("join_halves", with_tables(["houses_typed"], """
select n.id, n.sale_price, n.gr_liv_area, n.lot_frontage, f.overall_qual, f.mo_sold, f.yr_sold, f.ms_sub_class,
  f.neighborhood, f.garage_type, f.street, f.utilities
from (select id, sale_price, gr_liv_area, lot_frontage from houses_typed
      where sale_price is not null and gr_liv_area is not null and lot_frontage is not null) n
join (select id, overall_qual, mo_sold, yr_sold, ms_sub_class, neighborhood, garage_type, street, utilities
      from houses_typed where garage_type is not null) f on n.id = f.id
"""))
def q_join_halves(spark, d):
    return clean.join_halves(house.typed(spark, d).drop("pool_qc"), "id")


@query("positional_join", with_tables(["houses_typed", "houses_clean"], f"""
select f.id, n.sale_price, n.gr_liv_area, n.lot_frontage, {", ".join("f." + c for c in HOUSE_KEPT_FACTORS)}
from (select sale_price, gr_liv_area, lot_frontage, row_number() over (order by id) as rowid from houses_typed
      where sale_price is not null and gr_liv_area is not null and lot_frontage is not null) n
join (select *, row_number() over (order by id) as rowid from houses_clean) f on n.rowid = f.rowid
"""))
def q_positional_join(spark, d):
    return house.cleaned(spark, d, align="position")


@query("dense_row_id", with_tables(["houses_typed"], """
select id, cast(row_number() over (order by id) as bigint) as row_id from houses_typed
"""))
def q_dense_row_id(spark, d):
    return sp.dense_row_id(house.typed(spark, d).select("id"), ["id"], "row_id")


@query("pick_observation", with_tables(["houses_clean"], """
select * from (select *, row_number() over (order by id) as rn from houses_clean) where rn = 122
""".replace("select * from (", "select * exclude (rn) from (")))
def q_pick_observation(spark, d):
    return sp.row_at_position(house.cleaned(spark, d), house.KEY, house.OBSERVATION)


@query("house_split_exact", with_tables(["houses_clean"], """
select id, case when row_number() over (order by md5(concat_ws('|', cast(id as varchar), '2')), id)
                     <= floor(0.8 * count(*) over ()) then 'train' else 'test' end as set
from houses_clean
"""))
def q_house_split_exact(spark, d):
    return sp.exact_split(house.cleaned(spark, d).select("id"), "id", house.SPLIT_PROP, house.SPLIT_SEED)


@query("cv_folds", with_tables(["houses_clean"], """
select id, ('0x' || substr(md5(concat_ws('|', cast(id as varchar), '4')), 1, 8))::bigint % 4 as fold
from houses_clean
"""))
def q_cv_folds(spark, d):
    return sp.cv_folds(house.cleaned(spark, d).select("id"), "id", house.FOLDS, house.FOLD_SEED)


@query("split_complement", with_tables(["houses_clean"], """
select * from houses_clean
where id not in (select id from houses_clean
                 where substr(md5(concat_ws('|', cast(id as varchar), '2')), 1, 8) < 'cccccccc')
"""))
def q_split_complement(spark, d):
    df = house.cleaned(spark, d)
    train = sp.training(sp.initial_split(df, "id", house.SPLIT_PROP, house.SPLIT_SEED))
    return sp.split_complement(df, train, "id")


@query("permute_column", with_tables(["houses_clean", "pc_moves"], f"""
select a.id, a.sale_price, b.g as gr_liv_area, a.lot_frontage, {", ".join("a." + c for c in HOUSE_KEPT_FACTORS)}
from (select *, row_number() over (order by id) - 1 as i from houses_clean) a join pc_moves m on m.i = a.i
join (select gr_liv_area as g, row_number() over (order by id) - 1 as i from houses_clean) b on b.i = m.j
"""))
def q_permute_column(spark, d):
    return sp.permute_column(house.cleaned(spark, d), "gr_liv_area", "id", seed=1)


@query("features_target_split", with_tables(["houses_clean"], "select * exclude (sale_price) from houses_clean"))
def q_features_target_split(spark, d):
    x, _y = co.features_target_split(house.cleaned(spark, d), house.TARGET, house.KEY)
    return x

# ---------------------------------------------------------------- models and resampling

from ..operators import models as md  # noqa: E402
from . import house_models as hm  # noqa: E402


@query("cv_mse", with_tables(["cv_losses"], "select learner, fold, set, round(mse, 2) as mse from cv_losses"))
def q_cv_mse(spark, d):
    return hm.cv_linear_1d(spark, d).select("learner", "fold", "set", F.round("mse", 2).alias("mse"))


@query("cv_mape", with_tables(["cv_losses"], "select learner, fold, set, round(mape, 10) as mape from cv_losses"))
def q_cv_mape(spark, d):
    return hm.cv_linear_1d(spark, d).select("learner", "fold", "set", F.round("mape", 10).alias("mape"))


@query("measure_ids", with_tables(["cv_losses"], """
select learner, concat_ws('_', 'mse', set) as measure, round(avg(mse), 2) as value from cv_losses group by learner, set
union all
select learner, concat_ws('_', 'mape', set) as measure, round(avg(mape), 10) as value from cv_losses group by learner, set
"""))
def q_measure_ids(spark, d):
    agg = hm.cv_linear_1d(spark, d).groupBy("learner", "set").agg(F.avg("mse").alias("mse"), F.avg("mape").alias("mape"))
    return agg.select("learner", F.inline(F.array(
        F.struct(F.concat_ws("_", F.lit("mse"), F.col("set")).alias("measure"), F.round("mse", 2).alias("value")),
        F.struct(F.concat_ws("_", F.lit("mape"), F.col("set")).alias("measure"), F.round("mape", 10).alias("value")),
    )))


@query("benchmark_grid", with_tables(["cv_d"], """
select fold, unnest(['regr.lm', 'regr.rpart', 'regr.ranger']) as learner from (select distinct fold from cv_d)
"""))
def q_benchmark_grid(spark, d):
    folds = sp.cv_folds(house.cleaned(spark, d).select("id"), "id", house.FOLDS, house.FOLD_SEED)
    learners = F.explode(F.array(*[F.lit(n) for n in md.REGRESSOR_NAMES]))
    return folds.select("fold").distinct().select("fold", learners.alias("learner"))


@query("house_lm_1d", with_tables(["houses_clean"], """
select round(regr_slope(sale_price, gr_liv_area), 6) as slope, round(regr_intercept(sale_price, gr_liv_area), 6) as intercept,
  cast(count(*) as bigint) as n
from houses_clean where substr(md5(concat_ws('|', cast(id as varchar), '2')), 1, 8) < 'cccccccc'
"""))
def q_house_lm_1d(spark, d):
    fit = hm.fit_linear_1d(spark, d)
    return fit.select(F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"), "n")


@query("house_lm_ml", with_tables(["houses_clean"], """
select round(regr_slope(sale_price, gr_liv_area), 4) as slope, round(regr_intercept(sale_price, gr_liv_area), 3) as intercept
from houses_clean where substr(md5(concat_ws('|', cast(id as varchar), '2')), 1, 8) < 'cccccccc'
"""))
def q_house_lm_ml(spark, d):
    """The registered linear learner on one feature, through the recipe and the fit helper."""
    train = sp.training(sp.initial_split(house.cleaned(spark, d), house.KEY, house.SPLIT_PROP, house.SPLIT_SEED))
    rm = Recipe(target=house.TARGET, key=house.KEY, predictors=[house.FEATURE], unseen="zero").fit(train)
    line = md.fit_regressor(train, rm, house.TARGET, "regr.lm").model.stages[-1]
    return spark.createDataFrame([(round(float(line.coefficients[0]), 4), round(float(line.intercept), 3))], "slope double, intercept double")


@query("house_dt_means", with_tables(["houses_clean"], """
select neighborhood = 'BUILDING' as building, round(avg(sale_price), 4) as prediction
from houses_clean where substr(md5(concat_ws('|', cast(id as varchar), '2')), 1, 8) < 'cccccccc' group by 1
"""))
def q_house_dt_means(spark, d):
    """The tree learner on one two-level predictor: each leaf predicts its group's mean."""
    df = house.cleaned(spark, d).withColumn("building", F.when(F.col("neighborhood") == "BUILDING", "yes").otherwise("no"))
    train = sp.training(sp.initial_split(df, house.KEY, house.SPLIT_PROP, house.SPLIT_SEED))
    rm = Recipe(target=house.TARGET, key=house.KEY, predictors=["building"], unseen="zero").fit(train)
    score = md.fit_regressor(train, rm, house.TARGET, "regr.rpart").scorer()
    return score(train).select((F.col("building") == "yes").alias("building"), F.round("prediction", 4).alias("prediction")).distinct()


@query("house_lm")
def q_house_lm(spark, d):
    return hm.house_predictions(spark, d, ["regr.lm"])


@query("house_dt")
def q_house_dt(spark, d):
    return hm.house_predictions(spark, d, ["regr.rpart"])


@query("house_rf")
def q_house_rf(spark, d):
    return hm.house_predictions(spark, d, ["regr.ranger"])


@query("house_predict")
def q_house_predict(spark, d):
    return hm.house_predictions(spark, d)


@query("house_fit")
def q_house_fit(spark, d):
    rm, fitted, df = hm.fit_house(spark, d)
    n_train = df.filter(F.col("set") == "train").count()
    rows = [(n, type(f.model.stages[-1]).__name__, len(md.feature_columns(rm)), n_train) for n, f in fitted.items()]
    return spark.createDataFrame(rows, "learner string, model string, n_features int, n_train bigint")


@query("house_benchmark")
def q_house_benchmark(spark, d):
    return hm.benchmark(spark, d)


@query("select_by_position", with_tables(["houses_typed"], "select gr_liv_area, id from houses_typed"))
def q_select_by_position(spark, d):
    return co.select_by_position(house.typed(spark, d), 2, 0)


@query("lump_high_cardinality", with_tables(["houses_typed"], """
select id,
  case when count(*) over (partition by id_text) / cast(count(*) over () as double) > 0.1 then id_text else 'Other' end as id_text,
  case when neighborhood is null then null
       when count(neighborhood) over (partition by neighborhood) / cast(count(neighborhood) over () as double) > 0.1
       then neighborhood else 'Other' end as neighborhood
from (select *, cast(id as varchar) as id_text from houses_typed)
"""))
def q_lump_high_cardinality(spark, d):
    """A factor with as many levels as rows, lumped beside an ordinary one."""
    df = house.typed(spark, d).select("id", F.col("id").cast("string").alias("id_text"), "neighborhood")
    return cat.lump(df, ["id_text", "neighborhood"], 0.1)


@query("house_surviving_factors", with_tables(["houses_lumped"], f"""
select "column", count(distinct level) as n_levels
from (unpivot (select {", ".join(HOUSE_FACTORS)} from houses_lumped) on {", ".join(HOUSE_FACTORS)} into name "column" value level)
group by 1 having count(distinct level) > 1
"""))
def q_house_surviving_factors(spark, d):
    """Which factors survive the single-level check, with their levels after lumping."""
    df = house.cleaned(spark, d)
    return cat.level_counts(df, co.categorical_columns(df)).groupBy("column").agg(F.count("level").alias("n_levels"))


# ---------------------------------------------------------------- least squares from fold moments


@query("fold_gram", "with " + with_tables(["houses_clean"], "")[5:].rstrip() + "," + fold_gram_sql(
    ["gr_liv_area", "lot_frontage"], HOUSE_KEPT_FACTORS))
def q_fold_gram(spark, d):
    """Sums of products of every pair of design columns per fold, in one pass."""
    df, design = hm.foldded(spark, d)
    return ln.fold_gram(df, design).select("fold", "i", "j", F.format_string("%.7e", "value").alias("value"))


@query("benchmark_line", with_tables(["cv_losses"], """
select 'regr.lm' as learner, measure || '_' || set as measure, round(avg(value), 6) as value
from (unpivot (select set, mse, mape from cv_losses) on mse, mape into name measure value value) group by all
"""))
def q_benchmark_line(spark, d):
    """The linear learner's benchmark on one feature, from fold moments."""
    return hm.benchmark_moments(spark, d, [house.FEATURE], []).withColumn("value", F.round("value", 6))


@query("house_benchmark_moments")
def q_house_benchmark_moments(spark, d):
    """The linear learner's benchmark on all predictors, from fold moments."""
    return hm.benchmark_moments(spark, d)


@query("ridge_path", with_tables(["ridge_path", "ridge_chosen"], """
select penalty, fold, set, round(mse) as mse, penalty = (select penalty from ridge_chosen) as chosen from ridge_path
"""))
def q_ridge_path(spark, d):
    """Errors of the one-feature line over penalties and folds; the penalty with the least mean test error is marked."""
    return hm.ridge_path(spark, d, [house.FEATURE], []).withColumn("mse", F.round("mse"))


@query("house_ridge_path")
def q_house_ridge_path(spark, d):
    """The same over all predictors."""
    return hm.ridge_path(spark, d)


@query("house_benchmark_means", with_tables(["building_losses"], """
select learner, measure || '_' || set as measure, round(avg(value), 3) as value
from (unpivot (select set, mse, mape from building_losses) on mse, mape into name measure value value),
  (select unnest(['regr.lm', 'regr.rpart', 'regr.ranger']) as learner) group by all
"""))
def q_house_benchmark_means(spark, d):
    """The benchmark of the three learners on one two-level predictor: all predict the mean of the other folds' group."""
    df = house.cleaned(spark, d).withColumn("building", F.when(F.col("neighborhood") == "BUILDING", "yes").otherwise("no"))
    spec = Recipe(target=house.TARGET, key=house.KEY, predictors=["building"], unseen="zero")
    out = hm.benchmark(spark, d, table=df, spec=spec, num_trees=1, bagging=False)
    return out.withColumn("value", F.round("value", 3))
