"""Registered queries: explanations of the house model (pinned formula: oracle-checked; MLlib: rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import effects as ef
from ..operators import explain as ex
from ..operators import split as sp
from . import house
from . import house_models as hm
from .catalog import query
from .sql import EXPLAIN_FEATURES, _shapley_sql, lime_gram_sql, lime_pair_sql, pdp_all_sql, with_tables


def _obs(df):
    """The explained observation: position 122 in key order (dense ids)."""
    return sp.row_at_position(df, house.KEY, house.OBSERVATION)


@query("pdp", with_tables(["ex_ice"], """
select feature, feature_val, round(avg(prediction), 4) as y_hat, 'pdp' as type, cast(null as bigint) as id
from ex_ice group by feature, feature_val
"""))
def q_pdp(spark, d):
    out = ex.pdp(house.cleaned(spark, d), house.rule_scorer, house.FEATURE)
    return out.withColumn("y_hat", F.round("y_hat", 4))


@query("ice_curves", with_tables(["ex_ice"], """
select feature, feature_val, prediction / 1000.0 as y_hat, 'ice' as type, id from ex_ice
"""))
def q_ice(spark, d):
    return ex.ice(house.cleaned(spark, d), house.rule_scorer, house.FEATURE, scale=1000.0)


@query("pdp_ice", with_tables(["ex_ice"], """
select feature, feature_val, prediction as y_hat, 'ice' as type, id from ex_ice
union all
select feature, feature_val, round(avg(prediction), 4) as y_hat, 'pdp' as type, cast(null as bigint) as id
from ex_ice group by feature, feature_val
"""))
def q_pdp_ice(spark, d):
    # a formula is cheap to score twice: no shuffle of the ICE rows
    out = ex.pdp_ice(house.cleaned(spark, d), house.rule_scorer, house.FEATURE, one_pass=False)
    return out.withColumn("y_hat", F.when(F.col("type") == "pdp", F.round("y_hat", 4)).otherwise(F.col("y_hat")))


@query("pdp_all", with_tables(["houses_clean"], pdp_all_sql(EXPLAIN_FEATURES[:2], EXPLAIN_FEATURES[2:])))
def q_pdp_all(spark, d):
    """Every feature of the house table, numeric and categorical."""
    out = ex.pdp_all(house.cleaned(spark, d), house.rule_scorer, exclude=[house.TARGET])
    return out.withColumn("y_hat", F.round("y_hat", 4))


@query("pdp_ice_one_pass", with_tables(["ex_ice"], """
select feature, feature_val, prediction as y_hat, 'ice' as type, id from ex_ice
union all
select feature, feature_val, round(avg(prediction), 4) as y_hat, 'pdp' as type, cast(null as bigint) as id
from ex_ice group by feature, feature_val
"""))
def q_pdp_ice_one_pass(spark, d):
    """The default: every grid row scored once, the mean curve aggregated from the written curves."""
    out = ex.pdp_ice(house.cleaned(spark, d), house.rule_scorer, house.FEATURE)
    return out.withColumn("y_hat", F.when(F.col("type") == "pdp", F.round("y_hat", 4)).otherwise(F.col("y_hat")))


@query("ale", with_tables(["ale_out"], "select feature, feature_val, round(ale, 4) as ale from ale_out"))
def q_ale(spark, d):
    out = ex.ale(house.cleaned(spark, d), house.rule_scorer, house.FEATURE)
    return out.withColumn("ale", F.round("ale", 4))


@query("ale_all", with_tables(["ale_out", "ale_lot_out"], """
select feature, round(feature_val, 6) as feature_val, round(ale, 3) as ale from ale_out
union all select feature, round(feature_val, 6), round(ale, 3) from ale_lot_out
"""))
def q_ale_all(spark, d):
    """Every numeric feature of the house table."""
    out = ex.ale_all(house.cleaned(spark, d), house.rule_scorer, exclude=[house.TARGET])
    return out.select("feature", F.round("feature_val", 6).alias("feature_val"), F.round("ale", 3).alias("ale"))


@query("level_distances", with_tables(["lv_distance"], """
select feature, level_a, level_b, round(distance, 9) as distance from lv_distance
"""))
def q_level_distances(spark, d):
    """How far the levels of every category lie apart over all other features."""
    out = ef.level_distances(house.cleaned(spark, d), exclude=[house.TARGET])
    return out.withColumn("distance", F.round("distance", 9))


@query("ale_levels", with_tables(["lv_ale"], "select feature, level, position, round(ale, 3) as ale from lv_ale"))
def q_ale_levels(spark, d):
    """Accumulated effects of every category, along levels ordered by likeness."""
    out = ef.ale_levels(house.cleaned(spark, d), house.level_scorer, exclude=[house.TARGET])
    return out.withColumn("ale", F.round("ale", 3))


@query("ice_levels", with_tables(["lv_ice"], """
select feature, cast(null as double) as feature_val, feature_level, prediction / 1000.0 as y_hat, 'ice' as type, id from lv_ice
"""))
def q_ice_levels(spark, d):
    """A curve per row over the levels of every category."""
    df = house.cleaned(spark, d)
    nominal = [c for c in df.columns if c not in (house.KEY, house.TARGET, *EXPLAIN_FEATURES[:2])]
    return ef.ice_all(df, house.level_scorer, nominal, scale=1000.0)


@query("pdp_ice_all", with_tables(["lv_ice", "ex_grid", "lv_number_ice"], """
, c as (select feature, cast(null as double) as feature_val, feature_level, prediction as y_hat, id from lv_ice
  union all select feature, feature_val, null, prediction, id from lv_number_ice)
select feature, feature_val, feature_level, round(y_hat, 3) as y_hat, 'ice' as type, id from c
union all
select feature, feature_val, feature_level, round(avg(y_hat), 3), 'pdp', null from c group by feature, feature_val, feature_level
"""))
def q_pdp_ice_all(spark, d):
    """Curves and mean curves of every feature, numeric and categorical."""
    # a formula is cheap to score twice: the curves (rows x grid values) are not written for the means
    out = ef.pdp_ice_all(house.cleaned(spark, d), house.level_scorer, exclude=[house.TARGET], one_pass=False)
    return out.withColumn("y_hat", F.round("y_hat", 3))


@query("perm_importance", with_tables(["pi_out"], """
select feature, importance_05, importance, importance_95, round(permutation_error, 4) as permutation_error,
  cast(row_number() over (order by importance desc, feature) as bigint) as display_order
from pi_out qualify rank() over (order by importance desc) <= 20
"""))
def q_perm_importance(spark, d):
    out = ex.permutation_importance(house.cleaned(spark, d), house.rule_scorer, house.TARGET, EXPLAIN_FEATURES)
    return out.withColumn("permutation_error", F.round("permutation_error", 4))


@query("top_features", with_tables(["pi_out"], """
select feature, importance, cast(row_number() over (order by importance desc, feature) as bigint) as display_order
from pi_out qualify rank() over (order by importance desc) <= 3
"""))
def q_top_features(spark, d):
    imp = ex.permutation_importance(house.cleaned(spark, d), house.rule_scorer, house.TARGET, EXPLAIN_FEATURES,
                                    top=None)
    return ex.top_features(imp.select("feature", "importance"), top=3)


@query("shapley", "with " + with_tables(["houses_clean"], "")[5:].rstrip() + "," + _shapley_sql())
def q_shapley(spark, d):
    df = house.cleaned(spark, d)
    out = ex.shapley(df, house.rule_scorer, EXPLAIN_FEATURES, _obs(df))
    return out.select("id", "feature", "feature_value", F.round("phi", 4).alias("phi"),
                      F.round("phi_var", 4).alias("phi_var"))


@query("lime_batch")
def q_lime(spark, d):
    df = house.cleaned(spark, d)
    return ex.lime(df, house.rule_scorer, EXPLAIN_FEATURES, _obs(df))


@query("lime_gram", "with " + with_tables(["houses_clean"], "")[5:].rstrip() + "," + lime_gram_sql(
    EXPLAIN_FEATURES[:2], EXPLAIN_FEATURES[2:]))
def q_lime_gram(spark, d):
    df = house.cleaned(spark, d)
    out = ex.lime_gram(df, house.rule_scorer, EXPLAIN_FEATURES, _obs(df))
    return out.select("id", "i", "j", F.format_string("%.7e", "value").alias("value"))


@query("lime_pair", "with " + with_tables(["houses_clean"], "")[5:].rstrip() + "," + lime_pair_sql(
    EXPLAIN_FEATURES[:2], EXPLAIN_FEATURES[2:]))
def q_lime_pair(spark, d):
    """Local surrogate of two features: the lasso path up to where a third would join."""
    df = house.cleaned(spark, d)
    out = ex.lime(df, house.rule_scorer, EXPLAIN_FEATURES, _obs(df), k=2)
    return out.select("id", "feature", F.format_string("%.6e", "beta").alias("beta"), F.format_string("%.6e", "effect").alias("effect"))


# ---------------------------------------------------------------- the same operators over a fitted forest

@query("pdp_forest")
def q_pdp_forest(spark, d):
    _, fitted, df = hm.fit_house(spark, d, ["regr.ranger"])
    return ex.pdp_ice(df.drop("set"), fitted["regr.ranger"].scorer(), house.FEATURE)


@query("perm_importance_forest")
def q_perm_forest(spark, d):
    _, fitted, df = hm.fit_house(spark, d, ["regr.ranger"])
    return ex.permutation_importance(df.drop("set"), fitted["regr.ranger"].scorer(), house.TARGET, EXPLAIN_FEATURES)


@query("lime_forest")
def q_lime_forest(spark, d):
    _, fitted, df = hm.fit_house(spark, d, ["regr.ranger"])
    base = df.drop("set")
    return ex.lime(base, fitted["regr.ranger"].scorer(), EXPLAIN_FEATURES, _obs(base))


# ---------------------------------------------------------------- every fitted learner, stacked by learner


@query("importance_learners")
def q_importance_learners(spark, d):
    return hm.explain_learners(spark, d, "importance")


@query("pdp_ice_learners")
def q_pdp_ice_learners(spark, d):
    return hm.explain_learners(spark, d, "pdp_ice")


@query("ale_learners")
def q_ale_learners(spark, d):
    return hm.explain_learners(spark, d, "ale")


@query("shapley_learners")
def q_shapley_learners(spark, d):
    return hm.explain_learners(spark, d, "shapley")


@query("lime_learners")
def q_lime_learners(spark, d):
    return hm.explain_learners(spark, d, "lime")


@query("house_explained")
def q_house_explained(spark, d):
    """The whole HOUSE analysis from one fit per learner, as one long table."""
    return hm.house_explained(spark, d)
