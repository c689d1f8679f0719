"""Registered queries of the RISK side (risk-score table)."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from ..operators import explain as ex
from ..operators import metrics as mt
from ..operators import probability as pb
from ..operators import split as sp
from . import risk
from .catalog import query
from .sql import nth_sql, with_tables

# ---------------------------------------------------------------- M0 slice


@query("risk_load", with_tables(["assessments"], "select * from assessments"))
def q_risk_load(spark, d):
    return risk.load(spark, d)


@query("age_bucket", with_tables(["assessments"], """
select date_of_birth as age_bucket, cast(count(*) as bigint) as n from assessments group by 1
"""))
def q_age_bucket(spark, d):
    return risk.load(spark, d).groupBy(F.col("date_of_birth").alias("age_bucket")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


@query("risk_tasks", with_tables(["assessments"], "select distinct display_text as task from assessments"))
def q_risk_tasks(spark, d):
    return risk.tasks(risk.load(spark, d))


@query("risk_task_slice", with_tables(["assessments"], """
select * from assessments where display_text = 'Risk of Failure to Appear'
"""))
def q_risk_task_slice(spark, d):
    return risk.task_slice(risk.load(spark, d), "Risk of Failure to Appear")


@query("filter_levels", with_tables(["risk_filtered"], "select * from risk_filtered"))
def q_filter_levels(spark, d):
    return risk.filter_levels(risk.load(spark, d).select(*risk.GOOD_COLS))


@query("risk_split", with_tables(["risk_split"], "select assessment_id, display_text, set from risk_split"))
def q_risk_split(spark, d):
    return risk.split(risk.filter_levels(risk.load(spark, d).select(*risk.GOOD_COLS))).select(
        "assessment_id", "display_text", "set")


@query("confusion_matrix", with_tables(["rule_conf"], "select * from rule_conf"))
def q_confusion(spark, d):
    return mt.confusion_matrix(risk.rule_predictions(spark, d))


@query("accuracy", with_tables(["rule_acc"], "select * from rule_acc"))
def q_accuracy(spark, d):
    p = risk.rule_predictions(spark, d)
    return mt.accuracy_from_confusion(mt.confusion_matrix(p))


@query("kappa", with_tables(["rule_kappa"], "select * from rule_kappa"))
def q_kappa(spark, d):
    p = risk.rule_predictions(spark, d)
    return mt.kappa_from_confusion(mt.confusion_matrix(p))

# ---------------------------------------------------------------- columns, rows, windows

from ..functions.names import clean_names  # noqa: E402
from ..functions.strings import str_remove_first_digit  # noqa: E402
from ..operators import categorical as cat  # noqa: E402
from ..operators import clean  # noqa: E402
from ..operators import columns as co  # noqa: E402
from ..sources import fixtures  # noqa: E402

_NOMINAL = ["sex_code_text", "ethnic_code_text", "date_of_birth", "custody_status", "marital_status", "score_text"]


@query("select_cols", with_tables(["assessments"], f"select {', '.join(risk.GOOD_COLS)} from assessments"))
def q_select_cols(spark, d):
    return co.select_cols(risk.load(spark, d), risk.GOOD_COLS)


@query("drop_cols", with_tables(["assessments"], """
select * exclude (assessment_id, display_text, person_id) from assessments
"""))
def q_drop_cols(spark, d):
    return co.drop_cols(risk.load(spark, d), "assessment_id", "display_text", "person_id")


@query("rename_cols", with_tables(["assessments"], """
select * exclude (display_text, score_text), display_text as task, score_text as truth from assessments
"""))
def q_rename_cols(spark, d):
    return co.rename_cols(risk.load(spark, d), {"display_text": "task", "score_text": "truth"})


@query("unique_key_check", with_tables(["assessments"], """
select display_text, cast(sum(n) as bigint) as n_rows, cast(count(*) as bigint) as n_keys,
  cast(sum(case when n > 1 then 1 else 0 end) as bigint) as n_duplicated_keys
from (select display_text, assessment_id, count(*) as n from assessments group by all) group by display_text
"""))
def q_unique_key_check(spark, d):
    return co.key_check(risk.load(spark, d), ["assessment_id"], ["display_text"])


@query("arrange_person", with_tables(["assessments"], """
select * from assessments order by person_id
"""))
def q_arrange_person(spark, d):
    return risk.load(spark, d).orderBy("person_id")


@query("str_remove_first", with_tables(["assessments"], """
select distinct display_text || cast(scale_set as varchar) as numbered,
  regexp_replace(display_text || cast(scale_set as varchar), '[0-9]', '') as task
from assessments
"""))
def q_str_remove_first(spark, d):
    numbered = F.concat(F.col("display_text"), F.col("scale_set").cast("string"))
    return risk.load(spark, d).select(numbered.alias("numbered"),
                                      str_remove_first_digit(numbered).alias("task")).distinct()


@query("nth_row_per_group", with_tables(["assessments_named"], """
select * exclude (rn) from (select *, row_number() over (partition by assessment_id order by scale_set) as rn
                            from assessments_named) where rn = 2
"""))
def q_nth_row(spark, d):
    return clean.nth_row_per_group(clean_names(fixtures.raw_assessments(spark, d)), ["assessment_id"],
                                   ["scale_set"], 2)


@query("risk_dataset_nth", with_tables(["risk_nth2"], "select * from risk_nth2"))
def q_risk_dataset_nth(spark, d):
    return clean.nth_row_dataset(clean_names(fixtures.raw_assessments(spark, d)), 2, risk.LEVEL_FILTERS)


def _nth(spark, d, n, *drop):
    return clean.nth_row_dataset(clean_names(fixtures.raw_assessments(spark, d)), n, risk.LEVEL_FILTERS,
                                 drop=("person_id", "scale_set", *drop))


@query("risk_violence", with_tables(["assessments_named"], nth_sql(1, with_task=False)))
def q_risk_violence(spark, d):
    return _nth(spark, d, 1, "display_text")


@query("risk_recidivism", with_tables(["assessments_named"], nth_sql(2)))
def q_risk_recidivism(spark, d):
    return _nth(spark, d, 2)


@query("risk_appearance", with_tables(["assessments_named"], nth_sql(3)))
def q_risk_appearance(spark, d):
    return _nth(spark, d, 3)


@query("factor_levels", with_tables(["assessments"], f"""
select display_text as task, "column", level, cast(count(*) as bigint) as n
from (unpivot (select display_text, {", ".join(_NOMINAL)} from assessments)
      on {", ".join(_NOMINAL)} into name "column" value level)
group by all
"""))
def q_factor_levels(spark, d):
    df = risk.load(spark, d).withColumnRenamed("display_text", "task")
    return cat.level_counts(df, _NOMINAL, ["task"])


@query("factor_levels_after_filter", with_tables(["risk_filtered"], f"""
select display_text as task, "column", level, cast(count(*) as bigint) as n
from (unpivot (select display_text, {", ".join(_NOMINAL)} from risk_filtered)
      on {", ".join(_NOMINAL)} into name "column" value level)
group by all
"""))
def q_factor_levels_after_filter(spark, d):
    df = risk.filter_levels(risk.load(spark, d)).withColumnRenamed("display_text", "task")
    return cat.level_counts(df, _NOMINAL, ["task"])

# ---------------------------------------------------------------- recipe (trained preparation)

from pyspark.ml.functions import vector_to_array  # noqa: E402

from ..operators import recipe as rc  # noqa: E402
from ..operators.sparse import SparseEncoder  # noqa: E402
from .sql import RISK_DUMMIES_SQL, RISK_KNOWN_SQL, known_sql  # noqa: E402


@query("recipe_filter", with_tables(["risk_split"], f"""
select {', '.join(c for c in risk.GOOD_COLS)} from risk_split where set = 'train'
"""))
def q_recipe_filter(spark, d):
    df = risk.split_frame(spark, d)
    train = df.filter(F.col("set") == "train").drop("set")
    return risk.recipe()._filtered(train, "train")


@query("one_hot", with_tables(["risk_filtered"], f"""
select assessment_id, display_text, score_text,
  {RISK_DUMMIES_SQL}
from risk_filtered
"""))
def q_one_hot(spark, d):
    df = risk.filter_levels(risk.load(spark, d)).select(*risk.GOOD_COLS)
    nominal = ["sex_code_text", "ethnic_code_text", "date_of_birth", "custody_status", "marital_status"]
    levels = {k[0]: v for k, v in cat.level_dictionary(df, nominal).items()}
    return rc.one_hot(df, levels).drop("person_id")


_HOT = ["sex_code_text", "ethnic_code_text", "date_of_birth", "custody_status", "marital_status"]


@query("sparse_one_hot", with_tables(["risk_split"], f"""
, levels as (select name as col, level, row_number() over (order by array_position({_HOT}, name), level) - 1 as position
  from (select distinct name, level from (unpivot (select {", ".join(_HOT)} from risk_split where set = 'train')
    on {", ".join(_HOT)} into name name value level)))
select r.assessment_id, r.display_text, string_agg(cast(l.position as varchar), ',' order by l.position) as ones
from (unpivot (select assessment_id, display_text, {", ".join(_HOT)} from risk_split) on {", ".join(_HOT)} into name name value level) r
left join levels l on l.col = r.name and l.level = r.level group by r.assessment_id, r.display_text
"""))
def q_sparse_one_hot(spark, d):
    """Sparse one-hot vectors of all rows by the levels of the training rows, shown as the positions of their ones."""
    df = sp.materialize(risk.split_frame(spark, d).filter(risk.level_filter_condition()))
    coded = SparseEncoder.fit(df.filter(F.col("set") == "train"), _HOT).transform(df, unseen="zero")
    dense = vector_to_array("features")
    ones = F.filter(F.transform(dense, lambda x, i: F.when(x != 0, i)), lambda i: i.isNotNull())
    return coded.select("assessment_id", "display_text", F.array_join(ones.cast("array<string>"), ",").alias("ones"))


@query("recipe_juice", with_tables(["risk_juiced"], "select * from risk_juiced"))
def q_recipe_juice(spark, d):
    return risk.prepared(spark, d)[1]


@query("recipe_bake", with_tables(["risk_baked"], "select * from risk_baked"))
def q_recipe_bake(spark, d):
    return risk.prepared(spark, d)[2]


@query("recipe_dropped_rows", with_tables(["risk_split"], f"""
select display_text, set, count(*) as n_rows,
  cast(sum(case when {RISK_KNOWN_SQL} then 0 else 1 end) as bigint) as n_dropped
from risk_split group by display_text, set
"""))
def q_recipe_dropped_rows(spark, d):
    df = risk.split_frame(spark, d)
    parts = {s: df.filter(F.col("set") == s).drop("set") for s in ("train", "test")}
    model = risk.recipe().fit(parts["train"])
    train, test = (model.unseen_rows(part, s).withColumn("set", F.lit(s)) for s, part in parts.items())
    return train.unionByName(test)


@query("recipe_bake_all_tasks", with_tables(["risk_split"], f"""
select assessment_id, t.task as display_text, score_text,
  {RISK_DUMMIES_SQL}
from risk_split
cross join (select distinct display_text as task from risk_split where set = 'train') t
where set = 'test' and {known_sql("t.task")}
"""))
def q_recipe_bake_all(spark, d):
    return risk.prepared(spark, d, test_scope="all")[2]


@query("risk_prep", with_tables(["risk_juiced"], """
select * from risk_juiced where display_text = 'Risk of Failure to Appear'
"""))
def q_risk_prep(spark, d):
    df = risk.task_slice(risk.split_frame(spark, d), "Risk of Failure to Appear")
    train = df.filter(F.col("set") == "train").drop("set")
    return risk.recipe().fit(train).juice(train)


@query("risk_prep_all", with_tables(["risk_juiced", "risk_baked"], """
select *, 'train' as set from risk_juiced union all select *, 'test' as set from risk_baked
"""))
def q_risk_prep_all(spark, d):
    _, juiced, baked = risk.prepared(spark, d)
    return juiced.withColumn("set", F.lit("train")).unionByName(baked.withColumn("set", F.lit("test")))

# ---------------------------------------------------------------- metric tables (pinned rule: oracle-checked)

from .sql import class_metrics_sql  # noqa: E402


@query("metrics_unnest", with_tables(["rule_preds"], class_metrics_sql("rule_preds", ["task", "model"])))
def q_metrics_unnest(spark, d):
    nested = mt.nest_metrics(mt.class_metrics(risk.rule_predictions(spark, d)))
    return mt.unnest_metrics(nested)


@query("metrics_union", with_tables(["rule_preds_all"], class_metrics_sql("rule_preds_all", ["task", "model", "set"])))
def q_metrics_union(spark, d):
    df = risk.split(risk.filter_levels(risk.load(spark, d).select(*risk.GOOD_COLS)))
    preds = df.select(F.col(risk.TASK_COL).alias("task"), F.lit("rule").alias("model"), "set", risk.KEY,
                      F.col(risk.TARGET).alias("truth"), risk.rule_estimate().alias("estimate"))
    per_set = [mt.class_metrics(preds.filter(F.col("set") == s), ["task", "model", "set"]) for s in ("train", "test")]
    return per_set[0].unionByName(per_set[1])


# ---------------------------------------------------------------- MLlib models (rows-only checks)

from . import risk_models as rmod  # noqa: E402


@query("risk_rf")
def q_risk_rf(spark, d):
    return rmod.risk_predictions(spark, d, ["random_forest"])


@query("risk_dt")
def q_risk_dt(spark, d):
    return rmod.risk_predictions(spark, d, ["decision_tree"])


@query("risk_dt_majority", with_tables(["risk_juiced"], """
select display_text as task, sex_code_text_female as female, score_text as estimate
from (select display_text, sex_code_text_female, score_text, count(*) as n from risk_juiced group by all)
qualify row_number() over (partition by display_text, sex_code_text_female order by n desc, score_text) = 1
"""))
def q_risk_dt_majority(spark, d):
    """The tree on one 0/1 predictor: each leaf predicts its group's majority class."""
    rm, juiced, _ = risk.prepared(spark, d)
    rows = []
    for task in rm.groups:
        own = risk.task_slice(juiced, task)
        fit = rmod.md.fit_classifier(own, ["sex_code_text_female"], risk.TARGET, "decision_tree", task)
        rows.append(fit.predict(own, ["sex_code_text_female"]).distinct().select(
            F.lit(task).alias("task"), F.col("sex_code_text_female").alias("female"), "estimate"))
    return functools.reduce(lambda a, b: a.unionByName(b), rows)


@query("risk_gbt")
def q_risk_gbt(spark, d):
    return rmod.risk_predictions(spark, d, ["xgboost"])


@query("risk_logit")
def q_risk_logit(spark, d):
    return rmod.risk_predictions(spark, d, ["glmnet"])


@query("risk_fit_grid")
def q_risk_fit_grid(spark, d):
    return rmod.fit_grid_summary(spark, d)


@query("risk_predict")
def q_risk_predict(spark, d):
    return rmod.risk_predictions(spark, d)


@query("risk_metrics")
def q_risk_metrics(spark, d):
    return rmod.run_risk(spark, d)


@query("risk_results")
def q_risk_results(spark, d):
    return rmod.risk_results(spark, d)


@query("risk_metrics_all_tasks")
def q_risk_metrics_all_tasks(spark, d):
    """Compat (D4): every task's models scored on the test rows of all tasks."""
    return rmod.run_risk(spark, d, test_scope="all")


_MODELS_SQL = ", ".join(f"('{m}')" for m in rmod.md.CLASSIFIER_NAMES)


@query("risk_predict_truth", with_tables(["risk_baked"], f"""
select display_text as task, model, 'test' as set, score_text as truth, count(*) as n
from risk_baked cross join (values {_MODELS_SQL}) m(model) group by all
"""))
def q_risk_predict_truth(spark, d):
    """Every model predicts every prepared test row of its task exactly once."""
    return rmod.risk_predictions(spark, d).groupBy("task", "model", "set", "truth").agg(
        F.count("estimate").cast("bigint").alias("n"))


@query("risk_results_shape", with_tables(["risk_baked"], f"""
select distinct display_text as task, model, 2 as n_metrics, ['accuracy', 'kap'] as metrics
from risk_baked cross join (values {_MODELS_SQL}) m(model)
"""))
def q_risk_results_shape(spark, d):
    """One result row per task and model, each with both metrics."""
    names = F.transform("metrics", lambda m: m["metric"])
    return rmod.risk_results(spark, d).select("task", "model", F.size("metrics").alias("n_metrics"), names.alias("metrics"))


# ---------------------------------------------------------------- class probabilities


@query("mn_log_loss", with_tables(["rule_probs_long"], """
select task, model, 'mn_log_loss' as metric, 'multiclass' as estimator, round(avg(-ln(p)), 9) as estimate
from rule_probs_long where c = truth group by task, model
"""))
def q_mn_log_loss(spark, d):
    return pb.mn_log_loss(risk.rule_probabilities(spark, d)).withColumn("estimate", F.round("estimate", 9))


@query("class_pair_auc", with_tables(["rule_pairs"], """
select task, model, class_a, class_b, n_a, n_b, round(auc, 9) as auc from rule_pairs
"""))
def q_class_pair_auc(spark, d):
    """Mid-rank AUC of every ordered pair of classes."""
    return pb.class_pair_auc(risk.rule_probabilities(spark, d)).withColumn("auc", F.round("auc", 9))


@query("roc_auc", with_tables(["rule_pairs"], """
select task, model, 'roc_auc' as metric, 'hand_till' as estimator, round(avg(auc), 9) as estimate from rule_pairs group by task, model
"""))
def q_roc_auc(spark, d):
    return pb.hand_till_auc(risk.rule_probabilities(spark, d)).withColumn("estimate", F.round("estimate", 9))


@query("risk_probability_metrics")
def q_risk_probability_metrics(spark, d):
    """Log loss and Hand-Till AUC of the four learners."""
    return rmod.run_risk_probabilities(spark, d)


@query("risk_probability_sums", with_tables(["risk_baked"], """
select display_text as task, model, count(*) as n, count(*) as sum_to_one, count(*) as within, cast(3 as int) as classes
from risk_baked, (select unnest(['random_forest', 'decision_tree', 'xgboost', 'glmnet']) as model) group by all
"""))
def q_risk_probability_sums(spark, d):
    """Rows of each learner whose class probabilities add up to 1 and lie between 0 and 1: all of them."""
    values = F.map_values("probs")
    total = F.aggregate(values, F.lit(0.0), lambda s, x: s + x)
    preds = rmod.risk_probabilities(spark, d)
    return preds.groupBy("task", "model").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.abs(total - 1) < 1e-9).cast("bigint")).alias("sum_to_one"),
        F.sum(F.forall(values, lambda p: (p >= 0) & (p <= 1)).cast("bigint")).alias("within"), F.max(F.size("probs")).alias("classes"))


# ---------------------------------------------------------------- the learners where SQL can state their answer

#: One 0/1 predictor, forests of one unbagged tree, no penalty: every learner predicts its group's most frequent class.
STATED = {"features": ["sex_code_text_female"], "num_trees": 1, "bagging": False, "reg": 0.0}
FOUR = "(select unnest(['random_forest', 'decision_tree', 'xgboost', 'glmnet']) as model)"


@query("risk_grid_majority", with_tables(["group_majority"], f"select task, model, female, estimate from group_majority, {FOUR}"))
def q_risk_grid_majority(spark, d):
    """The grid of four learners on one 0/1 predictor: each group's most frequent class, for every learner."""
    preds = rmod.risk_probabilities(spark, d, keep=STATED["features"], **STATED)
    return preds.select("task", "model", F.col(STATED["features"][0]).alias("female"), "estimate").distinct()


@query("risk_metrics_majority", with_tables(["majority_metrics"], """
select task, model, metric, estimator, round(estimate, 9) as estimate from majority_metrics, """ + FOUR))
def q_risk_metrics_majority(spark, d):
    """Accuracy and kappa of those predictions, through the whole risk pipeline."""
    return rmod.run_risk(spark, d, **STATED).withColumn("estimate", F.round("estimate", 9))


@query("risk_group_frequencies", with_tables(["group_share", "group_majority"], """
select s.task, model, female, class,
  round(case when model = 'glmnet' or k > 1 then p else sum(n) over (partition by s.task, model, class) / sum(n) over (partition by s.task, model) end, 3) as p
from group_share s join (select task, count(distinct estimate) as k from group_majority group by task) m on m.task = s.task,
  (select unnest(['random_forest', 'decision_tree', 'glmnet']) as model)
"""))
def q_risk_group_frequencies(spark, d):
    """Class probabilities on that design: the classes' shares in the group (the boosted trees only tend to them).  Trees join
    leaves that predict the same class, so there the shares are those of both groups."""
    preds = rmod.risk_probabilities(spark, d, ["random_forest", "decision_tree", "glmnet"], keep=STATED["features"], **STATED)
    return preds.select("task", "model", F.col(STATED["features"][0]).alias("female"), F.explode("probs").alias("class", "p")).withColumn(
        "p", F.round("p", 3)).distinct()


# ---------------------------------------------------------------- importance per task, registry of fits


@query("risk_rule_importance", with_tables(["ri_out"], """
select task, feature, round(importance_05, 9) as importance_05, round(importance, 9) as importance, round(importance_95, 9) as importance_95,
  round(permutation_error, 9) as permutation_error from ri_out
"""))
def q_risk_rule_importance(spark, d):
    """How much the pinned rule's share of wrong labels grows when a predictor is permuted within its task."""
    out = ex.grouped_importance(rmod.importance_rows(spark, d), rmod.rule_classifier, risk.TARGET, rmod.PREDICTORS, "task", risk.KEY)
    return out.select("task", "feature", *[F.round(c, 9).alias(c) for c in ("importance_05", "importance", "importance_95", "permutation_error")])


@query("risk_importance")
def q_risk_importance(spark, d):
    """The same for the fitted trees and logistic regressions."""
    return rmod.risk_importance(spark, d)


@query("risk_registry", with_tables(["risk_juiced", "risk_baked", "majority_metrics"], """
select t.task, m.model, m.fit, 3 as n_labels, 1 as n_features, t.n_train, s.n_test, s.n_test as same_after_reload,
  round(max(a.estimate) filter (where a.metric = 'accuracy'), 9) as accuracy
from (select display_text as task, count(*) as n_train from risk_juiced group by 1) t
join (select display_text as task, count(*) as n_test from risk_baked group by 1) s using (task)
join majority_metrics a using (task),
(values ('decision_tree', 'DecisionTreeClassificationModel(seed=7)'),
        ('glmnet', 'LogisticRegressionModel(elasticNetParam=1.0, family=multinomial, maxIter=100, regParam=0.0)'),
        ('random_forest', 'RandomForestClassificationModel(bootstrap=False, featureSubsetStrategy=all, numTrees=1, seed=7)')) m(model, fit)
group by all
"""))
def q_risk_registry(spark, d):
    """Fits saved with what is needed to use them; every one is read back from its row and hits as many test rows as before."""
    registry, baked = rmod.risk_registry(spark, d, ["decision_tree", "glmnet", "random_forest"], **STATED)
    registry = sp.materialize(registry)
    again = rmod.score_registry(registry, baked).groupBy("task", "model").agg(
        F.sum((F.col("truth") == F.col("estimate")).cast("bigint")).alias("_hits"))
    accuracy = F.filter("metrics", lambda m: m["metric"] == "accuracy")[0]["estimate"]
    same = F.col("_hits") == F.round(accuracy * F.col("n_test")).cast("bigint")
    return registry.join(again, ["task", "model"]).select(
        "task", "model", "fit", F.size("labels").alias("n_labels"), "n_features", "n_train", "n_test",
        F.when(same, F.col("n_test")).otherwise(0).alias("same_after_reload"), F.round(accuracy, 9).alias("accuracy"))


# ---------------------------------------------------------------- tuning


@query("risk_tuning_stated", with_tables(["tune_means"], """
select task, 'decision_tree' as model, 'depth=' || setting as params, n_folds, round(train, 9) as train, round(test, 9) as test,
  row_number() over (partition by task order by test desc, setting) = 1 as chosen
from tune_means
"""))
def q_risk_tuning_stated(spark, d):
    """Trees of depth 0 and 1 on one 0/1 predictor: the most frequent class, of all rows or of the group, outside each fold."""
    out = rmod.risk_tuning(spark, d, [("decision_tree", {"depth": 0}), ("decision_tree", {"depth": 1})], STATED["features"])
    return out.select("task", "model", "params", "n_folds", F.round("train", 9).alias("train"), F.round("test", 9).alias("test"), "chosen")


@query("risk_tuning")
def q_risk_tuning(spark, d):
    """Depths of the tree and penalties of the logistic regression on all predictors."""
    return rmod.risk_tuning(spark, d)


@query("risk_tuned")
def q_risk_tuned(spark, d):
    """Test metrics of the chosen settings, fitted on all training rows."""
    return rmod.run_risk_tuned(spark, d)
