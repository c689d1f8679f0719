"""RISK pipeline: multiclass risk-label prediction per task (display text).

load -> keep columns -> split -> per-task preparation (one pass with a task
column) -> model grid -> predictions -> accuracy / kappa per (task, model).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import split as sp
from ..sources import io

# The kept columns, the task column, key, target, and the three level filters.
GOOD_COLS = [
    "person_id", "assessment_id", "sex_code_text", "ethnic_code_text", "date_of_birth",
    "custody_status", "display_text", "marital_status", "score_text",
]
TASK_COL = "display_text"
KEY = "assessment_id"
TARGET = "score_text"
LEVEL_FILTERS = {
    "ethnic_code_text": ["African-American", "Caucasian", "Hispanic"],
    "custody_status": ["Jail Inmate", "Probation", "Pretrial Defendant"],
    "marital_status": ["Single", "Married"],
}
SPLIT_PROP = 0.8
SPLIT_SEED = 42


def load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return io.load_risk(spark, sf_dir)


def level_filter_condition(filters: dict[str, list[str]] = LEVEL_FILTERS) -> Column:
    cond = F.lit(True)
    for c, levels in filters.items():
        cond = cond & F.col(c).isin(*levels)
    return cond


def filter_levels(df: DataFrame, filters: dict[str, list[str]] = LEVEL_FILTERS) -> DataFrame:
    return df.filter(level_filter_condition(filters))


def task_slice(df: DataFrame, task: str) -> DataFrame:
    return df.filter(F.col(TASK_COL) == task)


def tasks(df: DataFrame) -> DataFrame:
    """Distinct tasks, sorted (first-seen order is not data in Spark)."""
    return df.select(F.col(TASK_COL).alias("task")).distinct().orderBy("task")


def split(df: DataFrame, prop: float = SPLIT_PROP, seed: int = SPLIT_SEED,
          key: list[str] | None = None) -> DataFrame:
    """Row-level keyed split; ``key=['person_id']`` keeps a person on one side."""
    return sp.initial_split(df, key or [KEY, TASK_COL], prop, seed)


def rule_estimate() -> Column:
    """A fixed rule used as a pinned classifier (exactly reproducible in SQL)."""
    return (
        F.when(F.col("date_of_birth") == "Younger than 25", "High")
        .when(F.col("custody_status") == "Jail Inmate", "Medium")
        .otherwise("Low")
    )


def rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test-set predictions of the pinned rule for every task: the minimum end-to-end slice."""
    df = split(filter_levels(load(spark, sf_dir).select(*GOOD_COLS)))
    test = df.filter(F.col("set") == "test")
    return test.select(
        F.col(TASK_COL).alias("task"), F.lit("rule").alias("model"), F.col("set"), F.col(KEY),
        F.col(TARGET).alias("truth"), rule_estimate().alias("estimate"),
    )


def rule_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test-set class probabilities of a pinned formula: shares of three weights that mix the rule with a keyed hash."""
    df = split(filter_levels(load(spark, sf_dir).select(*GOOD_COLS))).filter(F.col("set") == "test")
    h = sp.hash_unit(KEY, "p") % 97
    weights = {"High": 10 + F.when(F.col("date_of_birth") == "Younger than 25", 40).otherwise(0) + h,
               "Medium": 20 + F.when(F.col("custody_status") == "Jail Inmate", 30).otherwise(0) + (h * 7) % 31,
               "Low": 30 + (h * 13) % 53}
    total = weights["High"] + weights["Medium"] + weights["Low"]
    probs = F.create_map(*[x for k, w in weights.items() for x in (F.lit(k), w.cast("double") / total.cast("double"))])
    return df.select(F.col(TASK_COL).alias("task"), F.lit("rule").alias("model"), "set", KEY, F.col(TARGET).alias("truth"),
                     probs.alias("probs"))


def recipe(filter_on=("train", "test"), unseen: str = "drop"):
    """Per-task preparation: trained level filter, level dictionaries, full one-hot of predictors."""
    from ..operators.recipe import Recipe

    return Recipe(target=TARGET, key=KEY, group=TASK_COL, exclude=["person_id"],
                  filter=level_filter_condition(), filter_on=filter_on, unseen=unseen)


def split_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept columns with the train/test tag (split on raw rows, before any task filter)."""
    return split(load(spark, sf_dir).select(*GOOD_COLS))


def prepared(spark: SparkSession, sf_dir: str, test_scope: str = "own", unseen: str = "drop"):
    """(recipe model, juiced training rows, baked test rows) for all tasks in one pass."""
    from ..operators.columns import assert_unique
    from ..operators.split import materialize

    # read by the key check, the level aggregate, the training layout and the test scoring: written once
    df = materialize(split_frame(spark, sf_dir))
    assert_unique(df, [KEY], [TASK_COL])
    train = df.filter(F.col("set") == "train").drop("set")
    test = df.filter(F.col("set") == "test").drop("set")
    model = recipe(unseen=unseen).fit(train)
    return model, model.juice(train), model.bake(test, scope=test_scope)
