"""HOUSE pipeline: regression of sale price with cross-validated benchmark and explanations.

load -> combine (clean) -> split -> fit learners -> k-fold benchmark -> predict ->
permutation importance, PDP / ICE / ALE, local explanations (LIME, Shapley).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean
from ..sources import io

# Key, target, explained feature, split and resampling parameters.
KEY = "id"
TARGET = "sale_price"
FEATURE = "gr_liv_area"
SPLIT_PROP = 0.8
SPLIT_SEED = 2
FOLDS = 4
FOLD_SEED = 4
OBSERVATION = 122


def load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return io.load_house(spark, sf_dir)


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.type_columns(load(spark, sf_dir))


def cleaned(spark: SparkSession, sf_dir: str, align: str = "id") -> DataFrame:
    return clean.combine(load(spark, sf_dir), align=align)


def rule_prediction():
    """A fixed scoring formula used as a pinned regressor (exactly reproducible in SQL).

    Non-additive on purpose (an interaction of the two numeric features), so that
    ICE curves differ between rows.
    """
    return (
        F.lit(50000.0) + F.lit(900.0) * F.col("gr_liv_area") + F.lit(100.0) * F.col("lot_frontage")
        + F.lit(0.5) * F.col("gr_liv_area") * F.col("lot_frontage")
        + F.when(F.col("neighborhood") == "BUILDING", 4000.0).when(F.col("neighborhood") == "MACHINERY", -2500.0)
        .otherwise(0.0)
    )


def rule_scorer(df: DataFrame) -> DataFrame:
    """Scorer protocol: DataFrame -> same DataFrame with a ``prediction`` column."""
    return df.withColumn("prediction", rule_prediction())


def level_prediction():
    """A second pinned formula in which every category counts, some of them together."""
    def code(c):
        return F.ascii(F.right(F.col(c), F.lit(1))).cast("double")

    return (rule_prediction() + F.lit(3.0) * code("overall_qual") * F.col("lot_frontage") + F.lit(11.0) * code("yr_sold")
            + F.lit(7.0) * code("ms_sub_class") * code("garage_type"))


def level_scorer(df: DataFrame) -> DataFrame:
    return df.withColumn("prediction", level_prediction())
