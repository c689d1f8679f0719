"""Measures of class probabilities: multinomial log loss and Hand-Till AUC.

Predictions carry ``probs``, a map from class to probability, beside the true class.  Both measures are grouped aggregates.  The
AUC ranks scores without sorting a group in one place: equal scores are counted first (one row per group, class and distinct score), the counted scores
are range-partitioned, and each partition only needs the class totals of the partitions before it, a frame of partitions x groups x classes rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .split import materialize

EPSILON = 1e-15  # probabilities are kept this far from 0 and 1 in the log loss


def _metric(group: list[str], name: str, estimator: str, value: Column) -> list[Column]:
    return [*map(F.col, group), F.lit(name).alias("metric"), F.lit(estimator).alias("estimator"), value.alias("estimate")]


def mn_log_loss(pred: DataFrame, group: Iterable[str] = ("task", "model"), truth: str = "truth", probs: str = "probs") -> DataFrame:
    """Mean negative log probability of the true class, per group.  A class without a probability counts as ``EPSILON``;
    rows with a NULL truth are left out."""
    g = list(group)
    p = F.coalesce(F.try_element_at(F.col(probs), F.col(truth)), F.lit(0.0))
    held = F.least(F.greatest(p, F.lit(EPSILON)), F.lit(1.0 - EPSILON))
    losses = pred.where(F.col(truth).isNotNull()).groupBy(*g).agg(F.avg(-F.log(held)).alias("_loss"))
    return losses.select(*_metric(g, "mn_log_loss", "multiclass", F.col("_loss")))


def _big(c: Column) -> Column:
    return c.cast("decimal(38,0)")  # products of counts exceed 64 bits


def class_pair_auc(pred: DataFrame, group: Iterable[str] = ("task", "model"), truth: str = "truth", probs: str = "probs") -> DataFrame:
    """``group..., class_a, class_b, n_a, n_b, auc``: for every ordered pair of classes that occur, the chance that a row of class a
    has a larger probability of class a than a row of class b; equal probabilities count half."""
    g = list(group)
    rows = pred.where(F.col(truth).isNotNull())
    classes = sorted(r[0] for r in rows.select(truth).distinct().collect())
    spark = pred.sparkSession
    if not classes:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pred.select(*g).schema)
        return spark.createDataFrame([], f"{fields}, class_a string, class_b string, n_a bigint, n_b bigint, auc double")
    n = [f"_n{i}" for i in range(len(classes))]
    scored = rows.select(*g, F.col(truth).alias("_t"), F.explode(F.col(probs)).alias("_c", "_s")).where(
        F.col("_c").isin(*classes) & F.col("_s").isNotNull())
    cells = scored.groupBy(*g, "_c", "_s").agg(*[F.sum((F.col("_t") == c).cast("bigint")).alias(k) for c, k in zip(classes, n)])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(cells.repartitionByRange(parts, *g, "_c", "_s").withColumn("_p", F.spark_partition_id()))

    def own(cols):
        out = F.when(F.col("_c") == classes[0], F.col(cols[0]))
        for c, k in zip(classes[1:], cols[1:]):
            out = out.when(F.col("_c") == c, F.col(k))
        return out

    # twice the number of (a, b) pairs won, ties once: within a partition ...
    below = Window.partitionBy("_p", *g, "_c").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    within = ranged.select("_p", *g, "_c", *n, *[F.coalesce(F.sum(k).over(below), F.lit(0)).alias(f"_b{k}") for k in n])
    per = within.groupBy("_p", *g, "_c").agg(
        *[F.sum(k).alias(k) for k in n], *[F.sum(_big(own(n)) * _big(2 * F.col(f"_b{k}") + F.col(k))).alias(f"_w{k}") for k in n])
    # ... and against the partitions before it
    before = Window.partitionBy(*g, "_c").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    won = [(F.col(f"_w{k}") + _big(own(n)) * _big(2 * F.coalesce(F.sum(k).over(before), F.lit(0)))).alias(f"_w{k}") for k in n]
    total = per.select(*g, "_c", *n, *won).groupBy(*g, "_c").agg(*[F.sum(k).alias(k) for k in n], *[F.sum(f"_w{k}").alias(f"_w{k}") for k in n])
    pairs = F.array(*[F.struct(F.lit(c).alias("class_b"), F.col(k).alias("n_b"), F.col(f"_w{k}").alias("_won")) for c, k in zip(classes, n)])
    wide = total.select(*g, F.col("_c").alias("class_a"), own(n).alias("n_a"), F.inline(pairs))
    return wide.where("class_a <> class_b and n_a > 0 and n_b > 0").select(
        *g, "class_a", "class_b", "n_a", "n_b",
        (F.col("_won").cast("double") / (F.lit(2.0) * F.col("n_a").cast("double") * F.col("n_b").cast("double"))).alias("auc"))


def hand_till_auc(pred: DataFrame, group: Iterable[str] = ("task", "model"), truth: str = "truth", probs: str = "probs") -> DataFrame:
    """Hand-Till AUC per group: the mean of :func:`class_pair_auc` over all ordered pairs of classes that occur; a group with
    one class has no row."""
    g = list(group)
    return class_pair_auc(pred, g, truth, probs).groupBy(*g).agg(F.avg("auc").alias("_auc")).select(
        *_metric(g, "roc_auc", "hand_till", F.col("_auc")))


def probability_metrics(pred: DataFrame, group: Iterable[str] = ("task", "model"), truth: str = "truth", probs: str = "probs") -> DataFrame:
    """Both measures in long form.  ``pred`` is read several times: pass a written frame."""
    return mn_log_loss(pred, group, truth, probs).unionByName(hand_till_auc(pred, group, truth, probs))
