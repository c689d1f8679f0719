"""Classification and regression metrics as grouped aggregates.

Classification metrics read the data once into confusion counts (partial
aggregation, then a shuffle of at most groups x classes^2 rows); accuracy and
kappa are arithmetic on that small frame.  Regression losses are one grouped
aggregate per call.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _g(group: Iterable[str]) -> list[str]:
    return list(group)


def confusion_matrix(pred: DataFrame, group: Iterable[str] = ("task", "model"), truth: str = "truth",
                     estimate: str = "estimate", counts: str | None = None) -> DataFrame:
    """Rows per group, true and predicted class; ``counts`` names the number of rows that a row stands for."""
    g = _g(group)
    n = F.count(F.lit(1)) if counts is None else F.sum(counts)
    return pred.groupBy(*g, truth, estimate).agg(n.cast("bigint").alias("n"))


def confusion_summary(conf: DataFrame, group: Iterable[str] = ("task", "model"), truth: str = "truth",
                      estimate: str = "estimate") -> DataFrame:
    """Per group: total, agreements and sum over classes of (row marginal x column marginal).

    A linear chain over the small confusion frame (each cell emitted once as a row
    share and once as a column share, summed per class, then per group): the
    confusion frame is read once, with no self-join.
    """
    def wide(c):  # products of marginals exceed 64 bits
        return F.col(c).cast("decimal(19,0)")

    g = _g(group)
    n = F.col("n")
    agree = F.when(F.col(truth) == F.col(estimate), n).otherwise(F.lit(0).cast("bigint"))
    zero = F.lit(0).cast("bigint")
    parts = conf.select(*g, F.inline(F.array(
        F.struct(F.col(truth).alias("level"), n.alias("r"), zero.alias("c"), agree.alias("a")),
        F.struct(F.col(estimate).alias("level"), zero.alias("r"), n.alias("c"), zero.alias("a")),
    )))
    per_level = parts.groupBy(*g, "level").agg(F.sum("r").alias("r"), F.sum("c").alias("c"), F.sum("a").alias("a"))
    return per_level.groupBy(*g).agg(
        F.sum("r").alias("n_total"), F.sum("a").alias("n_agree"), F.sum(wide("r") * wide("c")).alias("rc"))


def _accuracy() -> Column:
    return F.col("n_agree") / F.col("n_total")


def _kappa() -> Column:
    nt = F.col("n_total").cast("double")
    po = F.col("n_agree").cast("double") / nt
    pe = F.col("rc").cast("double") / (nt * nt)
    return F.try_divide(po - pe, F.lit(1.0) - pe)


def accuracy_from_confusion(conf: DataFrame, group: Iterable[str] = ("task", "model"), truth: str = "truth",
                            estimate: str = "estimate") -> DataFrame:
    g = _g(group)
    return confusion_summary(conf, g, truth, estimate).select(*g, _accuracy().alias("accuracy"))


def kappa_from_confusion(conf: DataFrame, group: Iterable[str] = ("task", "model"), truth: str = "truth",
                         estimate: str = "estimate") -> DataFrame:
    """Multiclass Cohen's kappa (po - pe) / (1 - pe); NULL when pe = 1 (undefined)."""
    g = _g(group)
    return confusion_summary(conf, g, truth, estimate).select(*g, _kappa().alias("kappa"))


def class_metrics(pred: DataFrame, group: Iterable[str] = ("task", "model"), truth: str = "truth",
                  estimate: str = "estimate") -> DataFrame:
    """Long table ``(group..., metric, estimator, estimate)`` with accuracy and multiclass kappa.

    predictions -> confusion counts -> per-class -> per-group: one linear chain, so
    the predictions are read exactly once.
    """
    return metrics_from_confusion(confusion_matrix(pred, group, truth, estimate), group, truth, estimate)


def metrics_from_confusion(conf: DataFrame, group: Iterable[str] = ("task", "model"), truth: str = "truth",
                           estimate: str = "estimate") -> DataFrame:
    """:func:`class_metrics` of given confusion counts."""
    g = _g(group)
    summ = confusion_summary(conf, g, truth, estimate)
    return summ.select(
        *g,
        F.inline(F.array(
            F.struct(F.lit("accuracy").alias("metric"), F.lit("multiclass").alias("estimator"),
                     _accuracy().alias("estimate")),
            F.struct(F.lit("kap").alias("metric"), F.lit("multiclass").alias("estimator"),
                     _kappa().alias("estimate")),
        )),
    )


def nest_metrics(long: DataFrame, group: Iterable[str] = ("task", "model")) -> DataFrame:
    """One row per group with ``metrics: array<struct<metric, estimator, estimate>>`` (sorted by metric)."""
    g = _g(group)
    return long.groupBy(*g).agg(
        F.array_sort(F.collect_list(F.struct("metric", "estimator", "estimate"))).alias("metrics")
    )


def unnest_metrics(nested: DataFrame, group: Iterable[str] = ("task", "model")) -> DataFrame:
    g = _g(group)
    return nested.select(*g, F.inline("metrics"))


def squared_error(y: str = "label", yhat: str = "prediction") -> Column:
    return F.pow(F.col(y) - F.col(yhat), 2)


def abs_pct_error(y: str = "label", yhat: str = "prediction") -> Column:
    """|y - yhat| / |y|; NULL where y = 0 (excluded from the mean)."""
    return F.abs(F.try_divide(F.col(y) - F.col(yhat), F.col(y)))


def regression_losses(pred: DataFrame, group: Iterable[str], y: str = "label", yhat: str = "prediction") -> DataFrame:
    """MSE, MAPE and MAE per group."""
    g = _g(group)
    return pred.groupBy(*g).agg(
        F.avg(squared_error(y, yhat)).alias("mse"),
        F.avg(abs_pct_error(y, yhat)).alias("mape"),
        F.avg(F.abs(F.col(y) - F.col(yhat))).alias("mae"),
    )
